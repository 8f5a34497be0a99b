"""Word normalisation shared by the text operators; plain Python, used inside Arrow batches."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa

#: Characters without width that are removed before words are cut (fixed values).
ZERO_WIDTH = "­​‌‍⁠﻿"
_DROP = re.compile(f"[{ZERO_WIDTH}]")
#: A run of letters and digits (classes L and N): \w without the underscore and without marks.
WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """NFKC, removal of zero-width characters."""
    if text.isascii():
        return text
    if not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    return _DROP.sub("", text)


def normalize(text: str) -> str:
    """NFKC, removal of zero-width characters, lower case."""
    return fold(text).lower()


def words(text: str) -> list[str]:
    return WORD.findall(normalize(text))


def texts(column: pa.Array | pa.ChunkedArray) -> list[str | None]:
    """Strings of an Arrow column; bytes that are no UTF-8 become U+FFFD instead of an error."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        raw = column.cast(pa.binary()).to_pylist()
        return [None if b is None else b.decode("utf-8", "replace") for b in raw]


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Split record batches so that each holds about `most` bytes of `column` at most; one row is never split."""
    for b in batches:
        size = b.column(b.schema.get_field_index(column)).nbytes
        n = b.num_rows
        step = max(1, n * most // max(size, 1)) if size > most else n
        for i in range(0, n, step or 1):
            yield b.slice(i, step)
