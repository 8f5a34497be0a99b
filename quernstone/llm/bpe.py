"""Encoding of whole texts with a public byte-level BPE vocabulary (problem 6).

Texts are cut into pre-tokens; the symbols of a pre-token form a doubly linked list, and a priority queue of
(merge rank, position) joins the best pair first. An entry whose symbols changed since it was queued is stale and skipped.
Equal pieces of text repeat, so each Python worker keeps a bounded table of encoded pieces.

Nulls and empty texts give an empty list; texts of any length are encoded whole; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quernstone.functions.words import pieces, texts

VOCAB = "/opt/tokenizers/byte_bpe_50k.json"
#: A vocabulary is broadcast, so its size is checked.
MOST_ENTRIES = 1_000_000
#: Pieces that a worker keeps; the table starts anew beyond that.
MOST_CACHED = 400_000
MOST_CACHED_CHARS = 40

#: White space by the Unicode property White_Space (fixed values).
_WS = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
#: Pre-token pattern of byte-level BPE vocabularies of this family (fixed value).
PRETOKEN = rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
#: Any place where white space follows another character is a pre-token boundary, so such pieces can be encoded alone.
PIECE = rf"[{_WS}]*[^{_WS}]+|[{_WS}]+"
#: PRETOKEN for pieces of ASCII alone.
_ASCII_PRETOKEN = r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\t\n\x0b\x0c\r A-Za-z0-9]+|[\t\n\x0b\x0c\r ]+(?![^\t\n\x0b\x0c\r ])|[\t\n\x0b\x0c\r ]+"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte: itself where printable, else the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


def load(path: str = VOCAB) -> dict:
    """Vocabulary and merges of a tokenizer file as plain tables: bytes of each id, id of each byte, merges of id pairs."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, letters = model["vocab"], byte_letters()
    if len(vocab) > MOST_ENTRIES:
        raise ValueError(f"{path} has {len(vocab)} entries; at most {MOST_ENTRIES} are broadcast")
    merges = {}
    for rank, m in enumerate(model["merges"]):
        a, b = m.split(" ") if isinstance(m, str) else m
        merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
    spelled = {i: bytes(letters[c] for c in s) if all(c in letters for c in s) else s.encode() for s, i in vocab.items()}
    return {"merges": merges, "bytes": [vocab[c] for c in sorted(letters, key=letters.get)], "spelled": spelled}


def merge(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Join neighbouring symbols, the pair of lowest rank first, the leftmost of equal pairs first."""
    n = len(symbols)
    if n < 2:
        return symbols
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    queue = [(*m, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (m := merges.get((symbols[i], symbols[i + 1])))]
    queue = [(rank, i, a, b, new) for rank, new, i, a, b in queue]
    heapq.heapify(queue)
    while queue:
        _, i, a, b, new = heapq.heappop(queue)
        j = right[i]
        if symbols[i] != a or j < 0 or symbols[j] != b:
            continue
        symbols[i], symbols[j] = new, -1
        k = right[i] = right[j]
        if k >= 0:
            left[k] = i
            if m := merges.get((new, symbols[k])):
                heapq.heappush(queue, (m[0], i, new, symbols[k], m[1]))
        if (h := left[i]) >= 0 and (m := merges.get((symbols[h], new))):
            heapq.heappush(queue, (m[0], h, symbols[h], new, m[1]))
    return [s for s in symbols if s >= 0]


def encoder(vocab: dict) -> Callable[[str], list[int]]:
    """A function that encodes one text; it keeps pieces that it has seen."""
    merges, of_byte = vocab["merges"], vocab["bytes"]
    cut, split, split_ascii = re.compile(PIECE).findall, regex.compile(PRETOKEN).findall, re.compile(_ASCII_PRETOKEN).findall
    known: dict[str, list[int]] = {}  # of pieces
    tokens: dict[str, list[int]] = {}  # of pre-tokens

    def keep(table: dict[str, list[int]], key: str, ids: list[int]) -> list[int]:
        if len(key) <= MOST_CACHED_CHARS:
            if len(table) >= MOST_CACHED:
                table.clear()
            table[key] = ids
        return ids

    def piece(p: str) -> list[int]:
        ids: list[int] = []
        for t in split_ascii(p) if p.isascii() else split(p):
            ids += tokens.get(t) or keep(tokens, t, merge([of_byte[b] for b in t.encode()], merges))
        return keep(known, p, ids)

    def encode(text: str) -> list[int]:
        out: list[int] = []
        for p in cut(text):
            ids = known.get(p)
            out += piece(p) if ids is None else ids
        return out

    return encode


def decode(ids: list[int], vocab: dict) -> str:
    """The text of ids: their bytes in a row, read as UTF-8."""
    return b"".join(map(vocab["spelled"].__getitem__, ids)).decode("utf-8", "replace")


_ENCODERS: dict[str, Callable[[str], list[int]]] = {}


def _kept(name: str, shared) -> Callable[[str], list[int]]:
    """The worker's encoder of this vocabulary, kept from task to task."""
    if name not in _ENCODERS:
        _ENCODERS[name] = encoder(shared.value)
    return _ENCODERS[name]


def encode_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab_path: str = VOCAB) -> DataFrame:
    """(id_col, ids) of every row of df, ids a list of integers; no shuffle.

    A null or empty text has an empty list; repeated rows stay repeated; an empty table gives an empty result.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(load(vocab_path))
    narrow = df.select(id_col, text_col)
    kind = narrow.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _kept(vocab_path, shared)
        for b in pieces(batches, text_col):
            flat, ends = [], [0]
            for t in texts(b.column(1)):
                if t:
                    flat += encode(t)
                ends.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), pa.array(np.array(flat, np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], [id_col, "ids"])

    return narrow.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode_ids(df: DataFrame, id_col: str = "doc_id", vocab_path: str = VOCAB) -> DataFrame:
    """(id_col, text) of rows with `ids`; the inverse of encode_texts, except that a null text comes back empty."""
    shared = df.sparkSession.sparkContext.broadcast(load(vocab_path))
    narrow = df.select(id_col, "ids")
    kind = narrow.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for b in batches:
            out = [None if x is None else decode(x, vocab) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], [id_col, "text"])

    return narrow.mapInArrow(run, f"`{id_col}` {kind}, text string")
