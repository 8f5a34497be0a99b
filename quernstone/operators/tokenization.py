"""Tokenizers by name as Arrow functions, with batches that isolate bad rows, and loss masks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions.words import pieces, texts

Tokenizer = Callable[[list[str]], list[list[int]]]


def _bytes(path: str | None) -> Tokenizer:
    return lambda batch: [list(t.encode()) for t in batch]


def _hashed(path: str | None) -> Tokenizer:
    """A 31-bit hash of each piece between white space: the same ids everywhere, without a vocabulary."""
    import xxhash

    return lambda batch: [[xxhash.xxh32_intdigest(w) & 0x7FFFFFFF for w in t.split()] for t in batch]


def _tokenizers(path: str | None) -> Tokenizer:
    from tokenizers import Tokenizer as File

    t = File.from_file(path)
    t.encode_special_tokens = True
    return lambda batch: [e.ids for e in t.encode_batch(batch, add_special_tokens=False)]


def _sentencepiece(path: str | None) -> Tokenizer:
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda batch: p.encode(batch, num_threads=1)


def _tiktoken(path: str | None) -> Tokenizer:
    import base64

    import tiktoken

    #: Pre-token pattern of this family of vocabularies (fixed value).
    pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda batch: [e.encode_ordinary(t) for t in batch]


KINDS: dict[str, Callable[[str | None], Tokenizer]] = {"bytes": _bytes, "hashed": _hashed, "tokenizers": _tokenizers, "sentencepiece": _sentencepiece, "tiktoken": _tiktoken}
_LOADED: dict[tuple[str, str | None], Tokenizer] = {}


def loaded(kind: str, path: str | None) -> Tokenizer:
    """The worker's tokenizer of this kind and file, loaded once."""
    if (kind, path) not in _LOADED:
        _LOADED[kind, path] = KINDS[kind](path)
    return _LOADED[kind, path]


def safely(tokenize: Tokenizer, batch: list[str]) -> list[list[int] | None]:
    """The ids of each text; where a batch fails it is halved until the bad text is alone, which gives None."""
    try:
        return list(tokenize(batch))
    except Exception:  # noqa: BLE001
        if len(batch) == 1:
            return [None]
        half = len(batch) // 2
        return safely(tokenize, batch[:half]) + safely(tokenize, batch[half:])


def tokenize(df: DataFrame, id_col: str, text_col: str, kind: str = "hashed", path: str | None = None, *, most_tokens: int | None = None, bos: int | None = None, eos: int | None = None, batch: int = 1000) -> DataFrame:
    """(id_col, ids, truncated, failed): null texts and texts that fail have null ids."""
    of = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = loaded(kind, path)
        for b in pieces(batches, text_col):
            ts = texts(b.column(1))
            there = [i for i, x in enumerate(ts) if x is not None]
            out: list[list[int] | None] = [None] * len(ts)
            for k in range(0, len(there), batch):
                part = there[k : k + batch]
                for i, ids in zip(part, safely(t, [ts[i] for i in part])):
                    out[i] = None if ids is None else [*([bos] if bos is not None else []), *ids, *([eos] if eos is not None else [])]
            cut = [x is not None and most_tokens is not None and len(x) > most_tokens for x in out]
            out = [x[:most_tokens] if c else x for x, c in zip(out, cut)]
            failed = [x is None and ts[i] is not None for i, x in enumerate(out)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int64())), pa.array(cut), pa.array(failed)], [id_col, "ids", "truncated", "failed"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {of}, ids array<long>, truncated boolean, failed boolean")


def loss_mask(chunks: Column) -> Column:
    """Ones for the tokens of assistant chunks, zeros for the rest; chunks are (role, tokens)."""
    return F.flatten(F.transform(chunks, lambda c: F.array_repeat(F.when(c["role"] == "assistant", 1).otherwise(0), F.size(c["tokens"]))))


def accounting(df: DataFrame, reason: str) -> DataFrame:
    """Rows by the reason for which they were dropped; null is kept."""
    return df.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("rows"))


def token_stats(df: DataFrame, ids: str = "ids") -> DataFrame:
    """Sequences, tokens, shortest and longest; zeros where there are none."""
    n = F.size(ids)
    return df.where(n > 0).agg(F.count("*").alias("sequences"), F.coalesce(F.sum(n), F.lit(0)).alias("tokens"), F.coalesce(F.min(n), F.lit(0)).alias("shortest"), F.coalesce(F.max(n), F.lit(0)).alias("longest"))


