"""Filling containers of fixed capacity with items of varying length (problem 3).

Bounded-space online best fit: a fixed number of bins is open, kept in a bitset keyed by free space. An item goes into the bin with the
least space that holds it, found by one shift and one lowest set bit; when none holds it and all bins are open, the fullest is closed and
written. A full bin is closed at once. Only an item longer than the capacity is cut, into full bins and one rest.

Each dataset and shard is packed alone, in the order of seq_id. A shard of very many tokens is spread over lanes by a hash of
seq_id, each of about `lane_tokens` tokens, so a hot shard never sits in one task; a task streams through its lanes and holds open bins only.

Repeated sequences (same dataset, shard and seq_id) count once; sequences without a seq_id are all packed. Null or empty input_ids
hold nothing and are in no container. A null loss_mask means ones, a short one is filled with ones, a long one is cut. Null dataset or
shard_index make a group of their own. A dataset without a capacity gets `default_size`. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN_BINS, LANE_TOKENS, DEFAULT_SIZE = 64, 8_000_000, 2048


class OpenBins:
    """Open bins by free space; put() and flush() give the bins that are closed, each a list of items."""

    def __init__(self, capacity: int, most: int = OPEN_BINS) -> None:
        self.capacity, self.most = capacity, most
        self.free, self.bins, self.n = 0, {}, 0

    def _take(self, space: int) -> list:
        same = self.bins[space]
        b = same.pop(0)
        if not same:
            del self.bins[space]
            self.free ^= 1 << space
        return b

    def put(self, item: Any, length: int) -> Iterator[list]:
        if not 0 < length <= self.capacity:
            raise ValueError(f"length {length} with capacity {self.capacity}")
        fits = self.free >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            b = self._take(space)
        else:
            if self.n == self.most:
                yield self._take((self.free & -self.free).bit_length() - 1)
                self.n -= 1
            b, space = [], self.capacity
            self.n += 1
        b.append(item)
        if space == length:
            self.n -= 1
            yield b
        else:
            self.bins.setdefault(space - length, []).append(b)
            self.free |= 1 << (space - length)

    def flush(self) -> Iterator[list]:
        while self.free:
            yield self._take((self.free & -self.free).bit_length() - 1)
        self.n = 0


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, tokens) of an item's pieces: one unless it is longer than the capacity."""
    return [(i, min(capacity, length - i)) for i in range(0, length, capacity)]


def _streamed(rows: Iterator[tuple], open_bins: int) -> Iterator[tuple[tuple, int, int, list]]:
    """(group, capacity, number, bin) of rows (dataset, shard, lane, seq_id, length, capacity, payload), ordered by the first four."""
    group, last, bins, number = None, None, None, 0
    for *key, seq_id, length, capacity, payload in rows:
        key = tuple(key)
        if bins is None or key != group:
            if bins:
                for b in bins.flush():
                    yield group, bins.capacity, number, b
                    number += 1
            group, last, bins, number = key, None, OpenBins(capacity, open_bins), 0
        if not length or (seq_id is not None and seq_id == last):
            continue
        last = seq_id
        parts = cut(length, capacity)
        for start, n in parts:
            for b in bins.put((seq_id, start, n, len(parts), payload), n):
                yield group, capacity, number, b
                number += 1
    if bins:
        for b in bins.flush():
            yield group, bins.capacity, number, b
            number += 1


def capacities(packed: DataFrame) -> DataFrame:
    """(dataset, pack_size) of containers that an earlier run wrote."""
    return packed.groupBy("dataset").agg(F.max("pack_size").alias("pack_size")).where("pack_size > 0")


def _content() -> Column:
    """A hash of the tokens of a sequence without an id."""
    return F.when(F.col("seq_id").isNull(), F.xxhash64("input_ids")).alias("h")


def _laned(seqs: DataFrame, sizes: DataFrame, lane_tokens: int, default_size: int) -> DataFrame:
    """Rows of seqs (with n) with capacity and lane, each lane within one partition and in order."""
    per_shard = seqs.groupBy("dataset", "shard_index").agg(F.sum("n").alias("total"))
    per_shard = per_shard.join(sizes.withColumnRenamed("dataset", "_d"), F.col("dataset").eqNullSafe(F.col("_d")), "left")
    per_shard = per_shard.select(F.col("dataset").alias("_d"), F.col("shard_index").alias("_s"), F.coalesce("pack_size", F.lit(default_size)).alias("pack_size"), F.ceil(F.col("total") / lane_tokens).alias("_lanes"))
    out = seqs.join(per_shard, F.col("dataset").eqNullSafe(F.col("_d")) & F.col("shard_index").eqNullSafe(F.col("_s"))).drop("_d", "_s")
    # sequences without an id are spread by their content
    key = F.coalesce(F.col("seq_id").cast("string"), F.concat(F.lit("h"), F.col("h").cast("string")))
    out = out.withColumn("lane", F.pmod(F.xxhash64(key), F.greatest("_lanes", F.lit(1))).cast("int")).drop("_lanes")
    return out.repartition("dataset", "shard_index", "lane").sortWithinPartitions("dataset", "shard_index", "lane", "seq_id")


_GROUP = "dataset string, shard_index int, lane int, bin long, pack_size int"


def placements(seqs: DataFrame, sizes: DataFrame, *, open_bins: int = OPEN_BINS, lane_tokens: int = LANE_TOKENS, default_size: int = DEFAULT_SIZE) -> DataFrame:
    """(dataset, shard_index, lane, bin, pack_size, pos, seq_id, start, tokens, pieces): where each piece of each sequence goes; only lengths are shuffled."""
    narrow = seqs.select("dataset", "shard_index", F.col("seq_id").cast("long").alias("seq_id"), F.coalesce(F.size("input_ids"), F.lit(0)).alias("n"), _content()).where("n > 0")
    laned = _laned(narrow, sizes, lane_tokens, default_size).select("dataset", "shard_index", "lane", "seq_id", "n", "pack_size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), [None] * b.num_rows))
        out: list[tuple] = []
        for group, capacity, number, b in _streamed(rows, open_bins):
            out += [(*group, number, capacity, pos, seq_id, start, n, parts) for pos, (seq_id, start, n, parts, _) in enumerate(b)]
            if len(out) > 20_000:
                yield made(out)
                out = []
        if out:
            yield made(out)

    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    names = ["dataset", "shard_index", "lane", "bin", "pack_size", "pos", "seq_id", "start", "tokens", "pieces"]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return laned.mapInArrow(run, _GROUP + ", pos int, seq_id long, start int, tokens int, pieces int")


def pack(seqs: DataFrame, sizes: DataFrame, *, open_bins: int = OPEN_BINS, lane_tokens: int = LANE_TOKENS, default_size: int = DEFAULT_SIZE) -> DataFrame:
    """The containers: seq_ids, input_ids, loss_mask (shifted left by one inside each item, last 0) and seq_start_id; sequences are shuffled once."""
    narrow = seqs.select("dataset", "shard_index", F.col("seq_id").cast("long").alias("seq_id"), F.coalesce(F.size("input_ids"), F.lit(0)).alias("n"), _content(), "input_ids", "loss_mask").where("n > 0")
    laned = _laned(narrow, sizes, lane_tokens, default_size).select("dataset", "shard_index", "lane", "seq_id", "n", "pack_size", "input_ids", "loss_mask")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            ids, masks = b.column(6), b.column(7)
            for i, r in enumerate(zip(*(b.column(k).to_pylist() for k in range(6)))):
                mask = masks[i].values
                yield (*r, (ids[i].values.to_numpy(zero_copy_only=False).astype(np.int32), None if mask is None else mask.to_numpy(zero_copy_only=False).astype(np.int32)))

    def made(bins: list[tuple]) -> pa.RecordBatch:
        groups, seq_ids, starts, ids, masks = [], [], [], [], []
        for group, capacity, number, b in bins:
            groups.append((*group, number, capacity))
            seq_ids.append([x[0] for x in b])
            starts.append(np.cumsum([0, *(x[2] for x in b[:-1])]).astype(np.int32))
            ids.append(np.concatenate([x[4][0][x[1] : x[1] + x[2]] for x in b]))
            shifted = []
            for _, start, n, _, (_, mask) in b:
                m = np.ones(n, np.int32)
                if mask is not None:
                    part = mask[start : start + n]
                    m[: len(part)] = part
                shifted.append(np.append(m[1:], np.int32(0)))
            masks.append(np.concatenate(shifted))
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
        arrays = [pa.array(c, k) for c, k in zip(zip(*groups), kinds)]
        return pa.RecordBatch.from_arrays(
            [*arrays, pa.array(seq_ids, pa.list_(pa.int64())), pa.array(ids, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.int32())), pa.array(starts, pa.list_(pa.int32()))],
            ["dataset", "shard_index", "lane", "bin", "pack_size", "seq_ids", "input_ids", "loss_mask", "seq_start_id"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, tokens = [], 0
        for x in _streamed(rows(batches), open_bins):
            out.append(x)
            tokens += x[1]
            if tokens > 1_000_000:
                yield made(out)
                out, tokens = [], 0
        if out:
            yield made(out)

    return laned.mapInArrow(run, _GROUP + ", seq_ids array<long>, input_ids array<int>, loss_mask array<int>, seq_start_id array<int>")


def held(packed: DataFrame) -> DataFrame:
    """(pack_id, pack_size, seq_id, tokens): what each container holds of each item; repeated containers count once.

    A further entry in seq_start_id, the end of the last item, is ignored.
    """
    one = packed.select("pack_id", "pack_size", "seq_ids", "seq_start_id", F.coalesce(F.size("input_ids"), F.lit(0)).alias("n")).dropDuplicates(["pack_id"])
    items = one.select("pack_id", "pack_size", "n", "seq_start_id", F.size("seq_ids").alias("k"), F.posexplode("seq_ids").alias("i", "seq_id"))
    end = F.when(F.col("i") + 1 < F.col("k"), F.get("seq_start_id", F.col("i") + 1)).otherwise(F.col("n"))
    return items.groupBy("pack_id", "pack_size", "seq_id").agg(F.sum(end - F.get("seq_start_id", F.col("i"))).cast("long").alias("tokens"))


def needless_cuts(packed: DataFrame, seqs: DataFrame, **options: int) -> DataFrame:
    """(pack_id, seq_id) of items of which a container holds less than the packing of the same sequences shows to fit into one."""
    whole = placements(seqs, capacities(packed), **options).where("pieces = 1").select("seq_id", F.col("tokens").alias("length")).distinct()
    return held(packed).join(whole, "seq_id").where("tokens < length and length <= pack_size").select("pack_id", "seq_id").distinct()


def fill(packs: DataFrame) -> DataFrame:
    """Containers, items, tokens and the share of used space of each dataset."""
    out = packs.groupBy("dataset").agg(F.count("*").alias("packs"), F.sum(F.size("seq_ids")).alias("items"), F.sum(F.size("input_ids")).alias("tokens"), F.sum(F.col("pack_size").cast("long")).alias("space"))
    return out.select("dataset", "packs", "items", "tokens", F.round(F.col("tokens") / F.col("space"), 4).alias("fill"))
