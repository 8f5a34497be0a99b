"""Classic sequence packers, containers from bins, loss masks and packing metrics."""

from __future__ import annotations

import random
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.operators.ranges import restarting_blocks


def first_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Each item, in order, into the first bin with room; a tournament tree over the bins' free space finds it in logarithmic time."""
    size = 1
    while size < max(1, len(lengths)):
        size *= 2
    free = [-1] * (2 * size)  # below 0: not open yet
    bins: list[list[int]] = []
    for i, n in enumerate(lengths):
        n = min(n, capacity)
        k = 1
        if free[1] >= n:
            while k < size:
                k = 2 * k if free[2 * k] >= n else 2 * k + 1
            b = k - size
        else:
            b = len(bins)
            bins.append([])
            k = size + b
            free[k] = capacity
        bins[b].append(i)
        free[k] -= n
        while k > 1:
            k //= 2
            free[k] = max(free[2 * k], free[2 * k + 1])
    return bins


def first_fit_decreasing(lengths: list[int], capacity: int, seed: int = 0) -> list[list[int]]:
    """first_fit over the items by falling length, equal ones in their order."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    return [[order[i] for i in b] for b in first_fit([lengths[i] for i in order], capacity)]


def first_fit_shuffle(lengths: list[int], capacity: int, seed: int = 0) -> list[list[int]]:
    order = list(range(len(lengths)))
    random.Random(seed).shuffle(order)
    return [[order[i] for i in b] for b in first_fit([lengths[i] for i in order], capacity)]


def next_fit(lengths: list[int], capacity: int, seed: int = 0) -> list[list[int]]:
    """Items in order; a bin is closed by the first that doesn't fit."""
    bins: list[list[int]] = []
    used = capacity + 1
    for i, n in enumerate(min(x, capacity) for x in lengths):
        if used + n > capacity:
            bins.append([])
            used = 0
        bins[-1].append(i)
        used += n
    return bins


PACKERS: dict[str, Callable[[list[int], int, int], list[list[int]]]] = {"first_fit_decreasing": first_fit_decreasing, "first_fit_shuffle": first_fit_shuffle, "concatenative": next_fit}


def assign_bins(df: DataFrame, shard_cols: list[str], order: str, length: str, capacity: int, algorithm: str = "first_fit_decreasing", seed: int = 0, lane_rows: int = 500_000) -> DataFrame:
    """(shard_cols, order, length, bin): bins are numbered from 0 in each shard; longer items count as the capacity.

    Shards are packed apart. One with more than lane_rows items is packed in lanes of about that many, each alone, so that no task holds a
    hot shard; only keys and lengths are sent.
    """
    pack = PACKERS[algorithm]
    narrow = df.select(*shard_cols, order, F.col(length).cast("int").alias("length"))
    sizes = narrow.groupBy(*shard_cols).agg(F.ceil(F.count("*") / lane_rows).cast("int").alias("_lanes")).toDF(*(f"_k_{c}" for c in shard_cols), "_lanes")
    same = F.lit(True)
    for c in shard_cols:
        same &= F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    laned = narrow.join(sizes, same).select(*shard_cols, order, "length", F.pmod(F.xxhash64(order), F.col("_lanes")).cast("int").alias("lane"))

    def run(keys: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(order, kind="stable").reset_index(drop=True)
        out = pd.Series(0, part.index)
        for b, items in enumerate(pack(part["length"].tolist(), capacity, seed)):
            out.iloc[items] = b
        return part.assign(bin=out.astype("int64"))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in laned.schema)
    return laned.groupBy(*shard_cols, "lane").applyInPandas(run, f"{kinds}, bin long")


def next_fit_fold(df: DataFrame, shard_cols: list[str], order: str, length: str, capacity: int) -> DataFrame:
    """(shard_cols, order, length, bin) by next_fit over a shard's ordered lengths, which are streamed; only keys and lengths are sent."""
    rows = df.select(*shard_cols, order, F.col(length).cast("int").alias("length"), F.least(F.col(length).cast("long"), F.lit(capacity)).alias("_n"))
    return restarting_blocks(rows, shard_cols, order, "_n", capacity, "bin").drop("_n")


def shifted_mask(mask: Column) -> Column:
    """Each element takes its successor's value; the last is 0."""
    return F.when(F.size(mask) > 0, F.concat(F.slice(mask, F.lit(2), F.size(mask) - 1), F.array(F.lit(0)))).otherwise(mask)


def materialize_bins(items: DataFrame, keys: list[str], order: str, ids: str, mask: str, capacity: int) -> DataFrame:
    """(keys, input_ids, loss_mask, seq_start_id): the items of a bin in a row, cut at the capacity; a null mask means ones, masks are shifted inside each item."""
    full = F.coalesce(F.col(mask), F.transform(ids, lambda _: F.lit(1)))
    rows = items.where(F.size(ids) > 0).select(*keys, F.struct(F.col(order).alias("o"), F.slice(ids, 1, capacity).alias("i"), shifted_mask(F.slice(full, 1, capacity)).alias("m")).alias("s"))
    bins = rows.groupBy(*keys).agg(F.array_sort(F.collect_list("s")).alias("s"))
    starts = F.expr(f"filter(slice(aggregate(s, cast(array(0) as array<int>), (a, x) -> array_append(a, element_at(a, -1) + size(x.i))), 1, size(s)), p -> p < {capacity})")
    return bins.select(*keys, F.slice(F.flatten(F.transform("s", lambda x: x["i"])), 1, capacity).alias("input_ids"), F.slice(F.flatten(F.transform("s", lambda x: x["m"])), 1, capacity).alias("loss_mask"), starts.alias("seq_start_id"))


def packing_metrics(bins: DataFrame, capacity: int) -> DataFrame:
    """Sequences, bins, sequences a bin and used share in percent of (shard..., length, bin) rows of one shard key `shard`."""
    per = bins.groupBy("shard").agg(F.count("*").alias("sequences"), F.countDistinct("bin").alias("bins"), F.sum(F.least("length", F.lit(capacity))).cast("long").alias("tokens"))
    return per.select("shard", "sequences", "bins", F.round(F.col("sequences") / F.col("bins"), 2).alias("packing_factor"), F.round(F.col("tokens") * 100 / (F.col("bins") * capacity), 1).alias("efficiency"))


def csr(bins: DataFrame, shard: str, order: str) -> DataFrame:
    """(shard, offsets, indices): bins as offsets into a list of items; one row a shard."""
    per = bins.groupBy(shard, "bin").agg(F.array_sort(F.collect_list(order)).alias("i"))
    rows = per.groupBy(shard).agg(F.array_sort(F.collect_list(F.struct("bin", "i"))).alias("b"))
    offsets = F.expr("aggregate(b, cast(array(0L) as array<bigint>), (a, x) -> array_append(a, element_at(a, -1) + size(x.i)))")
    return rows.select(shard, offsets.alias("offsets"), F.flatten(F.transform("b", lambda x: x["i"])).alias("indices"))

