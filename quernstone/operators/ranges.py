"""Ranks and running sums over total orders, and group minima, without a task that holds a hot key or all rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quernstone.session import materialize

#: Parts that the rows of one group are spread over.
SALTS = 64


def ranged(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """df in ranges of an order, written once, with the number of its range in _p.

    The ranges' bounds are sampled anew whenever such a plan runs, so whatever counts the ranges and whatever ranks within them must read the
    same written rows. Spark chooses how many ranges there are; rows that are equal in the order are in one.
    """
    return materialize(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "ranged")


def rank_within(df: DataFrame, groups: list[str], order: list[Column | str], out: str, size: str | None = None) -> DataFrame:
    """df with each row's rank from 1 in its group (null is a group), and with `size` the group's number of rows.

    Rows are put in ranges of group and order; a range ranks its own rows, and the counts of earlier ranges, one row a group and range, are added.
    Rows that are equal in the order have ranks in any order.
    """
    rows = ranged(df, [*groups, *order])
    counts = rows.groupBy(*groups, "_p").agg(F.count("*").alias("_n"))
    total = F.sum("_n").over(W.partitionBy(*groups))
    before = F.sum("_n").over(W.partitionBy(*groups).orderBy("_p")) - F.col("_n")
    offsets = counts.select(*(F.col(g).alias(f"_g_{i}") for i, g in enumerate(groups)), F.col("_p").alias("_q"), before.alias("_before"), total.alias("_total"))
    same = F.col("_p") == F.col("_q")
    for i, g in enumerate(groups):
        same &= F.col(g).eqNullSafe(F.col(f"_g_{i}"))
    own = F.row_number().over(W.partitionBy(*groups, "_p").orderBy(*order))
    ranked = rows.withColumn("_own", own).join(offsets, same).withColumn(out, F.col("_own") + F.col("_before"))
    return ranked.select(*df.columns, out, *([F.col("_total").alias(size)] if size else []))


def running_sum(df: DataFrame, groups: list[str], order: list[Column | str], value: str, out: str, total: str | None = None) -> DataFrame:
    """df with the sum of `value` over the rows up to each, of its group, itself included; with `total` the group's whole sum."""
    rows = ranged(df, [*groups, *order])
    sums = rows.groupBy(*groups, "_p").agg(F.sum(value).alias("_n"))
    before = F.sum("_n").over(W.partitionBy(*groups).orderBy("_p")) - F.col("_n")
    offsets = sums.select(*(F.col(g).alias(f"_g_{i}") for i, g in enumerate(groups)), F.col("_p").alias("_q"), before.alias("_before"), F.sum("_n").over(W.partitionBy(*groups)).alias("_total"))
    same = F.col("_p") == F.col("_q")
    for i, g in enumerate(groups):
        same &= F.col(g).eqNullSafe(F.col(f"_g_{i}"))
    own = F.sum(value).over(W.partitionBy(*groups, "_p").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    summed = rows.withColumn("_own", own).join(offsets, same).withColumn(out, F.col("_own") + F.col("_before"))
    return summed.select(*df.columns, out, *([F.col("_total").alias(total)] if total else []))


def with_group_min(rows: DataFrame, keys: list[str], value: str, least: str, count: str, salts: int = SALTS) -> DataFrame:
    """rows with the least `value` and the number of rows of their group, for groups that no task could hold.

    Groups are cut into `salts` parts by a hash of the value; parts are aggregated, then groups, and the rows meet their part's row, never their
    group's. Keys must not be null.
    """
    own = rows.withColumn("_salt", F.pmod(F.xxhash64(value), F.lit(salts)).cast("int"))
    parts = own.groupBy(*keys, "_salt").agg(F.min(value).alias("_m"), F.count("*").alias("_n"))
    whole = parts.groupBy(*keys).agg(F.min("_m").alias(least), F.sum("_n").alias(count))
    return own.join(parts.select(*keys, "_salt").join(whole, keys), [*keys, "_salt"]).drop("_salt")


def restarting_blocks(df: DataFrame, keys: list[str], order: str, value: str, limit: int, out: str) -> DataFrame:
    """df with the number from 0 of each row's block: rows of a key, in order, share a block while their values sum to `limit` at most.

    Where a block ends depends on where it began, so a key's rows are taken one after another, but as a stream: a task holds a batch and a sum. Values
    are not null; a value above the limit is a block of its own.
    """
    places = [df.columns.index(k) for k in keys]
    at = df.columns.index(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block, used = None, 0, 0
        for b in batches:
            numbers = []
            for key, n in zip(zip(*(b.column(i).to_pylist() for i in places)), b.column(at).to_pylist()):
                if key != last:
                    last, block, used = key, 0, n
                elif used + n > limit:
                    block, used = block + 1, n
                else:
                    used += n
                numbers.append(block)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(numbers, pa.int64())], [*b.schema.names, out])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.repartition(*keys).sortWithinPartitions(*keys, order).mapInArrow(run, f"{kinds}, `{out}` long")
