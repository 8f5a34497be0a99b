"""Joins by nearness and range, sessions, and tabular preprocessing."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quernstone.session import materialize

#: Rows of a block of the range join, and of its slices of points and of ranges.
BLOCK_ROWS, POINT_ROWS, RANGE_ROWS = 256, 16_384, 2_048


def asof_join(left: DataFrame, right: DataFrame, by: list[str], on: str, values: list[str]) -> DataFrame:
    """left with the values of the last row of right, by key, at or before its own `on`.

    One shuffle of the union by key and a running last value; there is no join, so a key's rows meet once whatever their number.
    """
    a = left.withColumn("_side", F.lit(1)).withColumn("_v", F.lit(None).cast(right.select(F.struct(*values)).schema[0].dataType))
    cols = [c for c in left.columns if c not in {*by, on}]
    b = right.select(*by, on, F.lit(0).alias("_side"), F.struct(*values).alias("_v"))
    both = a.select(*by, on, "_side", "_v", F.struct(*cols).alias("_row")).unionByName(b, allowMissingColumns=True)
    last = F.last("_v", ignorenulls=True).over(W.partitionBy(*by).orderBy(on, "_side").rowsBetween(W.unboundedPreceding, 0))
    return both.withColumn("_l", last).where("_side = 1").select(*by, on, "_row.*", *(F.col(f"_l.{v}").alias(v) for v in values))


def blocks(df: DataFrame, order: list[str], lo: str, hi: str, slice_rows: int) -> DataFrame:
    """Rows of a bucket `_b` that are next to each other in the order, a slice in one row: its blocks with their rows, least lo and most hi, and those of the slice.

    It must be written before it is used twice; rows are sorted by all columns that can be, so that a repeated task makes the same blocks.
    """
    cols = [c for c in df.columns if c != "_b"]
    by = ["_b", *order, *(f.name for f in df.schema if f.name not in {"_b", *order} and not re.search("map<|variant", f.dataType.simpleString()))]
    n = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_n", F.monotonically_increasing_id())
    ends = lambda x, y: (F.min(x).alias("least"), F.max(y).alias("most"))
    small = n.groupBy("_b", F.floor(F.col("_n") / BLOCK_ROWS).alias("_n")).agg(F.collect_list(F.struct(*cols)).alias("rows"), *ends(lo, hi))
    large = small.groupBy("_b", F.floor(F.col("_n") * BLOCK_ROWS / slice_rows).alias("_n"))
    return large.agg(F.collect_list(F.struct("rows", "least", "most")).alias("blocks"), *ends("least", "most")).drop("_n")


def range_join(points: DataFrame, ranges: DataFrame, at: str, lo: str, hi: str, width: float) -> DataFrame:
    """Points with every range lo <= at < hi, by an equi-join on buckets of `width`; wide ranges take several buckets.

    Slices of points meet slices of ranges, so that no task gets a whole bucket, whatever it holds. A block of ranges comes out over and over, once a point,
    and a task has few slices, so that columnar files keep the pairs in about a tenth of a byte each.
    """
    p = points.where(F.col(at).isNotNull()).withColumn("_b", F.floor(F.col(at) / width))
    r = ranges.withColumn("_b", F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width))))
    p = materialize(blocks(p, [at], at, at, POINT_ROWS), "points").select("_b", *(F.col(c).alias(f"_p_{c}") for c in ("blocks", "least", "most")))
    r = materialize(blocks(r, [lo, hi], lo, hi, RANGE_ROWS), "ranges").select("_b", *(F.col(c).alias(f"_r_{c}") for c in ("blocks", "least", "most")))
    meet = (F.col("_p_most") >= F.col("_r_least")) & (F.col("_p_least") < F.col("_r_most"))
    n = max(1, p.drop("_p_blocks").join(r.drop("_r_blocks"), "_b").where(meet).count())
    pairs = p.join(r, "_b").where(meet).select("_p_blocks", "_r_blocks").repartition(n)
    pairs = pairs.select("_p_blocks", F.inline("_r_blocks").alias("_r_rows", "_r_least", "_r_most"))
    pairs = pairs.select("_r_rows", "_r_least", "_r_most", F.inline("_p_blocks").alias("_p_rows", "_p_least", "_p_most")).where(meet)
    # coalesce changes no partition; it ends the generated code, which would hold all pairs of two slices at once
    pairs = pairs.select("_p_rows", "_r_rows").coalesce(n)
    pairs = pairs.select("_r_rows", F.inline("_p_rows").alias(*points.columns)).select(*points.columns, F.inline("_r_rows").alias(*ranges.columns))
    return pairs.where((F.col(at) >= F.col(lo)) & (F.col(at) < F.col(hi)))


def sessions(df: DataFrame, by: list[str], at: str, gap_seconds: int) -> DataFrame:
    """df with a session number from 0: a new one after a gap longer than that."""
    w = W.partitionBy(*by).orderBy(at)
    late = F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(F.lag(at).over(w).cast("timestamp")) > gap_seconds * 1_000_000
    return df.withColumn("_new", F.coalesce(late.cast("int"), F.lit(0))).withColumn("session", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def complete_left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left join whose rows must all find a partner; else an error at run time."""
    out = left.join(right.withColumn("_there", F.lit(True)), key, "left")
    return out.where(F.when(F.col("_there").isNull(), F.raise_error(F.concat(F.lit(f"no partner for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("boolean")).otherwise(True)).drop("_there")


def standardized(df: DataFrame, numeric: list[str]) -> DataFrame:
    """Numbers with nulls set to the median, less the mean, in standard deviations of the population; constants become 0."""
    medians = df.agg(*(F.median(c).alias(c) for c in numeric))
    filled = df.join(F.broadcast(medians.select(*(F.col(c).alias(f"_m_{c}") for c in numeric)))).withColumns({c: F.coalesce(c, f"_m_{c}") for c in numeric}).drop(*(f"_m_{c}" for c in numeric))
    stats = filled.agg(*(F.struct(F.avg(c).alias("a"), F.stddev_pop(c).alias("s")).alias(f"_s_{c}") for c in numeric))
    return filled.join(F.broadcast(stats)).withColumns({c: F.coalesce((F.col(c) - F.col(f"_s_{c}.a")) / F.nullif(F.col(f"_s_{c}.s"), F.lit(0.0)), F.lit(0.0)) for c in numeric}).drop(*(f"_s_{c}" for c in numeric))


def one_hot(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """A 0/1 column for each value; unknown values have none."""
    return df.withColumns({f"{col}_{v}": (F.col(col) == v).cast("int") for v in values})
