"""Weighted percentiles, score bins and the ensemble bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.operators.ranges import running_sum

PERCENTILES = tuple(range(5, 100, 5))


def weighted_thresholds(df: DataFrame, score_cols: list[str], weight: Column, percentiles: tuple[int, ...] = PERCENTILES) -> DataFrame:
    """(score, p, threshold): the least score whose cumulated weight reaches p percent of the whole, for every score column.

    Equal scores are summed first; the running sum is made in ranges of the scores, so no task sorts all of them.
    """
    named = F.map_from_arrays(F.array(*map(F.lit, score_cols)), F.array(*(F.col(c).cast("double") for c in score_cols)))
    stacked = df.select(weight.alias("w"), F.explode(named).alias("score", "v"))
    sums = stacked.where("v is not null and w is not null").groupBy("score", "v").agg(F.sum("w").alias("w"))
    cdf = F.col("cw") / F.col("total")
    out = running_sum(sums, ["score"], ["v"], "w", "cw", "total").groupBy("score").agg(*(F.min(F.when(cdf >= p / 100, F.col("v"))).alias(f"_{p}") for p in percentiles))
    pairs = F.array(*(F.struct(F.lit(p).alias("p"), F.col(f"_{p}").alias("threshold")) for p in percentiles))
    return out.select("score", F.explode(pairs).alias("x")).select("score", "x.p", "x.threshold")


def binned(score: Column, thresholds: Column) -> Column:
    """The number of thresholds that are at most the score."""
    return F.aggregate(thresholds, F.lit(0), lambda a, t: a + F.when(score >= t, 1).otherwise(0))


def ensemble(df: DataFrame, score_cols: list[str], weight: Column, out: str = "ensemble_max_int") -> DataFrame:
    """df with a bin for each score and their greatest; the thresholds, 19 for each score, are one row and are broadcast."""
    t = weighted_thresholds(df, score_cols, weight).groupBy().agg(*(F.sort_array(F.collect_list(F.when(F.col("score") == c, F.col("threshold")))).alias(f"_t_{c}") for c in score_cols))
    binned_ = df.join(F.broadcast(t)).withColumns({f"{c}_int": binned(F.col(c), F.col(f"_t_{c}")) for c in score_cols}).drop(*(f"_t_{c}" for c in score_cols))
    return binned_.withColumn(out, F.greatest(*(F.col(f"{c}_int") for c in score_cols)))


def weighted_score(scores: dict[str, float], most: float = 5.0) -> Column:
    """The weighted mean of score columns of 0 to `most`, as a share of it; a null score counts 0."""
    return sum(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * w for c, w in scores.items()) / most


def metric_summary(df: DataFrame, metrics: list[str]) -> DataFrame:
    """(metric, mean, std, total) of numeric columns over all rows, in one pass; std is that of the whole population."""
    stats = F.array(*(F.struct(F.lit(m).alias("metric"), F.avg(m).alias("mean"), F.stddev_pop(m).alias("std"), F.sum(F.col(m).cast("double")).alias("total")) for m in metrics))
    return df.agg(stats.alias("m")).select(F.explode("m").alias("m")).select("m.*")
