"""Structured Streaming: incremental ingestion, windows with late data, deduplication, and stateful packing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_increments(spark: SparkSession, folder: str, schema: str, most_files: int | None = None) -> DataFrame:
    """Files of a folder as they arrive; with a checkpoint each is read once."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", most_files) if most_files else reader).parquet(folder)


def ingest(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """All that is there now, in batches to the sink, resuming from the checkpoint; a batch that is written again has the same number."""
    stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed(stream: DataFrame, at: str, by: list[str], length: str, late: str, slide: str | None = None, value: str | None = None) -> DataFrame:
    """Counts (and sums) in tumbling or sliding windows; rows later than `late` are left out and closed windows leave the state."""
    w = F.window(at, length, slide) if slide else F.window(at, length)
    aggs = [F.count("*").alias("n"), *([F.sum(value).alias("total")] if value else [])]
    return stream.withWatermark(at, late).groupBy(w.alias("window"), *by).agg(*aggs)


def session_counts(stream: DataFrame, at: str, by: list[str], gap: str, late: str) -> DataFrame:
    return stream.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("window"), *by).agg(F.count("*").alias("n"))


def deduplicated(stream: DataFrame, keys: list[str], at: str, late: str) -> DataFrame:
    """The first row of each key within the watermark's time."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def packed(stream: DataFrame, shard: str, item: str, length: str, capacity: int) -> DataFrame:
    """(shard, bin, items, tokens): next-fit packing of a stream; a shard's open bin is its state, closed bins are given."""

    def run(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        number, items, used = state.get if state.exists else (0, [], 0)
        items, out = list(items), []
        for part in parts:
            for i, n in zip(part[item].tolist(), part[length].clip(upper=capacity).tolist()):
                if items and used + n > capacity:
                    out.append((key[0], number, items, used))
                    number, items, used = number + 1, [], 0
                items.append(i)
                used += n
        state.update((number, items, used))
        if out:
            yield pd.DataFrame(out, columns=[shard, "bin", "items", "tokens"])

    kind = stream.schema[shard].dataType.simpleString()
    return stream.groupBy(shard).applyInPandasWithState(run, f"`{shard}` {kind}, bin long, items array<long>, tokens long", "bin long, items array<long>, used long", "append", "NoTimeout")
