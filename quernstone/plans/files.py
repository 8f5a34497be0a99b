"""Queries of sources, sinks and streams: what is written and read again, or read bit by bit."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.operators import packing, transforms
from quernstone.plans.base import query
from quernstone.plans.chat import conversations
from quernstone.plans.corpus import docs
from quernstone.plans.packing import _NEXT_FIT, sequences
from quernstone.session import shared_dir, table
from quernstone.sources import readers, sinks
from quernstone.streaming import windows


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that all executors share."""
    return f"{shared_dir(spark).removeprefix('file://').rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("SELECT doc_id, md5(text) AS digest, lang FROM documents")
def jsonl_round_trip(spark, sf_dir):
    to = folder(spark, "jsonl")
    sinks.write_jsonl(docs(spark, sf_dir).select("doc_id", "text", "lang").repartition(3, "doc_id"), to)
    back = readers.read(spark, to, ["doc_id", "text", "lang"], "doc_id long, text string, lang string")
    return back.select("doc_id", F.md5("text").alias("digest"), "lang")


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(n_chars AS VARCHAR) AS n_chars, CAST(crawl_ts IS NULL AS VARCHAR) AS undated FROM documents")
def csv_records(spark, sf_dir):
    to = folder(spark, "csv") + "/rows.csv"
    docs(spark, sf_dir).select("doc_id", "n_chars", F.col("crawl_ts").isNull().alias("undated")).write.option("header", "true").csv(to)
    return readers.read_records(spark, to)


@query("SELECT len(input_ids) AS n, md5(array_to_string(input_ids, ',')) AS digest, count(*) AS times FROM token_sequences WHERE len(input_ids) > 0 GROUP BY 1, 2")
def token_file_round_trip(spark, sf_dir):
    """Sequences in token files with an index, read again; equal ones are counted."""
    files = sinks.write_token_files(table(spark, sf_dir, "token_sequences").repartition(4, "seq_id"), "input_ids", folder(spark, "tokens"))
    back = sinks.read_token_files(spark, [f[1] for f in files])
    digest = F.md5(F.array_join(F.transform("input_ids", lambda x: x.cast("string")), ","))
    return back.groupBy(F.size("input_ids").cast("long").alias("n"), digest.alias("digest")).agg(F.count("*").alias("times"))


@query(_NEXT_FIT + " SELECT count(*) AS bins, sum(used) AS tokens FROM (SELECT dataset, shard_index, bin, max(used) AS used FROM b GROUP BY ALL)")
def packed_round_trip(spark, sf_dir):
    """Containers in the packed Parquet form, read again."""
    s = sequences(spark, sf_dir)
    bins = packing.next_fit_fold(s, ["dataset", "shard_index"], "seq_id", "n", 1024)
    out = packing.materialize_bins(s.join(bins.select("seq_id", "bin"), "seq_id"), ["dataset", "shard_index", "bin"], "seq_id", "input_ids", "loss_mask", 1024)
    to = folder(spark, "packed")
    sinks.write_packed(out, to)
    return spark.read.parquet(to).agg(F.count("*").alias("bins"), F.sum(F.size("input_ids")).alias("tokens"))


@query("SELECT doc_id, md5(text) AS digest, strlen(text) AS bytes FROM documents WHERE text IS NOT NULL")
def tar_round_trip(spark, sf_dir):
    """Texts in tar shards, each read alone at the place that the index names."""
    index = sinks.write_tar_shards(docs(spark, sf_dir).repartition(3, "doc_id"), "doc_id", "text", folder(spark, "tar"))
    back = sinks.read_tar_members(index)
    return back.select(F.col("key").cast("long").alias("doc_id"), F.md5("text").alias("digest"), F.octet_length("text").cast("long").alias("bytes"))


@query("SELECT 2 AS version, count(*) AS docs FROM documents WHERE lang IS NOT NULL")
def artifact_versions(spark, sf_dir):
    """The newest of two versions of an artifact."""
    store = sinks.Artifacts(folder(spark, "artifacts"))
    store.publish("docs", docs(spark, sf_dir).select("doc_id"))
    store.publish("docs", docs(spark, sf_dir).where("lang is not null").select("doc_id"))
    version = int(os.path.basename(os.path.dirname(store.path("art://docs"))).removeprefix("v"))
    return store.read(spark, "art://docs").agg(F.lit(version).alias("version"), F.count("*").alias("docs"))


@query("SELECT DISTINCT record_id, 1 + CAST(user_query IS NOT NULL AS INTEGER) + CAST(assistant_response IS NOT NULL AS INTEGER) AS turns, md5(coalesce(assistant_response, '')) AS digest FROM sdg_chat")
def openai_chat_records(spark, sf_dir):
    out = transforms.openai_chat(conversations(spark, sf_dir), keep=("record_id",))
    said = F.filter("messages", lambda m: m["role"] == "assistant")
    return out.select("record_id", F.size("messages").alias("turns"), F.md5(F.coalesce(F.get(said, F.lit(0))["content"], F.lit(""))).alias("digest"))


@query("SELECT DISTINCT record_id, 1 + CAST(user_query IS NOT NULL AS INTEGER) + CAST(assistant_response IS NOT NULL AS INTEGER) AS turns, CASE WHEN channel = 'chat' THEN 1 END AS tools FROM sdg_chat")
def rl_records(spark, sf_dir):
    """Messages and tools of prepared requests; a request without tools has none."""
    tools = F.when(F.col("channel") == "chat", F.array(F.lit("search"))).otherwise(F.array().cast("array<string>"))
    chats = table(spark, sf_dir, "sdg_chat").select("record_id", "channel").distinct()
    rows = conversations(spark, sf_dir).join(chats, "record_id").select("record_id", F.struct(F.col("messages").alias("input"), tools.alias("tools")).alias("responses_create_params"))
    return transforms.rl_extract(rows, keep=("record_id",)).select("record_id", F.size("messages").alias("turns"), F.when(F.col("tools").isNotNull(), F.size("tools")).alias("tools"))


EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _streamed(spark: SparkSession, sf_dir: str, files: int = 3) -> DataFrame:
    """The events as a stream of files, one a batch."""
    source = folder(spark, "events")
    table(spark, sf_dir, "events").repartition(files, "event_id").write.parquet(source)
    return windows.read_increments(spark, source, EVENTS, 1).withColumn("at", F.col("ts").cast("timestamp"))


@query("SELECT event_id, user_id, value FROM events")
def stream_ingestion(spark, sf_dir):
    """Files read one after another, each once, every batch in a folder of its number."""
    to = folder(spark, "ingested")
    stream = _streamed(spark, sf_dir).select("event_id", "user_id", "value")
    windows.ingest(stream, lambda df, n: df.write.mode("overwrite").parquet(f"{to}/batch={n}"), folder(spark, "offsets"))
    return spark.read.parquet(to).select("event_id", "user_id", "value")


@query("SELECT time_bucket(INTERVAL '6 hours', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_windows(spark, sf_dir):
    """Counts and sums in windows of six hours, over three batches."""
    to = folder(spark, "windows")
    stream = windows.windowed(_streamed(spark, sf_dir), "at", ["event_type"], "6 hours", "1 day", value="value")
    windows.ingest(stream, lambda df, n: df.write.mode("overwrite").parquet(f"{to}/{n}"), folder(spark, "offsets"), "complete")
    last = max(int(d) for d in os.listdir(to) if d.isdigit())
    out = spark.read.parquet(f"{to}/{last}")
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_deduplication(spark, sf_dir):
    """The first row of each user and type, over three batches."""
    to = folder(spark, "distinct")
    stream = windows.deduplicated(_streamed(spark, sf_dir), ["user_id", "event_type"], "at", "10000 days").select("user_id", "event_type")
    windows.ingest(stream, lambda df, n: df.write.mode("overwrite").parquet(f"{to}/batch={n}"), folder(spark, "offsets"))
    return spark.read.parquet(to).select("user_id", "event_type")
