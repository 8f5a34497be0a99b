"""Queries of records: segments, splits, samples, receipts, offsets, normalizers and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators import blending, quality, segments
from quernstone.plans.base import query
from quernstone.plans.corpus import _H, _TOK, docs
from quernstone.session import table


def d10(key: str):
    return F.pmod(T.md5_int(F.concat(F.lit(f"{key}:"), F.col("record_id").cast("string"))), F.lit(6))


def _d10(key: str) -> str:
    return f"({_H.format(f"'{key}:' || record_id")} % 6)"


_WEIGHTS = {"a": 0.35, "b": 0.3, "c": 0.15, "d": 0.1, "e": 0.1}


@query(f"SELECT record_id, round(({' + '.join(f'{_d10(k)} * {w}::DOUBLE' for k, w in _WEIGHTS.items())}) / 5.0::DOUBLE, 6) AS score FROM (SELECT DISTINCT record_id FROM sdg_preference)")
def weighted_judge_score(spark, sf_dir):
    rows = table(spark, sf_dir, "sdg_preference").select("record_id").distinct().select("record_id", *(d10(k).alias(k) for k in _WEIGHTS))
    return rows.select("record_id", F.round(quality.weighted_score(_WEIGHTS), 6).alias("score"))


@query("SELECT metric, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, sum(v)::DOUBLE AS total FROM (SELECT 'chars' AS metric, n_chars::DOUBLE AS v FROM documents UNION ALL SELECT 'bytes', strlen(text)::DOUBLE FROM documents) GROUP BY 1")
def stage_metrics(spark, sf_dir):
    d = docs(spark, sf_dir).select(F.col("n_chars").alias("chars"), F.octet_length("text").cast("long").alias("bytes"))
    return quality.metric_summary(d, ["chars", "bytes"]).select("metric", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "total")


@query("SELECT DISTINCT source_id, file_name FROM documents")
def distinct_documents(spark, sf_dir):
    return docs(spark, sf_dir).select("source_id", "file_name").dropDuplicates(["source_id", "file_name"])


@query("SELECT doc_id, CAST(sum(size) OVER (ORDER BY f NULLS FIRST, doc_id) - size AS BIGINT) AS pointer FROM (SELECT doc_id, file_name AS f, coalesce(n_chars, 0) * 2 + 12 AS size FROM documents)")
def stitched_offsets(spark, sf_dir):
    """Byte offsets of documents in files that are put together by name: two bytes a character and a separator of twelve."""
    d = docs(spark, sf_dir).select("doc_id", "file_name", (F.coalesce("n_chars", F.lit(0)) * 2 + 12).alias("size"))
    return segments.stitched(d, "file_name", "doc_id", "size", "pointer").select("doc_id", "pointer")


@query("SELECT doc_id, row_number() OVER (ORDER BY coalesce(length(text), 0), doc_id) AS place FROM documents")
def sorted_by_length(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n"))
    return segments.global_rank(d, ["n", "doc_id"], "place").select("doc_id", F.col("place").cast("long").alias("place"))


@query(f"SELECT doc_id, i - 1 AS segment_id, {_TOK.format('parts[i]')} AS tokens FROM (SELECT doc_id, string_split(text, chr(10)) AS parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL) WHERE {_TOK.format('parts[i]')} >= 8")
def segment_threshold(spark, sf_dir):
    out = segments.split_lines(docs(spark, sf_dir).where("text is not null"), "doc_id", "text")
    return out.select("doc_id", F.col("segment_id").cast("long").alias("segment_id"), T.n_tokens(F.col("segment")).cast("long").alias("tokens")).where("tokens >= 8")


@query("SELECT doc_id, warc_id, source_id, lang, source FROM documents")
def dropped_columns(spark, sf_dir):
    """Columns that aren't needed, some of which are missing, are dropped."""
    return docs(spark, sf_dir).drop("url", "language", "text", "file_name", "n_chars", "crawl_ts", "loaded_at", "score_int", "label")


@query("SELECT doc_id, regexp_extract(url, '^https?://(?:[^/]*\\.)?([a-z]+)(?:[:/]|$)', 1) AS domain FROM documents WHERE regexp_extract(url, '^https?://(?:[^/]*\\.)?([a-z]+)(?:[:/]|$)', 1) IN ('com', 'example', 'org')")
def domain_filter(spark, sf_dir):
    domain = F.regexp_extract("url", r"^https?://(?:[^/]*\.)?([a-z]+)(?:[:/]|$)", 1)
    return docs(spark, sf_dir).select("doc_id", domain.alias("domain")).where(F.col("domain").isin("com", "example", "org"))


@query("SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(replace(url, '\\', '/'), '[#?].*$', ''), '^[a-z]+://[^/]*/?', ''), '^(\\./)+', '') AS path, regexp_extract(regexp_replace(regexp_replace(replace(url, '\\', '/'), '[#?].*$', ''), '^[a-z]+://[^/]*/?', ''), '([^/]*)$', 1) AS base FROM documents WHERE url IS NOT NULL")
def path_normalization(spark, sf_dir):
    d = docs(spark, sf_dir).where("url is not null").select("doc_id", T.normalized_path(F.col("url")).alias("path"))
    return d.withColumn("base", T.base_name(F.col("path")))


@query("SELECT event_id, 'v' || user_id AS clip FROM events")
def clip_keys(spark, sf_dir):
    name = F.concat(F.lit("v"), "user_id", F.lit("_"), F.col("event_id"), F.lit("_"), F.format_string("%.2f", F.col("event_id") + 1.5))
    return table(spark, sf_dir, "events").select("event_id", T.clip_key(name).alias("clip"))


@query("SELECT record_id, array_to_string(list_filter([user_query, segment, assistant_response], lambda x: coalesce(x, '') <> ''), chr(10)) AS content FROM (SELECT DISTINCT record_id, user_query, segment, assistant_response FROM sdg_chat)")
def content_flatten(spark, sf_dir):
    rows = table(spark, sf_dir, "sdg_chat").select("record_id", "user_query", "segment", "assistant_response").distinct()
    return rows.select("record_id", T.flat_content(F.array("user_query", "segment", "assistant_response")).alias("content"))


@query(f"SELECT record_id, text, n AS length FROM (SELECT record_id, text, {_TOK.format('text')} AS n FROM (SELECT DISTINCT record_id, user_query || chr(10) || assistant_response AS text FROM sdg_chat)) WHERE n <= 60")
def concat_fit(spark, sf_dir):
    """Query and answer as one text, where that has 60 tokens at most."""
    rows = table(spark, sf_dir, "sdg_chat").select("record_id", F.concat("user_query", F.lit("\n"), "assistant_response").alias("text")).distinct()
    return rows.where("text is not null").withColumn("length", T.n_tokens(F.col("text")).cast("long")).where("length <= 60")


@query("SELECT doc_id, CASE WHEN r <= floor(n * 0.1::DOUBLE) THEN 'val' WHEN r <= floor(n * 0.1::DOUBLE) + floor(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS r, count(*) OVER () AS n FROM documents WHERE text IS NOT NULL)")
def fractional_split(spark, sf_dir):
    return blending.fractional_split(docs(spark, sf_dir).where("text is not null").select("doc_id"), "doc_id", 42, 0.1, 0.2).select("doc_id", "split")


@query("SELECT doc_id FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 25")
def audit_sample(spark, sf_dir):
    """25 rows for a person to look at."""
    return blending.shuffled(docs(spark, sf_dir).select("doc_id"), "doc_id", 7).limit(25)


@query(
    """WITH p AS (SELECT max_by(o_orderpriority, struct_pack(a := o_orderdate, b := o_orderpriority)) AS plan, max(o_orderdate) AS now FROM orders),
r AS (SELECT o_custkey AS shard, o_orderdate AS made, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'started' ELSE 'failed' END AS status FROM orders, p WHERE o_orderpriority = plan),
l AS (SELECT shard, max_by(status, struct_pack(a := made, b := status)) AS status, max(made) AS made FROM r GROUP BY shard)
SELECT c_custkey AS shard_index, CASE WHEN status = 'completed' AND c_custkey % 10 <> 3 THEN 'done' WHEN status = 'started' AND made > now - INTERVAL 90 DAY THEN 'claimed' WHEN status = 'failed' THEN 'failed' ELSE 'pending' END AS state FROM customer CROSS JOIN p LEFT JOIN l ON shard = c_custkey"""
)
def shard_states(spark, sf_dir):
    """States of shards (customers) by receipts (orders) of the newest plan; the outputs of some completed ones are missing, claims are stale after 90 days."""
    from quernstone.sources import sinks

    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "started").otherwise("failed")
    receipts = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("shard_index"), status.alias("status"), F.col("o_orderdate").alias("created_at"), F.col("o_orderpriority").alias("plan_hash"), F.concat(F.lit("out-"), "o_custkey").alias("output_file"))
    shards = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("shard_index"))
    there = shards.where("shard_index % 10 <> 3").select(F.concat(F.lit("out-"), "shard_index").alias("output_file"))
    now = receipts.agg(F.max("created_at")).first()[0]
    return sinks.shard_states(shards, receipts, F.lit(now), stale_minutes=90 * 24 * 60, outputs=there)


_SC = f"({_H.format("'faith:' || doc_id || ':' || (i - 1)")} % 50) / 10.0::DOUBLE"


@query(f"SELECT doc_id, count(*) AS kept, md5(string_agg('[' || parts[i] || ']', chr(10) ORDER BY i)) AS merged FROM (SELECT doc_id, string_split(text, chr(10)) AS parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL) WHERE {_SC} >= 2.5 GROUP BY doc_id")
def translation_merge(spark, sf_dir):
    """Segments translated one by one (here: put in brackets), those with a score of 2.5 or more merged again in order."""
    rows = segments.split_lines(docs(spark, sf_dir).where("text is not null"), "doc_id", "text")
    score = F.pmod(T.md5_int(F.concat_ws(":", F.lit("faith"), "doc_id", "segment_id")), F.lit(50)) / F.lit(10.0)
    kept = rows.where(score >= 2.5).select("doc_id", "segment_id", F.concat(F.lit("["), "segment", F.lit("]")).alias("t"))
    out = kept.groupBy("doc_id").agg(F.count("*").alias("kept"), F.array_sort(F.collect_list(F.struct("segment_id", "t"))).alias("s"))
    return out.select("doc_id", "kept", F.md5(F.array_join(F.transform("s", lambda x: x["t"]), "\n")).alias("merged"))


_KINDS = ["short", "long", "list", "table", "none"]


@query(f"SELECT record_id, product, ['short', 'long', 'list', 'table', 'none'][({_H.format("'style:' || record_id")} % 5) + 1] AS style FROM (SELECT DISTINCT record_id, seed_id FROM sdg_chat) JOIN sdg_seeds USING (seed_id)")
def category_sampler(spark, sf_dir):
    """Records with the column of their seed and one of five styles."""
    rows = table(spark, sf_dir, "sdg_chat").select("record_id", "seed_id").distinct().join(table(spark, sf_dir, "sdg_seeds").select("seed_id", "product"), "seed_id")
    return rows.select("record_id", "product", T.sampled_category(_KINDS, F.concat(F.lit("style:"), F.col("record_id").cast("string"))).alias("style"))


@query("SELECT record_id, trim(user_query) AS question, trim(regexp_extract(assistant_response, '^[^\n]+')) AS answer FROM (SELECT DISTINCT record_id, user_query, assistant_response FROM sdg_chat) WHERE regexp_matches(user_query, '^[^\n]+$') AND regexp_matches(assistant_response, '^[^\n]+')")
def generated_pairs(spark, sf_dir):
    """Question and answer lines of generated texts."""
    rows = table(spark, sf_dir, "sdg_chat").select("record_id", "user_query", "assistant_response").distinct()
    text = F.concat(F.lit("Here they are:\n\nQuestion: "), "user_query", F.lit("\nAnswer: "), "assistant_response")
    return rows.select("record_id", F.explode(T.qa_pairs(text)).alias("p")).select("record_id", "p.*")


@query("SELECT event_id, len(json_keys(props)) AS fields, json_keys(props)[1] AS first_field FROM events")
def schema_fields(spark, sf_dir):
    keys = F.json_object_keys("props")
    return table(spark, sf_dir, "events").select("event_id", F.size(keys).cast("long").alias("fields"), F.get(keys, F.lit(0)).alias("first_field"))
