"""Queries of packing, shards and blends."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.functions.text import n_tokens
from quernstone.operators import blending, packing
from quernstone.plans.base import query
from quernstone.plans.corpus import docs
from quernstone.session import table

_SEQ = "SELECT DISTINCT ON (seq_id) seq_id, dataset, shard_index, input_ids, loss_mask, len(input_ids) AS n FROM token_sequences WHERE len(input_ids) > 0"


def sequences(spark, sf_dir):
    """The sequences, each once, with their lengths."""
    s = table(spark, sf_dir, "token_sequences").where(F.size("input_ids") > 0)
    return s.dropDuplicates(["seq_id"]).withColumn("n", F.size("input_ids"))


_NEXT_FIT = f"""WITH RECURSIVE s AS (SELECT dataset, shard_index, seq_id, least(n, 1024) AS n, row_number() OVER (PARTITION BY dataset, shard_index ORDER BY seq_id) AS r FROM ({_SEQ})),
b AS (SELECT dataset, shard_index, seq_id, r, n AS used, 0 AS bin FROM s WHERE r = 1
UNION ALL SELECT s.dataset, s.shard_index, s.seq_id, s.r, CASE WHEN used + s.n > 1024 THEN s.n ELSE used + s.n END, CASE WHEN used + s.n > 1024 THEN bin + 1 ELSE bin END FROM b JOIN s ON s.dataset = b.dataset AND s.shard_index = b.shard_index AND s.r = b.r + 1)"""


@query(_NEXT_FIT + " SELECT dataset, shard_index, seq_id, CAST(bin AS BIGINT) AS bin FROM b")
def next_fit_packing(spark, sf_dir):
    return packing.next_fit_fold(sequences(spark, sf_dir), ["dataset", "shard_index"], "seq_id", "n", 1024).select("dataset", "shard_index", "seq_id", "bin")


@query()
def first_fit_decreasing_packing(spark, sf_dir):
    return packing.assign_bins(sequences(spark, sf_dir), ["dataset", "shard_index"], "seq_id", "n", 1024, "first_fit_decreasing").select("dataset", "shard_index", "lane", "seq_id", "bin")


@query()
def first_fit_shuffle_packing(spark, sf_dir):
    return packing.assign_bins(sequences(spark, sf_dir), ["dataset", "shard_index"], "seq_id", "n", 1024, "first_fit_shuffle", 42).select("dataset", "shard_index", "lane", "seq_id", "bin")


@query()
def packing_efficiency(spark, sf_dir):
    bins = packing.assign_bins(sequences(spark, sf_dir), ["dataset", "shard_index"], "seq_id", "n", 1024)
    bins = bins.select(F.concat_ws("/", "dataset", "shard_index").alias("shard"), F.concat_ws("/", "lane", "bin").alias("bin"), "length")
    return packing.packing_metrics(bins, 1024)


@query(
    f"""{_NEXT_FIT}, c AS (SELECT dataset, shard_index, CAST(bin AS BIGINT) AS bin, seq_id, list_slice(input_ids, 1, 1024) AS i, list_slice(coalesce(loss_mask, list_transform(input_ids, lambda x: 1)), 1, 1024) AS m FROM ({_SEQ}) JOIN (SELECT seq_id, bin FROM b) USING (seq_id)),
f AS (SELECT dataset, shard_index, bin, list_slice(flatten(list(i ORDER BY seq_id)), 1, 1024) AS ids, list_slice(flatten(list(list_append(list_slice(m, 2, len(m)), 0) ORDER BY seq_id)), 1, 1024) AS mask, list(len(i) ORDER BY seq_id) AS lens FROM c GROUP BY ALL)
SELECT dataset, shard_index, bin, md5(array_to_string(ids, ',')) AS ids, md5(array_to_string(mask, ',')) AS mask, array_to_string(list_filter(list_transform(range(0, len(lens)), lambda k: coalesce(list_sum(list_slice(lens, 1, k)), 0)::BIGINT), lambda p: p < 1024), ',') AS starts FROM f"""
)
def materialized_packs(spark, sf_dir):
    s = sequences(spark, sf_dir)
    bins = packing.next_fit_fold(s, ["dataset", "shard_index"], "seq_id", "n", 1024)
    items = s.join(bins.select("seq_id", "bin"), "seq_id")
    out = packing.materialize_bins(items, ["dataset", "shard_index", "bin"], "seq_id", "input_ids", "loss_mask", 1024)
    joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return out.select("dataset", "shard_index", "bin", F.md5(joined("input_ids")).alias("ids"), F.md5(joined("loss_mask")).alias("mask"), joined("seq_start_id").alias("starts"))


@query("SELECT dataset, count(*) AS sequences, sum(len(input_ids)) AS tokens, min(len(input_ids)) AS shortest, max(len(input_ids)) AS longest, count(DISTINCT shard_index) AS shards FROM (SELECT DISTINCT ON (seq_id) * FROM token_sequences WHERE len(input_ids) > 0) GROUP BY 1")
def receipt_rollup(spark, sf_dir):
    return sequences(spark, sf_dir).groupBy("dataset").agg(F.count("*").alias("sequences"), F.sum("n").alias("tokens"), F.min("n").cast("long").alias("shortest"), F.max("n").cast("long").alias("longest"), F.countDistinct("shard_index").alias("shards"))


_SHARDS = "SELECT coalesce(source, '?') AS source, doc_id // 100 AS shard, count(*) AS n FROM documents GROUP BY 1, 2"


@query(
    f"""WITH sh AS ({_SHARDS}), p AS (SELECT source, sum(n) AS total, 1 + length(source) % 3 AS w FROM sh GROUP BY 1), q AS (SELECT source, total, w / sum(w) OVER () AS share FROM p), t AS (SELECT min(total / share) AS t FROM q),
x AS (SELECT sh.*, share * t AS target, coalesce(sum(n) OVER (PARTITION BY source ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, row_number() OVER (PARTITION BY source ORDER BY shard) AS r FROM sh JOIN q USING (source) CROSS JOIN t),
y AS (SELECT *, min(CASE WHEN r = 1 OR abs(before + n - target) < abs(before - target) THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY shard) AS ok FROM x)
SELECT source, shard, n FROM y WHERE ok = 1"""
)
def weighted_shard_selection(spark, sf_dir):
    d = docs(spark, sf_dir).select(F.coalesce("source", F.lit("?")).alias("source"), F.expr("doc_id div 100").alias("shard"))
    shards = d.groupBy("source", "shard").agg(F.count("*").alias("n")).withColumn("w", (1 + F.length("source") % 3).cast("double"))
    return blending.select_shards(shards, "source", "shard", "n", "w").select("source", "shard", "n")


_U = "CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 15)) AS BIGINT) / 1152921504606846976.0"


@query(
    f"""WITH c AS (SELECT DISTINCT product, issue, 1.0 + length(product) % 5 AS w FROM (SELECT product, min(coalesce(issue, '')) AS issue FROM sdg_seeds GROUP BY product)),
f AS (SELECT product, (sum(w) OVER (ORDER BY product ROWS UNBOUNDED PRECEDING) - w) / sum(w) OVER () AS lo, sum(w) OVER (ORDER BY product ROWS UNBOUNDED PRECEDING) / sum(w) OVER () AS hi FROM c)
SELECT event_id, product FROM events JOIN f ON {_U} >= lo AND {_U} < hi"""
)
def weighted_category_draws(spark, sf_dir):
    c = table(spark, sf_dir, "sdg_seeds").groupBy("product").agg(F.lit(1).alias("x")).where("product is not null").select("product", (F.lit(1.0) + F.length("product") % 5).alias("w"))
    return blending.weighted_draws(c, "product", "w", table(spark, sf_dir, "events").select("event_id"), "event_id")


@query("SELECT lower(trim(name)) AS name, blend, coalesce(weight, 1.0) AS weight FROM blend_sources WHERE coalesce(weight, 1.0) > 0")
def blend_data_paths(spark, sf_dir):
    b = table(spark, sf_dir, "blend_sources")
    return b.select(F.lower(F.trim("name")).alias("name"), "blend", F.coalesce("weight", F.lit(1.0)).alias("weight")).where("weight > 0")


@query("SELECT doc_id, n, doc_id // 64 AS shard, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 50 AS BIGINT) AS bundle FROM (SELECT doc_id, len(list_filter(string_split_regex(text, '[ \t\r\n]+'), lambda x: x <> '')) AS n FROM documents WHERE text IS NOT NULL)")
def document_bundles(spark, sf_dir):
    from quernstone.operators.segments import global_rank

    d = docs(spark, sf_dir).where("text is not null").select("doc_id", n_tokens(F.col("text")).cast("long").alias("n"), F.expr("doc_id div 64").alias("shard"))
    return global_rank(d, ["doc_id"], "k").select("doc_id", "n", "shard", F.expr("(k - 1) div 50").alias("bundle"))
