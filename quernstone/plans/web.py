"""Queries of web text, samples, pages and groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators import blending, segments, web
from quernstone.plans.base import query
from quernstone.plans.corpus import docs
from quernstone.session import table

_STRIP = r"trim(regexp_replace(regexp_replace(regexp_replace(text, '(?is)<script\b.*?</script>|<style\b.*?</style>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g'), ' ')"


@query(f"SELECT doc_id, {_STRIP} AS plain FROM documents WHERE text IS NOT NULL")
def tag_stripping(spark, sf_dir):
    return docs(spark, sf_dir).where("text is not null").select("doc_id", web.strip_tags(F.col("text")).alias("plain"))


@query()
def language_identification(spark, sf_dir):
    return web.languages(docs(spark, sf_dir), "doc_id", "text")


@query()
def encoding_repair(spark, sf_dir):
    return web.repair(docs(spark, sf_dir), "doc_id", "text").where("changed").select("doc_id", F.md5("text").alias("digest"))


@query()
def html_main_text(spark, sf_dir):
    d = docs(spark, sf_dir).where("text is not null").select("doc_id", F.concat(F.lit("<html><nav><a href='/'>home</a></nav><p>"), F.replace("text", F.lit("\n\n"), F.lit("</p><p>")), F.lit("</p></html>")).alias("html"))
    return web.extract(d, "doc_id", "html").select("doc_id", F.length("text").alias("chars"))


@query("SELECT doc_id, md5(text) AS digest FROM documents WHERE text IS NOT NULL")
def encoding_round_trip(spark, sf_dir):
    """Every text broken on purpose (its UTF-8 read as Latin-1) and repaired."""
    broken = docs(spark, sf_dir).where("text is not null").select("doc_id", F.decode(F.encode("text", "UTF-8"), "ISO-8859-1").alias("text"))
    return web.repair(broken, "doc_id", "text").select("doc_id", F.md5("text").alias("digest"))


_H = "CAST(('0x' || substr(md5({}), 1, 15)) AS BIGINT)"


@query(f"SELECT doc_id, substr(text, CAST(floor({_H.format('doc_id || chr(58) || 7')} / 1152921504606846976.0 * (greatest(length(text) - 200, 0) + 1)) AS BIGINT) + 1, 200) AS chunk FROM documents WHERE text IS NOT NULL")
def random_chunks(spark, sf_dir):
    return segments.random_chunk(docs(spark, sf_dir).where("text is not null"), "doc_id", "text", 200, 7)


@query(
    """WITH p AS (SELECT user_id, event_id, count(*) OVER (PARTITION BY user_id) AS n, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events),
s AS (SELECT *, CASE WHEN n > 60 THEN 8 WHEN n > 50 AND n < 60 THEN 7 WHEN n > 40 AND n < 50 THEN 6 WHEN n > 30 AND n < 40 THEN 5 WHEN n > 20 AND n < 30 THEN 4 ELSE 2 END AS size FROM p)
SELECT user_id, CAST(i // size AS BIGINT) AS win, array_to_string(list(event_id ORDER BY event_id), ',') AS pages FROM s GROUP BY user_id, i // size, size HAVING count(*) = size"""
)
def page_windows(spark, sf_dir):
    out = segments.page_windows(table(spark, sf_dir, "events").select("user_id", "event_id"), "user_id", "event_id")
    return out.select("user_id", F.col("window").alias("win"), F.array_join(F.transform("pages", lambda x: x.cast("string")), ",").alias("pages"))


@query("SELECT item_id FROM eval_items WHERE list_contains(list_transform(string_split(benchmark || ', ' || lang, ','), lambda x: trim(x)), 'en')")
def used_in_filter(spark, sf_dir):
    return table(spark, sf_dir, "eval_items").where(T.used_in(F.concat("benchmark", F.lit(", "), "lang"), "en")).select("item_id")


@query("SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 100")
def shuffled_cap(spark, sf_dir):
    return blending.shuffled(docs(spark, sf_dir), "doc_id", 42).limit(100).select("doc_id")


@query("SELECT doc_id, CAST(r AS BIGINT) AS repeat FROM (SELECT doc_id FROM documents WHERE text IS NOT NULL ORDER BY doc_id LIMIT 50 OFFSET 10), (SELECT unnest(range(0, 3)) AS r)")
def skip_take_repeat(spark, sf_dir):
    taken = docs(spark, sf_dir).where("text is not null").orderBy("doc_id").offset(10).limit(50).select("doc_id")
    return taken.withColumn("repeat", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).select("doc_id", F.col("repeat").cast("long").alias("repeat"))


@query("SELECT part, count(*) AS rows FROM (SELECT (row_number() OVER (ORDER BY record_id) - 1) // 100 AS part FROM (SELECT DISTINCT record_id FROM sdg_preference)) GROUP BY 1")
def samples_per_shard(spark, sf_dir):
    ranked = segments.global_rank(table(spark, sf_dir, "sdg_preference").select("record_id").distinct(), ["record_id"], "k")
    return ranked.groupBy(F.expr("(k - 1) div 100").alias("part")).agg(F.count("*").alias("rows"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey <= (SELECT max(k) FROM (SELECT o_orderkey AS k FROM orders ORDER BY 1 LIMIT (SELECT least(200, count(*) // 10) FROM orders))) THEN 'val' ELSE 'train' END AS split FROM orders")
def head_holdout(spark, sf_dir):
    return blending.head_holdout(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 200).select("o_orderkey", "split")


@query("SELECT item_id, CAST(item_id * 1.5 AS DOUBLE) AS x1, 'Title' AS kind, question AS content FROM eval_items WHERE question IS NOT NULL")
def page_elements(spark, sf_dir):
    e = table(spark, sf_dir, "eval_items").where("question is not null")
    raw = F.concat(F.lit("<x_"), F.format_string("%.1f", F.col("item_id") * 1.5), F.lit("><y_0.1>"), "question", F.lit("<x_0.9><y_0.2><class_Title>"))
    out = e.select("item_id", F.explode(segments.elements(raw)).alias("e"))
    return out.select("item_id", F.col("e.x1").alias("x1"), F.col("e.class").alias("kind"), F.col("e.text").alias("content"))


@query("SELECT item_id, 'tq#' || item_id AS question_key, 'tc#' || item_id || '#' || (i - 1) AS choice_key, string_split('tc#' || item_id || '#' || (i - 1), '#')[-1] AS place FROM (SELECT item_id, unnest(range(1, len(choices) + 1)) AS i FROM eval_items)")
def id_builders(spark, sf_dir):
    e = table(spark, sf_dir, "eval_items").select("item_id", F.posexplode("choices").alias("i", "c"))
    key = F.concat(F.lit("tc#"), "item_id", F.lit("#"), "i")
    return e.select("item_id", F.concat(F.lit("tq#"), "item_id").alias("question_key"), key.alias("choice_key"), F.element_at(F.split(key, "#"), -1).alias("place"))
