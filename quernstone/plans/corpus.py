"""Queries over documents: filters, projections, quality, segments, splits, functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quernstone.functions import text as T
from quernstone.operators import blending, quality, segments, transforms
from quernstone.plans.base import query
from quernstone.session import materialize, table

_H = "CAST(('0x' || substr(md5({}), 1, 15)) AS BIGINT)"
_U = _H + " / 1152921504606846976.0"
_TOK = r"len(list_filter(string_split_regex({}, '[ \t\r\n]+'), lambda x: x <> ''))"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query("SELECT doc_id, lang, source FROM documents WHERE doc_id IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL")
def select_fields(spark, sf_dir):
    return transforms.select(docs(spark, sf_dir).na.drop(subset=["doc_id", "lang", "source"]), "doc_id", "lang", "source")


@query("SELECT doc_id AS id, text AS content, lang AS language_code FROM documents")
def rename_fields(spark, sf_dir):
    return transforms.rename(docs(spark, sf_dir), id="doc_id", content="text", language_code="lang")


@query("SELECT doc_id, length(text) AS chars FROM documents WHERE length(text) >= 500")
def min_chars_filter(spark, sf_dir):
    return docs(spark, sf_dir).where(F.length("text") >= 500).select("doc_id", F.length("text").alias("chars"))


@query("SELECT doc_id FROM documents WHERE text IS NOT NULL")
def null_text_drop(spark, sf_dir):
    return docs(spark, sf_dir).where(F.col("text").isNotNull()).select("doc_id")


@query("SELECT doc_id, doc_id % 7 AS part FROM documents WHERE doc_id % 7 = 3")
def row_modulus_partition(spark, sf_dir):
    return docs(spark, sf_dir).where(F.pmod("doc_id", F.lit(7)) == 3).select("doc_id", F.pmod("doc_id", F.lit(7)).alias("part"))


@query("SELECT doc_id, nullif(upper(regexp_extract(language, '''([A-Za-z]+)''', 1)), '') AS code, try_cast(nullif(regexp_extract(language, '\\[\\s*([0-9.]+)', 1), '') AS DOUBLE) AS score FROM documents WHERE upper(regexp_extract(language, '''([A-Za-z]+)''', 1)) IN ('EN', 'DE')")
def language_filter(spark, sf_dir):
    out = docs(spark, sf_dir).select("doc_id", T.language_code(F.col("language")).alias("code"), T.language_score(F.col("language")).alias("score"))
    return out.where(F.col("code").isin("EN", "DE"))


@query(f"SELECT doc_id, n FROM (SELECT doc_id, {_TOK.format('text')} AS n FROM documents) WHERE n BETWEEN 50 AND 5000")
def word_count_filter(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.n_tokens(F.col("text")).cast("long").alias("n")).where("n between 50 and 5000")


@query("SELECT doc_id FROM documents WHERE starts_with(text, 'Notes on ')")
def prefix_filter(spark, sf_dir):
    return docs(spark, sf_dir).where(F.col("text").startswith("Notes on ")).select("doc_id")


@query("SELECT count(*) AS docs, sum(length(text)) AS chars, CAST(sum(length(text)) AS BIGINT) // count(text) AS avg_chars, min(length(text)) AS min_chars, max(length(text)) AS max_chars, sum(strlen(text)) AS bytes FROM documents")
def corpus_stats(spark, sf_dir):
    d = docs(spark, sf_dir)
    n = F.length("text")
    return d.agg(F.count("*").alias("docs"), F.sum(n).alias("chars"), F.expr("sum(length(text)) div count(text)").alias("avg_chars"), F.min(n).cast("long").alias("min_chars"), F.max(n).cast("long").alias("max_chars"), F.sum(F.octet_length("text")).alias("bytes"))


@query(f"SELECT coalesce(source, '?') AS source, count(*) AS docs, sum(coalesce({_TOK.format('text')}, 0)) AS tokens, coalesce(min({_TOK.format('text')}), 0) AS min_tokens, coalesce(max({_TOK.format('text')}), 0) AS max_tokens, count(*) FILTER (WHERE text IS NULL) AS null_texts FROM documents GROUP BY 1")
def shard_stats(spark, sf_dir):
    n = F.col("n")
    d = docs(spark, sf_dir).select(F.coalesce("source", F.lit("?")).alias("source"), "text", F.when(F.col("text").isNotNull(), T.n_tokens(F.col("text"))).cast("long").alias("n"))
    return d.groupBy("source").agg(F.count("*").alias("docs"), F.sum(F.coalesce(n, F.lit(0))).alias("tokens"), F.coalesce(F.min(n), F.lit(0)).alias("min_tokens"), F.coalesce(F.max(n), F.lit(0)).alias("max_tokens"), F.count_if(F.col("text").isNull()).alias("null_texts"))


@query("SELECT DISTINCT lower(trim(source)) AS source FROM documents WHERE source IS NOT NULL ORDER BY 1")
def distinct_sources(spark, sf_dir):
    return docs(spark, sf_dir).where("source is not null").select(F.lower(F.trim("source")).alias("source")).distinct().orderBy("source")


#: Scores of a text that stand for what classifiers would say: the share of its characters that are ASCII letters, that of its tokens that are
#: distinct, and tokens a character, all from 0 to 1.
_SCORES = (
    "CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[^A-Za-z]', '', 'g')) / length(text)::DOUBLE ELSE 0 END",
    f"CASE WHEN {_TOK.format('text')} > 0 THEN len(list_distinct(list_filter(string_split_regex(text, '[ \t\r\n]+'), lambda x: x <> ''))) / {_TOK.format('text')}::DOUBLE ELSE 0 END",
    f"CASE WHEN length(text) > 0 THEN {_TOK.format('text')} / length(text)::DOUBLE ELSE 0 END",
)
_SCORED = f"""
WITH d AS (SELECT doc_id, text, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, strlen(text) AS w, {_SCORES[0]} AS s1, {_SCORES[1]} AS s2, {_SCORES[2]} AS s3 FROM d WHERE rn = 1),
l AS (SELECT doc_id, w, 's1' AS score, s1 AS v FROM s UNION ALL SELECT doc_id, w, 's2', s2 FROM s UNION ALL SELECT doc_id, w, 's3', s3 FROM s),
g AS (SELECT score, v, sum(w) AS w FROM l GROUP BY 1, 2),
c AS (SELECT score, v, sum(w) OVER (PARTITION BY score ORDER BY v) / sum(w) OVER (PARTITION BY score) AS cdf FROM g),
t AS (SELECT score, p, min(v) AS threshold FROM c, (SELECT unnest(range(5, 100, 5)) AS p) WHERE cdf >= p / 100.0::DOUBLE GROUP BY 1, 2),
b AS (SELECT l.doc_id, l.score, count(*) FILTER (WHERE l.v >= t.threshold) AS bin FROM l JOIN t USING (score) GROUP BY 1, 2),
e AS (SELECT doc_id, max(bin) AS bucket FROM b GROUP BY 1)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated documents with three scores of their text and their byte size; written once, since thresholds, bins and summaries all read it."""
    from quernstone.operators import dedup

    d = dedup.exact_survivors(docs(spark, sf_dir).where("text is not null").select("doc_id", "text"), "doc_id", "text")
    rows = d.select("doc_id", F.octet_length("text").cast("long").alias("bytes"), F.length("text").alias("n"), F.length(F.regexp_replace("text", "[^A-Za-z]+", "")).alias("letters"), T.tokens(F.col("text")).alias("t"))
    share = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    out = rows.select("doc_id", "bytes", share(F.col("letters"), F.col("n")).alias("s1"), share(F.size(F.array_distinct("t")), F.size("t")).alias("s2"), share(F.size("t"), F.col("n")).alias("s3"))
    return materialize(out, "scored")


@query(_SCORED + " SELECT score, CAST(p AS INTEGER) AS p, round(threshold, 9) AS threshold FROM t")
def weighted_thresholds(spark, sf_dir):
    out = quality.weighted_thresholds(scored(spark, sf_dir), ["s1", "s2", "s3"], F.col("bytes"))
    return out.select("score", "p", F.round("threshold", 9).alias("threshold"))


@query(_SCORED + " SELECT doc_id, CAST(bucket AS INTEGER) AS ensemble_max_int FROM e")
def ensemble_buckets(spark, sf_dir):
    return quality.ensemble(scored(spark, sf_dir), ["s1", "s2", "s3"], F.col("bytes")).select("doc_id", "ensemble_max_int")


@query(_SCORED + " SELECT CAST(bucket AS INTEGER) AS ensemble_max_int, count(*) AS docs, sum(w) AS bytes, round(min(s1), 6) AS min_s1, round(max(s1), 6) AS max_s1 FROM e JOIN s USING (doc_id) GROUP BY 1")
def quality_bucket_summary(spark, sf_dir):
    out = quality.ensemble(scored(spark, sf_dir), ["s1", "s2", "s3"], F.col("bytes"))
    return out.groupBy("ensemble_max_int").agg(F.count("*").alias("docs"), F.sum("bytes").alias("bytes"), F.round(F.min("s1"), 6).alias("min_s1"), F.round(F.max("s1"), 6).alias("max_s1"))


@query("SELECT doc_id, i - 1 AS segment_id, parts[i] AS segment FROM (SELECT doc_id, string_split(text, chr(10)) AS parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL)")
def document_segments(spark, sf_dir):
    return segments.split_lines(docs(spark, sf_dir).where("text is not null"), "doc_id", "text").select("doc_id", F.col("segment_id").cast("long").alias("segment_id"), "segment")


@query(
    f"""WITH RECURSIVE s AS (SELECT doc_id, i, parts[i] AS seg, {_TOK.format("parts[i]")} AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL)),
k AS (SELECT doc_id, seg, n, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS r FROM s WHERE n <= 64),
j AS (SELECT doc_id, r, n AS total, 1 AS block FROM k WHERE r = 1
  UNION ALL SELECT k.doc_id, k.r, CASE WHEN j.total + k.n <= 64 THEN j.total + k.n ELSE k.n END, CASE WHEN j.total + k.n <= 64 THEN block ELSE block + 1 END FROM j JOIN k ON k.doc_id = j.doc_id AND k.r = j.r + 1)
SELECT doc_id, CAST(block - 1 AS BIGINT) AS block, CAST(count(*) AS BIGINT) AS segments, CAST(max(total) AS BIGINT) AS tokens FROM j GROUP BY 1, 2"""
)
def segment_joiner(spark, sf_dir):
    out = segments.join_segments(segments.split_lines(docs(spark, sf_dir).where("text is not null"), "doc_id", "text"), "doc_id", "segment_id", "segment", 64)
    return out.select("doc_id", F.col("block").cast("long").alias("block"), F.col("segments").cast("long").alias("segments"), F.col("tokens").cast("long").alias("tokens"))


@query(
    """WITH w AS (SELECT doc_id, text, length(text) AS n, unnest(range(0, greatest(length(text) // 400, 1))) AS k FROM documents WHERE text IS NOT NULL)
SELECT doc_id, k, k * 400 AS start, CASE WHEN k = greatest(n // 400, 1) - 1 AND n >= 400 THEN n ELSE k * 400 + 400 END AS stop, md5(substr(text, CAST(k * 400 + 1 AS BIGINT), CASE WHEN k = greatest(n // 400, 1) - 1 THEN n ELSE 400 END)) AS digest FROM w"""
)
def text_windows(spark, sf_dir):
    out = segments.windows(docs(spark, sf_dir).where("text is not null"), "doc_id", "text", 400, 400)
    return out.select("doc_id", F.col("k").cast("long").alias("k"), F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), F.md5("window").alias("digest"))


@query("SELECT doc_id, CAST(c AS BIGINT) AS chunk, array_to_string(list_slice(parts, c * 5 + 1, c * 5 + 5), ' ') AS chunk_text FROM (SELECT doc_id, list_filter(string_split_regex(replace(text, chr(10), ' '), '[.!?] +'), lambda x: x <> '') AS parts, unnest(range(0, (len(list_filter(string_split_regex(replace(text, chr(10), ' '), '[.!?] +'), lambda x: x <> '')) + 4) // 5)) AS c FROM documents WHERE text IS NOT NULL)")
def sentence_chunks(spark, sf_dir):
    return segments.sentence_chunks(docs(spark, sf_dir).where("text is not null"), "doc_id", "text", 5).select("doc_id", F.col("chunk").cast("long").alias("chunk"), "chunk_text")


@query("SELECT doc_id, CASE WHEN instr(text, 'shows') > 0 THEN trim(substr(text, instr(text, 'shows') + 5), ' ') ELSE trim(text, ' ') END AS rest, array_to_string(list_filter(string_split(text, chr(10)), lambda x: x NOT IN ('', '```')), chr(10)) AS kept, regexp_replace(text, '^\"((?s:.)*)\"$', '\\1') AS bare FROM documents WHERE text IS NOT NULL")
def text_modifiers(spark, sf_dir):
    t = F.col("text")
    return docs(spark, sf_dir).where("text is not null").select("doc_id", T.slice_after(t, "shows").alias("rest"), T.without_lines(t, ["", "```"]).alias("kept"), T.without_quotes(t).alias("bare"))


@query(
    r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '```[a-z]*\n?', '', 'g'), '(?m)^#{1,6} +', '', 'g'), '!\[([^\]]*)\]\([^)]*\)', '\1', 'g'), '\[([^\]]*)\]\([^)]*\)', '\1', 'g'), '\*\*([^*\n]+)\*\*', '\1', 'g'), '\*([^*\n]+)\*', '\1', 'g'), '`([^`\n]*)`', '\1', 'g'), '(?m)^> ?', '', 'g'), '(?m)^[-*+] +', '', 'g') AS plain FROM documents WHERE text IS NOT NULL"""
)
def markdown_removal(spark, sf_dir):
    return docs(spark, sf_dir).where("text is not null").select("doc_id", T.without_markdown(F.col("text")).alias("plain"))


_B = _H.format("CAST(doc_id AS VARCHAR) || ':42'") + " % 10000"


@query(f"SELECT doc_id, CASE WHEN {_B} < 8000 THEN 'train' WHEN {_B} < 9000 THEN 'val' ELSE 'test' END AS split FROM documents")
def ratio_split(spark, sf_dir):
    return blending.ratio_split(docs(spark, sf_dir), "doc_id", {"train": 0.8, "val": 0.1, "test": 0.1}, 42).select("doc_id", "split")


_G = _H.format("coalesce(source_id, '') || ':42'") + " % 10000"


@query(f"SELECT doc_id, CASE WHEN {_G} < 8000 THEN 'train' ELSE 'test' END AS split FROM documents")
def group_split(spark, sf_dir):
    return blending.ratio_split(docs(spark, sf_dir).withColumn("g", F.coalesce("source_id", F.lit(""))), "g", {"train": 0.8, "test": 0.2}, 42).select("doc_id", "split")


@query("SELECT doc_id, CASE WHEN (SELECT count(*) FROM documents) <= 100 THEN 'train' WHEN row_number() OVER (ORDER BY doc_id) > (SELECT count(*) FROM documents) - 100 THEN 'val' ELSE 'train' END AS split FROM documents")
def tail_holdout(spark, sf_dir):
    return blending.tail_holdout(docs(spark, sf_dir), "doc_id", 100).select("doc_id", "split")


@query(f"SELECT doc_id, lang, CASE WHEN rn <= n // 10 THEN 'val' ELSE 'train' END AS split FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {_H.format('CAST(doc_id AS VARCHAR)')}, doc_id) AS rn, count(*) OVER (PARTITION BY lang) AS n FROM documents)")
def stratified_split(spark, sf_dir):
    return blending.stratified_split(docs(spark, sf_dir), "doc_id", "lang", 10).select("doc_id", "lang", "split")


@query("SELECT 'p' || (doc_id // 64) AS shard, count(*) AS docs, sha256(string_agg(doc_id || ':' || coalesce(CAST(n_chars AS VARCHAR), ''), ',' ORDER BY doc_id)) AS fingerprint FROM documents GROUP BY 1")
def shard_fingerprints(spark, sf_dir):
    d = docs(spark, sf_dir).select(F.concat(F.lit("p"), F.expr("doc_id div 64")).alias("shard"), "doc_id", F.concat_ws(":", F.col("doc_id"), F.coalesce(F.col("n_chars").cast("string"), F.lit(""))).alias("k"))
    return d.groupBy("shard").agg(F.count("*").alias("docs"), F.expr("sha2(listagg(k, ',') within group (order by doc_id), 256)").alias("fingerprint"))


@query("SELECT doc_id, n_chars FROM (SELECT doc_id, n_chars, sum(coalesce(n_chars, 0)) OVER (ORDER BY doc_id) - coalesce(n_chars, 0) AS before FROM documents) WHERE before < 100000")
def prefix_until_budget(spark, sf_dir):
    return segments.until_budget(docs(spark, sf_dir).select("doc_id", "n_chars"), "doc_id", "n_chars", 100_000).select("doc_id", "n_chars")


@query("SELECT doc_id, CAST(sum(coalesce(n_chars, 0) * 2) OVER (ORDER BY doc_id) - coalesce(n_chars, 0) * 2 AS BIGINT) AS pointer FROM documents")
def index_pointers(spark, sf_dir):
    return segments.exclusive_sum(docs(spark, sf_dir).select("doc_id", (F.coalesce("n_chars", F.lit(0)) * 2).alias("size")), "doc_id", "size", "pointer").select("doc_id", "pointer")


@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r <= 3")
def head_per_source(spark, sf_dir):
    d = docs(spark, sf_dir).select("source", "doc_id")
    return d.withColumn("r", F.row_number().over(W.partitionBy("source").orderBy("doc_id"))).where("r <= 3").select("source", "doc_id")


@query("SELECT doc_id, octet_length(encode(text)) AS bytes, length(text) AS chars, sha256(text) AS sha, base64(encode(text)) AS b64 FROM documents WHERE text IS NOT NULL")
def hash_functions(spark, sf_dir):
    return docs(spark, sf_dir).where("text is not null").select("doc_id", F.octet_length("text").cast("long").alias("bytes"), F.length("text").cast("long").alias("chars"), F.sha2("text", 256).alias("sha"), F.translate(F.base64(F.encode("text", "UTF-8")), "\r\n", "").alias("b64"))


@query("SELECT doc_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url, '([^/]*)$', 1) AS base FROM documents WHERE url IS NOT NULL")
def url_parts(spark, sf_dir):
    return docs(spark, sf_dir).where("url is not null").select("doc_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), F.regexp_extract("url", "([^/]*)$", 1).alias("base"))


@query("SELECT doc_id, CASE WHEN len(parts) >= 3 THEN array_to_string(list_slice(parts, 2, len(parts) - 1), chr(10) || chr(10)) ELSE text END AS inner_text FROM (SELECT doc_id, text, string_split(text, chr(10) || chr(10)) AS parts FROM documents WHERE text IS NOT NULL)")
def wrapper_strip(spark, sf_dir):
    return docs(spark, sf_dir).where("text is not null").select("doc_id", T.strip_wrapper(F.col("text")).alias("inner_text"))


@query("SELECT file_name, count(*) AS n FROM documents WHERE regexp_matches(coalesce(file_name, ''), '(^|/)part(-|/|\\.|$)') GROUP BY 1")
def split_name_match(spark, sf_dir):
    from quernstone.sources import discovery

    return docs(spark, sf_dir).where(discovery.matches_split(F.coalesce("file_name", F.lit("")), "part")).groupBy("file_name").agg(F.count("*").alias("n"))


@query("SELECT doc_id, lang, source FROM documents WHERE lang IN ('en', 'de') AND source LIKE 'fenweb%'")
def partition_pruned_scan(spark, sf_dir):
    from quernstone.sources import sinks

    path = sinks.partitioned(docs(spark, sf_dir).select("doc_id", "source", "lang"), ["lang"], "by-lang")
    return spark.read.parquet(path).where(F.col("lang").isin("en", "de") & F.col("source").startswith("fenweb")).select("doc_id", "lang", "source")


@query(f"SELECT split, count(*) AS docs, min(doc_id) AS first_doc FROM (SELECT doc_id, CASE WHEN {_B} < 8000 THEN 'train' WHEN {_B} < 9000 THEN 'val' ELSE 'test' END AS split FROM documents) GROUP BY 1")
def split_views(spark, sf_dir):
    """A folder for each split, read again."""
    from quernstone.sources import sinks

    split = blending.ratio_split(docs(spark, sf_dir).select("doc_id"), "doc_id", {"train": 0.8, "val": 0.1, "test": 0.1}, 42)
    back = spark.read.parquet(sinks.partitioned(split, ["split"], "splits"))
    return back.groupBy("split").agg(F.count("*").alias("docs"), F.min("doc_id").alias("first_doc"))


@query(_SCORED.replace("l AS (", f"m AS (SELECT * FROM s WHERE {_U.format("'sample:' || doc_id")} < 0.1), l AS (").replace("FROM s UNION", "FROM m UNION").replace("'s3', s3 FROM s)", "'s3', s3 FROM m)") + " SELECT score, CAST(p AS INTEGER) AS p, round(threshold, 9) AS threshold FROM t")
def sampled_thresholds(spark, sf_dir):
    """Thresholds from a tenth of the documents, drawn by their ids."""
    few = scored(spark, sf_dir).where(T.unit(F.concat(F.lit("sample:"), F.col("doc_id").cast("string"))) < 0.1)
    return quality.weighted_thresholds(few, ["s1", "s2", "s3"], F.col("bytes")).select("score", "p", F.round("threshold", 9).alias("threshold"))
