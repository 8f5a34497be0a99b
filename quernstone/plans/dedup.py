"""Queries of deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.operators import dedup
from quernstone.operators.components import components
from quernstone.operators.ranges import with_group_min
from quernstone.operators.transforms import anti
from quernstone.plans.base import query
from quernstone.plans.corpus import docs
from quernstone.session import table

_RN = "SELECT doc_id, lang, source, text, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM documents WHERE text IS NOT NULL"


@query(f"SELECT doc_id FROM ({_RN}) WHERE rn > 1")
def exact_dedup_identify(spark, sf_dir):
    return dedup.exact_duplicates(docs(spark, sf_dir), "doc_id", "text")


@query("SELECT doc_id, url, warc_id, source_id, language, file_name FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM (" + _RN + ") WHERE rn > 1)")
def exact_dedup_remove(spark, sf_dir):
    d = docs(spark, sf_dir)
    return anti(d, dedup.exact_duplicates(d, "doc_id", "text"), "doc_id").select("doc_id", "url", "warc_id", "source_id", "language", "file_name")


@query("SELECT count(*) AS num_texts, count(DISTINCT md5(text)) AS num_distinct, count(*) - count(DISTINCT md5(text)) AS num_removed FROM documents WHERE text IS NOT NULL")
def exact_dedup_counts(spark, sf_dir):
    g = dedup.exact_groups(docs(spark, sf_dir), "doc_id", "text")
    return g.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("num_texts"), F.count("*").alias("num_distinct"), F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("num_removed"))


@query()
def fuzzy_dedup_groups(spark, sf_dir):
    return dedup.fuzzy_groups(docs(spark, sf_dir), "doc_id", "text").select(F.col("node").alias("doc_id"), F.col("component").alias("group_id"))


@query()
def fuzzy_dedup_remove(spark, sf_dir):
    return dedup.fuzzy_survivors(docs(spark, sf_dir), "doc_id", "text").select("doc_id")


@query(
    """WITH RECURSIVE k AS (SELECT doc_id, md5(text) AS h FROM documents WHERE text IS NOT NULL UNION ALL SELECT doc_id, 'u' || url FROM documents WHERE url IS NOT NULL),
m AS (SELECT h, min(doc_id) AS a FROM k GROUP BY h HAVING count(*) > 1), e AS (SELECT DISTINCT m.a, k.doc_id AS b FROM k JOIN m USING (h) WHERE k.doc_id <> m.a),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT DISTINCT a AS node, a AS low FROM u UNION SELECT u.b, r.low FROM r JOIN u ON u.a = r.node)
SELECT node AS doc_id, min(low) AS component FROM r GROUP BY 1"""
)
def linked_documents(spark, sf_dir):
    """Components of documents that share a text or an address."""
    d = docs(spark, sf_dir)
    keys = d.where("text is not null").select("doc_id", F.md5("text").alias("h")).unionByName(d.where("url is not null").select("doc_id", F.concat(F.lit("u"), "url").alias("h")))
    edges = with_group_min(keys, ["h"], "doc_id", "a", "n").where("doc_id <> a").select("a", F.col("doc_id").alias("b")).distinct()
    return components(edges).select(F.col("node").alias("doc_id"), "component")


_TOKS = r"list_filter(string_split_regex(text, '[ \t\r\n]+'), lambda x: x <> '')"
_RANGES = f"""WITH t AS (SELECT doc_id, text, {_TOKS} AS w FROM documents WHERE text IS NOT NULL),
g AS (SELECT doc_id, unnest(range(0, len(w) - 24)) AS place, w FROM t WHERE len(w) >= 25),
h AS (SELECT doc_id, place, md5(array_to_string(list_slice(w, place + 1, place + 25), ' ')) AS h FROM g),
m AS (SELECT *, count(*) OVER (PARTITION BY h) AS n, row_number() OVER (PARTITION BY h ORDER BY doc_id, place) = 1 AS first FROM h),
o AS (SELECT doc_id, first, place AS start, place + 25 AS stop, CASE WHEN max(place + 25) OVER (PARTITION BY doc_id, first ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= place THEN 0 ELSE 1 END AS new FROM m WHERE n > 1),
i AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, first ORDER BY start ROWS UNBOUNDED PRECEDING) AS g FROM o),
r AS (SELECT doc_id, first, min(start) AS start, max(stop) AS stop FROM i GROUP BY doc_id, first, g)"""


@query(_RANGES + " SELECT doc_id, first, start, stop FROM r")
def repeated_ranges(spark, sf_dir):
    """Merged token ranges of 25 or more tokens that occur more than once."""
    return dedup.repeated_windows(docs(spark, sf_dir), "doc_id", "text", 25)


@query(
    _RANGES
    + """, c AS (SELECT doc_id, list(start) AS a, list(stop) AS z FROM r WHERE NOT first GROUP BY 1)
SELECT doc_id, md5(CASE WHEN a IS NULL THEN text ELSE array_to_string(list_filter(w, lambda x, k: len(list_filter(range(1, len(a) + 1), lambda q: k - 1 >= a[q] AND k - 1 < z[q])) = 0), ' ') END) AS digest FROM t LEFT JOIN c USING (doc_id)"""
)
def substring_dedup(spark, sf_dir):
    """Texts without the token ranges that an earlier place has; first occurrences stay."""
    out = dedup.substring_dedup(docs(spark, sf_dir).where("text is not null"), "doc_id", "text", 25)
    return out.select("doc_id", F.md5("text").alias("digest"))


_COS = "round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / (sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) * sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))), 6)"


@query(f"SELECT a.vec_id AS a, b.vec_id AS b, {_COS} AS similarity FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id WHERE {_COS} > 0.3")
def semantic_pairs(spark, sf_dir):
    out = dedup.semantic_pairs(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", 0.2999)
    return out.select("a", "b", F.round("similarity", 6).alias("similarity")).where("similarity > 0.3")


@query(f"SELECT e.vec_id, EXISTS (SELECT 1 FROM embeddings a, embeddings b WHERE a.label = b.label AND a.vec_id < b.vec_id AND b.vec_id = e.vec_id AND {_COS} > 0.3) AS duplicate FROM embeddings e")
def semantic_flags(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    dup = semantic_pairs(spark, sf_dir).select(F.col("b").alias("vec_id")).distinct().withColumn("duplicate", F.lit(True))
    return e.select("vec_id").join(dup, "vec_id", "left").select("vec_id", F.coalesce("duplicate", F.lit(False)).alias("duplicate"))


@query()
def semantic_clusters(spark, sf_dir):
    return dedup.kmeans_clusters(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 10).select("vec_id", "cluster")
