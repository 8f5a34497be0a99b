"""Queries of vector search, ranking and multiple-choice questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.operators import mcq, retrieval
from quernstone.plans.base import query
from quernstone.session import table

_D = "list_dot_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) / (sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])) * sqrt(list_dot_product(c.embedding::DOUBLE[], c.embedding::DOUBLE[])))"
_RANKED = f"""WITH s AS (SELECT q.vec_id AS query_id, c.vec_id AS doc_id, q.label AS ql, c.label AS cl, {_D} AS score FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM s)"""


def ranked(spark, sf_dir, k=10):
    """The k best of all vectors for every vector whose id is divisible by 100, without itself."""
    e = table(spark, sf_dir, "embeddings")
    q = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieval.top_k(q, e.select(F.col("vec_id").alias("doc_id"), "embedding"), "query_id", "doc_id", "embedding", k, same=True)


def relevant(spark, sf_dir):
    """Documents with the query's label."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    q = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "label")
    return q.join(e.withColumnRenamed("vec_id", "doc_id"), "label").where("query_id <> doc_id").select("query_id", "doc_id")


@query(_RANKED + " SELECT query_id, doc_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10")
def vector_top_k(spark, sf_dir):
    return ranked(spark, sf_dir).select("query_id", "doc_id", F.round("score", 6).alias("score"), "rank")


@query(
    _RANKED
    + """, l AS (SELECT query_id, min(score) AS low FROM r WHERE ql = cl GROUP BY 1), n AS (SELECT r.query_id, doc_id, score, row_number() OVER (PARTITION BY r.query_id ORDER BY round(score, 9) DESC, doc_id) AS nr FROM r JOIN l USING (query_id) WHERE ql <> cl AND score <= 0.95 * low)
SELECT query_id, doc_id, round(score, 6) AS score, CAST(nr AS INTEGER) AS rank FROM n WHERE nr <= 5"""
)
def hard_negatives(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    q, c = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), e.select(F.col("vec_id").alias("doc_id"), "embedding")
    out = retrieval.hard_negatives(q, c, relevant(spark, sf_dir), "query_id", "doc_id", "embedding", 0.95, 5, same=True)
    return out.select("query_id", "doc_id", F.round("score", 6).alias("score"), "rank")


@query(
    _RANKED
    + """, rel AS (SELECT query_id, count(*) AS rel FROM r WHERE ql = cl GROUP BY 1), h AS (SELECT query_id, rank, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS seen FROM r WHERE rank <= 10 AND ql = cl),
ks AS (SELECT unnest([1, 5, 10]) AS k), p AS (SELECT rel.query_id, k, rel, sum(CASE WHEN rank <= k THEN 1 / log2(rank + 1.0) ELSE 0 END) AS dcg, sum(CASE WHEN rank <= k THEN seen / rank ELSE 0 END) AS ap, sum(CASE WHEN rank <= k THEN 1 ELSE 0 END) AS n
FROM rel CROSS JOIN ks LEFT JOIN h USING (query_id) GROUP BY ALL), i AS (SELECT *, list_sum(list_transform(range(1, least(rel, k) + 1), lambda x: 1 / log2(x + 1.0))) AS idcg FROM p)
SELECT CAST(k AS INTEGER) AS k, round(avg(dcg / idcg), 6) AS ndcg, round(avg(ap / rel), 6) AS map, round(avg(n / rel), 6) AS recall, round(avg(n / k), 6) AS precision FROM i GROUP BY k"""
)
def ranking_metrics(spark, sf_dir):
    return retrieval.ranking_metrics(ranked(spark, sf_dir), relevant(spark, sf_dir), "query_id", "doc_id")


@query(
    _RANKED
    + """, t AS (SELECT query_id, r.doc_id, length(replace(substr(text, 1, 1000), 'e', 'ee')) - length(substr(text, 1, 1000)) AS score FROM r JOIN documents d ON d.doc_id = r.doc_id WHERE rank <= 20),
z AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC NULLS LAST, doc_id) AS place FROM t)
SELECT query_id, doc_id, score, CAST(place AS INTEGER) AS rank FROM z WHERE place <= 5"""
)
def retrieve_then_rerank(spark, sf_dir):
    """Of the 20 nearest vectors the five whose documents score best (here: by a letter's frequency) in their first 1,000 characters."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    score = F.length(F.replace("text", F.lit("e"), F.lit("ee"))) - F.length("text")
    out = retrieval.reranked(ranked(spark, sf_dir, 20), d, "query_id", "doc_id", "text", score, 5, 1000)
    return out.select("query_id", "doc_id", F.col("score").cast("long").alias("score"), "rank")


@query(
    _RANKED
    + """, a AS (SELECT k, round(avg(CASE WHEN rank <= k AND ql = cl THEN 1.0::DOUBLE / k ELSE 0 END) * count(*) / count(DISTINCT query_id), 6) AS base FROM r, (SELECT unnest([1, 5, 10]) AS k) GROUP BY k)
SELECT CAST(k AS INTEGER) AS k, base, round(base * 1.25, 6) AS tuned, round(base * 0.25, 6) AS delta, CASE WHEN base = 0 THEN 0.0 ELSE 25.0 END AS percent, false AS drifted FROM a"""
)
def metric_deltas(spark, sf_dir):
    """Precision of the search against one a quarter better."""
    m = retrieval.ranking_metrics(ranked(spark, sf_dir), relevant(spark, sf_dir), "query_id", "doc_id").select("k", "precision")
    out = retrieval.metric_delta(m, m.withColumn("precision", F.col("precision") * 1.25), "k", "precision")
    return out.select("k", "base", F.round("tuned", 6).alias("tuned"), F.round("delta", 6).alias("delta"), F.round("percent", 4).alias("percent"), "drifted")


@query("SELECT query_id, count(*) AS positives FROM (SELECT q.vec_id AS query_id FROM embeddings q JOIN embeddings c ON q.label = c.label AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0) GROUP BY 1")
def relevance_counts(spark, sf_dir):
    return relevant(spark, sf_dir).groupBy("query_id").agg(F.count("*").alias("positives"))


@query("SELECT vec_id, round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 5) AS norm, len(embedding) = 64 AS ok FROM embeddings")
def vector_checks(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.round(T.norm(F.col("embedding")), 5).alias("norm"), T.is_finite(F.col("embedding"), 64).alias("ok"))


@query("SELECT item_id || CASE WHEN len(choices) > 1 THEN '_' || (i - 1) ELSE '' END AS row_id, choices[i] AS positive FROM (SELECT item_id, choices, unnest(range(1, greatest(len(choices), 1) + 1)) AS i FROM eval_items WHERE choices IS NOT NULL)")
def multi_positive_unroll(spark, sf_dir):
    e = table(spark, sf_dir, "eval_items").where("choices is not null").select(F.col("item_id").cast("string").alias("row_id"), "choices")
    return retrieval.unroll_positives(e, "row_id", "choices").select("row_id", F.get("choices", F.lit(0)).alias("positive"))


@query("SELECT item_id, 'Question: ' || question || chr(10) || 'Options:' || chr(10) || array_to_string(list_transform(range(1, len(choices) + 1), lambda i: chr(CAST(64 + i AS INTEGER)) || '. ' || choices[i]), chr(10)) || chr(10) || 'Answer: ' || answer || ': ' || choices[ascii(answer) - 64] AS prompt FROM eval_items WHERE question IS NOT NULL AND len(choices) >= 4 AND answer IS NOT NULL")
def mcq_prompts(spark, sf_dir):
    e = table(spark, sf_dir, "eval_items").where("question is not null and size(choices) >= 4 and answer is not null")
    return e.select("item_id", mcq.formatted(F.col("question"), F.col("choices"), F.col("answer")).alias("prompt"))


_K = "md5('42:' || item_id || ':' || (i - 1))"


@query(f"WITH c AS (SELECT item_id, answer, unnest(range(1, len(choices) + 1)) AS i, choices FROM eval_items WHERE len(choices) >= 4), o AS (SELECT item_id, answer, i, choices[i] AS c, row_number() OVER (PARTITION BY item_id ORDER BY {_K}, i) AS r FROM c) SELECT item_id, array_to_string(list(c ORDER BY r), '|') AS options, max(CASE WHEN i = ascii(answer) - 64 THEN chr(CAST(64 + r AS INTEGER)) END) AS new_answer FROM o GROUP BY 1")
def mcq_shuffle(spark, sf_dir):
    e = table(spark, sf_dir, "eval_items").where("size(choices) >= 4")
    return mcq.shuffled(e, "item_id", "choices", "answer", 42).select("item_id", F.array_join("choices", "|").alias("options"), F.col("answer").alias("new_answer"))


@query("SELECT item_id AS question_id, question, array_to_string(choices, '|') AS options, answer, ascii(answer) - 65 AS answer_index, benchmark AS category, '-' AS cot_content, '-' AS src FROM eval_items WHERE len(choices) >= 4")
def benchmark_rows(spark, sf_dir):
    out = mcq.benchmark_rows(table(spark, sf_dir, "eval_items"), "item_id", "question", "choices", "answer", "benchmark")
    return out.withColumn("options", F.array_join("options", "|"))


_VOTE = "chr(CAST(65 + CAST(('0x' || substr(md5(item_id || ':{}'), 1, 15)) AS BIGINT) % 4 AS INTEGER))"
_RATIO = "(" + " + ".join(f"CAST({_VOTE.format(m)} = answer AS INTEGER)" for m in "xyz") + ") / 3.0"


@query(f"SELECT item_id, round({_RATIO}, 6) AS correct_ratio, {_RATIO} > 0.8 AS is_easy, {_RATIO} < 0.5 AS is_hallucination FROM eval_items")
def judged_questions(spark, sf_dir):
    e = table(spark, sf_dir, "eval_items")
    for m in "xyz":
        e = e.withColumn(m, mcq.letter((T.md5_int(F.concat_ws(":", "item_id", F.lit(m))) % 4).cast("int")))
    return mcq.judged(e, "answer", ["x", "y", "z"]).select("item_id", F.round("correct_ratio", 6).alias("correct_ratio"), "is_easy", "is_hallucination")


@query("SELECT item_id, len(list_distinct(choices)) <> len(choices) AS changed, len(list_distinct(choices)) AS left_over FROM eval_items WHERE choices IS NOT NULL AND answer IS NOT NULL")
def distractor_cleanup(spark, sf_dir):
    e = table(spark, sf_dir, "eval_items").where("choices is not null and answer is not null")
    return mcq.clean_distractors(e, "choices", "answer").select("item_id", "changed", F.size("choices").cast("long").alias("left_over"))


@query("SELECT item_id, CASE WHEN regexp_matches(answer, '^[A-J]$') AND len(choices) >= 2 THEN 'mcq' WHEN regexp_matches(answer, '^[+-]?\\d+(\\.\\d+)?(/\\d+)?$') THEN 'numeric' ELSE 'freeform' END AS route FROM eval_items WHERE answer IS NOT NULL AND choices IS NOT NULL")
def answer_router(spark, sf_dir):
    e = table(spark, sf_dir, "eval_items").where("answer is not null and choices is not null")
    return e.select("item_id", mcq.router(F.col("question"), F.col("answer"), F.col("choices")).alias("route"))


@query("SELECT item_id, way, CASE WHEN way = 'missing' OR way = 'far' THEN '-' ELSE answer END AS parsed FROM (SELECT item_id, answer, unnest(['bold', 'boxed', 'colon', 'lower', 'bracket', 'alone', 'missing', 'far']) AS way FROM eval_items WHERE answer IS NOT NULL)")
def answer_parsing(spark, sf_dir):
    """Answers in the ways that models give them: marked, boxed, after a colon, in brackets, alone, not at all, or one that there is no option for."""
    e = table(spark, sf_dir, "eval_items").where("answer is not null")
    a = F.col("answer")
    said = {
        "bold": F.concat(F.lit("I think the **answer is** ("), a, F.lit(").")), "boxed": F.concat(F.lit("So the answer is $\\boxed{"), a, F.lit("}$")), "colon": F.concat(F.lit("Answer: "), a, F.lit("\nIt fits best.")),
        "lower": F.concat(F.lit("the answer is "), F.lower(a), F.lit(".")), "bracket": F.concat(F.lit("Only ["), a, F.lit("] can be right.")), "alone": F.concat(a, F.lit(") for sure")),
        "missing": F.lit("I do not know which one it may be"), "far": F.lit("The answer is J."),
    }
    rows = e.select("item_id", F.explode(F.map_from_arrays(F.array(*map(F.lit, said)), F.array(*said.values()))).alias("way", "said"))
    return rows.select("item_id", "way", mcq.parsed_answer(F.col("said"), 4).alias("parsed"))


_SEG = "SELECT label AS doc, vec_id, embedding, CASE WHEN vec_id % 3 = 0 THEN 'q' ELSE 's' END AS kind FROM embeddings"


@query(
    f"""WITH e AS ({_SEG}), b AS (SELECT q.doc, q.vec_id AS question, c.vec_id AS segment, row_number() OVER (PARTITION BY q.vec_id ORDER BY round({_D}, 9) DESC, c.vec_id) AS r FROM e q JOIN e c ON q.doc = c.doc AND q.kind = 'q' AND c.kind = 's'),
m AS (SELECT doc, count(DISTINCT segment) AS matched, count(*) AS nq FROM b WHERE r = 1 GROUP BY 1), s AS (SELECT doc, count(*) AS segments FROM e WHERE kind = 's' GROUP BY 1)
SELECT doc, matched, segments, round(matched / segments, 6) AS coverage, round(least(nq, segments) / segments, 6) AS best FROM m JOIN s USING (doc)"""
)
def text_coverage(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").withColumnRenamed("label", "doc")
    q, s = e.where("vec_id % 3 = 0").withColumnRenamed("vec_id", "question"), e.where("vec_id % 3 <> 0").withColumnRenamed("vec_id", "segment")
    return retrieval.coverage(q, s, "doc", "question", "segment", "embedding").select("doc", "matched", "segments", F.round("coverage", 6).alias("coverage"), F.round("best", 6).alias("best"))


@query()
def semantic_outliers(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.expr("vec_id div 4").alias("question"), (F.col("vec_id") % 4).alias("choice"), "embedding", (F.col("vec_id") % 4 == 0).alias("is_answer"))
    return mcq.outliers(e, "question", "choice", "embedding", "is_answer")
