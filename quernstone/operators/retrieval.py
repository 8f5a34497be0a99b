"""Vector search, hard negatives and ranking metrics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quernstone.functions.text import cosine

#: Rows of a block of queries and of a block of the corpus, whose product is one unit of work, and scores that are held at once.
QUERY_BLOCK, CORPUS_BLOCK, SCORE_CELLS = 1024, 16_384, 4_000_000


def blocks(df: DataFrame, by: list[str], id_col: str, vec: str, size: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """(by, _k, _b, ids, vs, extra): the rows of each group in about _k = rows / size blocks, with their ids and all numbers of their vectors in a row.

    Ids are integers; rows without id or vector, and vectors of no length, are left out. `extra` has further columns as arrays.
    """
    length = F.aggregate(F.col(vec), F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    own = df.where(F.col(id_col).isNotNull() & F.col(vec).isNotNull()).where(length > 0)
    rows = own.select(*by, F.col(id_col).cast("long").alias("_i"), F.col(vec).cast("array<double>").alias("_v"), *extra)
    counts = rows.groupBy(*by).agg(F.ceil(F.count("*") / size).cast("int").alias("_k"))
    sized = rows.join(counts, by) if by else rows.withColumn("_k", F.lit(counts.first()["_k"]))
    placed = sized.withColumn("_b", F.pmod(F.xxhash64("_i"), F.greatest("_k", F.lit(1))).cast("int"))
    field = lambda n: F.transform("_r", lambda r: r[n])
    lists = [field(n).alias(n) for n in extra]
    packed = placed.groupBy(*by, "_k", "_b").agg(F.collect_list(F.struct("_i", "_v", *extra)).alias("_r"))
    return packed.select(*by, "_k", "_b", field("_i").alias("ids"), F.flatten(field("_v")).alias("vs"), *lists)


def paired(queries: DataFrame, corpus: DataFrame, by: list[str]) -> DataFrame:
    """Each block of queries with each block of the corpus of its group, as columns q_* and c_*; the blocks of queries, which are fewer, are repeated."""
    counts = corpus.select(*by, "_k").distinct()
    q = queries.select(*by, *(F.col(c).alias(f"q_{c}") for c in queries.columns if c not in (*by, "_k", "_b")))
    q = q.join(counts, by) if by else q.withColumn("_k", F.lit(max([r["_k"] for r in counts.collect()], default=0)))
    q = q.where("_k > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_b")).drop("_k")
    c = corpus.select(*by, "_b", *(F.col(x).alias(f"c_{x}") for x in corpus.columns if x not in (*by, "_k", "_b")))
    return q.join(c, [*by, "_b"])


def _unit(flat: np.ndarray, n: int) -> np.ndarray:
    m = flat.reshape(n, -1)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _kept(s: np.ndarray, i: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best scores of each row and their ids; scores that are equal to nine places are ordered by id."""
    order = np.lexsort((i, -np.round(s, 9)), axis=1)[:, :k]
    return np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def _best(rows: DataFrame, k: int, same: bool, schema: str) -> DataFrame:
    """(q, c, score): of each pair of blocks the k best of each query; with q_most only those that score at most that, with c_of none that names the query."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                of = dict(zip(names, (c[r] for c in b.columns)))
                qi, ci = (of[x].values.to_numpy(zero_copy_only=False) for x in ("q_ids", "c_ids"))
                q, c = _unit(of["q_vs"].values.to_numpy(zero_copy_only=False), len(qi)), _unit(of["c_vs"].values.to_numpy(zero_copy_only=False), len(ci))
                sort = np.argsort(qi)
                qi, q = qi[sort], q[sort]
                best_s, best_i = np.full((len(qi), 0), -np.inf), np.zeros((len(qi), 0), np.int64)
                step = max(1, SCORE_CELLS // len(qi))
                for at in range(0, len(ci), step):
                    s, ids = q @ c[at : at + step].T, ci[at : at + step]
                    if "q_most" in of:
                        s[~(s <= of["q_most"].values.to_numpy(zero_copy_only=False)[sort][:, None])] = -np.inf
                    if "c_of" in of:
                        named = of["c_of"].values[at : at + step].to_pylist()
                        col = np.repeat(np.arange(len(ids)), [len(x or ()) for x in named])
                        flat = np.array([y for x in named for y in x or ()], np.int64)
                        row = np.minimum(np.searchsorted(qi, flat), len(qi) - 1)
                        hit = qi[row] == flat
                        s[row[hit], col[hit]] = -np.inf
                    if same:
                        s[qi[:, None] == ids[None, :]] = -np.inf
                    best_s, best_i = _kept(np.concatenate([best_s, s], 1), np.concatenate([best_i, np.broadcast_to(ids, s.shape)], 1), k)
                ok = np.isfinite(best_s)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qi, best_s.shape[1])[ok.ravel()]), pa.array(best_i[ok]), pa.array(best_s[ok])], ["q", "c", "score"])

    return rows.mapInArrow(run, schema)


def _ranked(found: DataFrame, query_id: str, qkind: str, doc_id: str, kind: str, k: int) -> DataFrame:
    out = found.select(F.col("q").cast(qkind).alias(query_id), F.col("c").cast(kind).alias(doc_id), "score")
    rank = F.row_number().over(W.partitionBy(query_id).orderBy(F.desc(F.round("score", 9)), doc_id))
    return out.withColumn("rank", rank).where(F.col("rank") <= k)


def top_k(queries: DataFrame, corpus: DataFrame, query_id: str, corpus_id: str, vec: str, k: int, *, same: bool = False) -> DataFrame:
    """(query_id, corpus_id, score, rank): the k best rows of the corpus for every query by cosine, ties by the least corpus id.

    Ids are integers. Blocks of queries meet blocks of the corpus, each pair is a matrix product of bounded size that leaves k rows a query; nothing goes
    to the driver and nothing is broadcast by hand. With `same` a row is not found for the query with its own id. Vectors that are null or have no
    length are left out; repeated ids count each.
    """
    kinds = queries.schema[query_id].dataType.simpleString(), corpus.schema[corpus_id].dataType.simpleString()
    both = paired(blocks(queries, [], query_id, vec, QUERY_BLOCK), blocks(corpus, [], corpus_id, vec, CORPUS_BLOCK), [])
    return _ranked(_best(both, k, same, "q long, c long, score double"), query_id, kinds[0], corpus_id, kinds[1], k)


def hard_negatives(queries: DataFrame, corpus: DataFrame, positives: DataFrame, query_id: str, doc_id: str, vec: str, margin: float, n: int, *, same: bool = False) -> DataFrame:
    """(query_id, doc_id, score, rank): of the whole corpus the n best that aren't positive and score at most margin times the query's least positive score.

    The least positive scores come from the positive pairs alone; they go with the blocks of queries. Each document has the list of the queries that it is
    positive for. Products as in top_k. Queries without a positive that has a vector give nothing; vectors that are null or have no length are left out.
    """
    qkind, kind = queries.schema[query_id].dataType.simpleString(), corpus.schema[doc_id].dataType.simpleString()
    pairs = positives.select(query_id, doc_id).where(F.col(query_id).isNotNull() & F.col(doc_id).isNotNull()).distinct()
    q, c = queries.select(query_id, F.col(vec).alias("_q")), corpus.select(doc_id, F.col(vec).alias("_c"))
    score = cosine(F.col("_q"), F.col("_c"))
    low = pairs.join(q, query_id).join(c, doc_id).groupBy(query_id).agg(F.min(score).alias("_low")).where("_low is not null")
    asked = queries.select(query_id, vec).join(low, query_id).withColumn("most", F.lit(margin) * F.col("_low"))
    of = pairs.groupBy(doc_id).agg(F.collect_list(F.col(query_id).cast("long")).alias("of"))
    own = blocks(corpus.select(doc_id, vec).join(of, doc_id, "left"), [], doc_id, vec, CORPUS_BLOCK, ("of",))
    both = paired(blocks(asked, [], query_id, vec, QUERY_BLOCK, ("most",)), own, [])
    return _ranked(_best(both, n, same, "q long, c long, score double"), query_id, qkind, doc_id, kind, n)


def reranked(ranked: DataFrame, texts: DataFrame, query_id: str, doc_id: str, text: str, score: Column, n: int, chars: int = 8000) -> DataFrame:
    """(query_id, doc_id, score, rank): of each query's found documents the n best by a score of their text, cut to `chars` characters; ties by id.

    `score` is an expression over the columns of both tables; a null one counts as the least. Found documents without a text are dropped.
    """
    both = ranked.drop("score", "rank").join(texts.select(doc_id, F.substring(text, 1, chars).alias(text)), doc_id).withColumn("score", score)
    rank = F.row_number().over(W.partitionBy(query_id).orderBy(F.desc_nulls_last("score"), doc_id))
    return both.withColumn("rank", rank).where(F.col("rank") <= n).select(query_id, doc_id, "score", "rank")


def ranking_metrics(ranked: DataFrame, qrels: DataFrame, query_id: str, doc_id: str, ks: tuple[int, ...] = (1, 5, 10)) -> DataFrame:
    """(k, ndcg, map, recall, precision): means over the queries with a relevant document; relevance is 0 or 1."""
    total = qrels.groupBy(query_id).agg(F.countDistinct(doc_id).alias("_rel"))
    hit = ranked.join(qrels.select(query_id, doc_id).distinct().withColumn("_hit", F.lit(1)), [query_id, doc_id]).select(query_id, "rank")
    hit = hit.withColumn("_seen", F.row_number().over(W.partitionBy(query_id).orderBy("rank")))
    wide = total.join(hit, query_id, "left").select(query_id, "_rel", "rank", "_seen", F.explode(F.array(*map(F.lit, ks))).alias("k"))
    in_k = F.col("rank") <= F.col("k")
    per = wide.groupBy(query_id, "k", "_rel").agg(
        F.sum(F.when(in_k, 1 / F.log2(F.col("rank") + 1.0)).otherwise(0.0)).alias("_dcg"), F.sum(F.when(in_k, F.col("_seen") / F.col("rank")).otherwise(0.0)).alias("_ap"), F.sum(F.when(in_k, 1).otherwise(0)).alias("_n")
    )
    ideal = F.aggregate(F.sequence(F.lit(1), F.least("_rel", "k").cast("int")), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + 1.0))
    per = per.withColumn("_idcg", ideal)
    return per.groupBy("k").agg(
        F.round(F.avg(F.col("_dcg") / F.col("_idcg")), 6).alias("ndcg"), F.round(F.avg(F.col("_ap") / F.col("_rel")), 6).alias("map"), F.round(F.avg(F.col("_n") / F.col("_rel")), 6).alias("recall"), F.round(F.avg(F.col("_n") / F.col("k")), 6).alias("precision")
    )


def metric_delta(base: DataFrame, tuned: DataFrame, key: str, value: str, most_drop: float = 0.0) -> DataFrame:
    """(key, base, tuned, delta, percent, drifted): percent is infinite for a base of 0."""
    both = base.select(key, F.col(value).alias("base")).join(tuned.select(key, F.col(value).alias("tuned")), key)
    d = F.col("tuned") - F.col("base")
    return both.withColumn("delta", d).withColumn("percent", F.when(F.col("base") == 0, F.when(d == 0, 0.0).otherwise(float("inf"))).otherwise(d / F.col("base") * 100)).withColumn("drifted", d < -most_drop)


def unroll_positives(df: DataFrame, id_col: str, pos_col: str) -> DataFrame:
    """One row for each positive where there are several, with _i after the id; rows with none or one stay."""
    many = F.size(pos_col) > 1
    rows = df.withColumn("_p", F.when(many, F.transform(pos_col, lambda p: F.array(p))).otherwise(F.array(pos_col)))
    rows = rows.withColumn("_many", many).select("*", F.posexplode("_p").alias("_i", "_one"))
    return rows.withColumn(id_col, F.when(F.col("_many"), F.concat_ws("_", id_col, "_i")).otherwise(F.col(id_col))).withColumn(pos_col, F.col("_one")).drop("_p", "_many", "_i", "_one")


def coverage(questions: DataFrame, segments: DataFrame, doc: str, question: str, segment: str, vec: str) -> DataFrame:
    """(doc, matched, segments, coverage, best): which share of a document's segments is some question's most similar segment, and the most that so many questions could reach.

    A document's questions and segments meet in blocks, as in top_k, so a large document spreads over tasks and a pair is never a row. Ids are integers
    and unique in the corpus; documents are not null.
    """
    q = blocks(questions.select(doc, question, vec), [doc], question, vec, QUERY_BLOCK)
    both = paired(q, blocks(segments.select(doc, segment, vec), [doc], segment, vec, QUERY_BLOCK), [doc])
    found = _best(both.drop("_b"), 1, False, "q long, c long, score double")
    match = found.groupBy("q").agg(F.max_by("c", F.struct(F.round("score", 9), -F.col("c"))).alias("_m"))
    of = questions.select(doc, F.col(question).cast("long").alias("q")).distinct()
    got = of.join(match, "q").groupBy(doc).agg(F.countDistinct("_m").alias("matched"), F.count("*").alias("_nq"))
    return got.join(segments.groupBy(doc).agg(F.count("*").alias("segments")), doc).select(doc, "matched", "segments", (F.col("matched") / F.col("segments")).alias("coverage"), (F.least("_nq", "segments") / F.col("segments")).alias("best"))
