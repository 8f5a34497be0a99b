"""Queries of the training-data problems and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.llm import binpack, bpe, leakage, mixing, neardup, pairs, quality, residue
from quernstone.session import materialize, table

_LOG = logging.getLogger(__name__)

#: What TESTDATA.md states for problem 2.
P2 = {"width": 3, "threshold": 0.6, "min_words": 50}


def _near_duplicates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    members, found, reached = neardup.near_duplicates(table(spark, sf_dir, "documents"), **P2)
    _LOG.info("p2: estimated recall %.5f", reached)
    return members, found


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents that are near-duplicates or equal."""
    return neardup.document_pairs(*_near_duplicates(spark, sf_dir)).select(F.col("a").alias("doc_id_a"), F.col("b").alias("doc_id_b"))


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document that takes part: its group of linked texts and the number of links of its text."""
    return neardup.groups(*_near_duplicates(spark, sf_dir)).select(F.col("doc").alias("doc_id"), F.col("group").alias("group_id"), "links")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of each document."""
    return bpe.encode_texts(table(spark, sf_dir, "documents"))


def p6_tokens_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, characters, tokens and characters a token of each language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.lower("lang").alias("lang"))
    sizes = bpe.encode_texts(docs).select("doc_id", F.size("ids").cast("long").alias("n"))
    both = docs.select("doc_id", "lang", F.length("text").alias("chars")).join(sizes, "doc_id")
    out = both.groupBy("lang").agg(F.count("*").alias("docs"), F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"), F.sum("n").alias("tokens"))
    return out.withColumn("chars_per_token", F.round(F.col("chars") / F.nullif("tokens", F.lit(0)), 4))


def p6_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of every text that the decoded ids give."""
    back = bpe.decode_ids(bpe.encode_texts(table(spark, sf_dir, "documents")))
    return back.select("doc_id", F.md5("text").alias("digest"))


def p1_block_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The characters that the blocks of each source hold: all of its documents'."""
    docs, spec = table(spark, sf_dir, "documents"), table(spark, sf_dir, "blend_sources")
    cut = mixing.blocks(docs, mixing.plan(docs, spec))
    return cut.groupBy("name").agg(F.sum("chars").alias("chars"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources of a blend that cannot reach their target: those of the filled blend with empty slots or few blocks left, compared exactly."""
    docs, spec = table(spark, sf_dir, "documents"), table(spark, sf_dir, "blend_sources")
    return mixing.unreached(mixing.blend(docs, spec), mixing.plan(docs, spec))


def p1_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share, target and supply of every source of every blend."""
    out = mixing.plan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "blend_sources"))
    return out.select("blend", "name", "category", "max_repeats", F.round("share", 9).alias("share"), F.round("target", 3).alias("target"), "supply")


def p1_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every slot of every output shard of every blend with the block that fills it."""
    out = mixing.blend(table(spark, sf_dir, "documents"), table(spark, sf_dir, "blend_sources"))
    return out.select("blend", "shard", "name", "slot", "round", "block", F.size("spans").alias("n_spans"), "chars")


def p1_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached shares of every blend, by name and by category."""
    docs, spec = table(spark, sf_dir, "documents"), table(spark, sf_dir, "blend_sources")
    return mixing.shares(mixing.blend(docs, spec), mixing.plan(docs, spec))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of earlier containers that were cut without need."""
    return binpack.needless_cuts(table(spark, sf_dir, "packed_sequences"), table(spark, sf_dir, "token_sequences"))


def p3_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The containers of all sequences."""
    return binpack.pack(table(spark, sf_dir, "token_sequences"), binpack.capacities(table(spark, sf_dir, "packed_sequences")))


def p3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and sequences that the containers of each dataset and shard hold: all of them, each once."""
    packed = p3_packed(spark, sf_dir)
    tokens = packed.groupBy("dataset", "shard_index").agg(F.sum(F.size("input_ids")).alias("tokens"))
    ids = packed.select("dataset", "shard_index", F.explode("seq_ids").alias("s")).groupBy("dataset", "shard_index").agg(F.countDistinct("s").alias("sequences"))
    same = tokens["dataset"].eqNullSafe(ids["dataset"]) & tokens["shard_index"].eqNullSafe(ids["shard_index"])
    return tokens.join(ids, same).select(tokens["dataset"], tokens["shard_index"], "tokens", "sequences")


def p3_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers and used space of each dataset."""
    return binpack.fill(p3_packed(spark, sf_dir))


def _posteriors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, float]]:
    posts, cutoffs, report = pairs.posteriors(pairs.chat_pairs(table(spark, sf_dir, "sdg_chat"), table(spark, sf_dir, "sdg_preference")))
    _LOG.info("p4 on the validation set: %s", report)
    return posts, cutoffs


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The defective answers, each with its most probable defect."""
    return pairs.worst(*_posteriors(spark, sf_dir))


def p4_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every defect of every answer whose posterior reaches its cutoff."""
    return pairs.defects(*_posteriors(spark, sf_dir))


def p5_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics and the class of every document."""
    docs = table(spark, sf_dir, "documents")
    rules, report = quality.learn(docs)
    _LOG.info("p5 on held-out documents: %s", report)
    return quality.classify(docs, rules)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that are lists, tables or junk. The classes are written first: a filter on them would be pushed below the statistics, which
    would then be computed again inside it, once for each place where a rule names one."""
    classes = materialize(p5_classes(spark, sf_dir).select("doc_id", "text_class"), "classes")
    return classes.where("text_class <> 'prose'")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the test items that they give away."""
    return leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p7_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As p7_found, with up to two edits a window."""
    return leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), edits=2)


def _residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights, cutoff, report = residue.fit(residue.sample(docs, "doc_id", "text", "source_id"))
    _LOG.info("p8 on unseen hosts: %s", report)
    return residue.find(docs, weights, cutoff)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with template residue, filler, error pages or script notices."""
    return _residue(spark, sf_dir).select("doc_id", "residue")


def p8_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of the other documents."""
    return table(spark, sf_dir, "documents").select("doc_id").join(_residue(spark, sf_dir).select("doc_id"), "doc_id", "left_anti")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        p1_found, p1_plan, p1_block_chars, p1_blend, p1_shares, p2_found, p2_groups, p3_found, p3_packed, p3_tokens, p3_fill, p4_found, p4_labels, p5_found, p5_classes, p6_ids, p6_round_trip, p6_tokens_by_lang,
        p7_found, p7_near, p8_found, p8_clean,
    )
}

_PLAN_SQL = """
WITH spec AS (
  SELECT DISTINCT blend, size_ratio, lower(trim(name, E' \t\n\r')) AS name, coalesce(weight, 1.0) AS weight, category, coalesce(max_repeats, 1) AS max_repeats
  FROM blend_sources WHERE coalesce(weight, 1.0) > 0 AND name IS NOT NULL
), one AS (
  SELECT blend, name, sum(weight) AS weight, min(category) AS category, max(max_repeats) AS max_repeats, max(size_ratio) AS size_ratio FROM spec GROUP BY blend, name
), ratio AS (SELECT blend, sum(weight) AS weights, max(size_ratio) AS size_ratio FROM one GROUP BY blend
), chars AS (SELECT lower(trim(source, E' \t\n\r')) AS name, sum(coalesce(n_chars, 0)) AS chars FROM documents GROUP BY 1
), total AS (SELECT coalesce(sum(n_chars), 0) AS total FROM documents
), plan AS (
  SELECT one.blend, one.name, category, max_repeats, weight / weights AS share, ratio.size_ratio * total * (weight / weights) AS target, max_repeats * coalesce(chars, 0) AS supply
  FROM one JOIN ratio USING (blend) CROSS JOIN total LEFT JOIN chars USING (name)
)"""
ORACLE: dict[str, str] = {
    "p1_found": _PLAN_SQL + " SELECT blend, name FROM plan WHERE target > supply",
    "p1_plan": _PLAN_SQL + " SELECT blend, name, category, max_repeats, round(share, 9) AS share, round(target, 3) AS target, CAST(supply AS BIGINT) AS supply FROM plan",
    "p1_block_chars": _PLAN_SQL + " SELECT name, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents JOIN (SELECT DISTINCT name FROM one) o ON o.name = lower(trim(source, E' \t\n\r')) WHERE n_chars > 0 GROUP BY name",
    "p6_round_trip": "SELECT doc_id, md5(coalesce(text, '')) AS digest FROM documents",
    "p3_tokens": """
WITH s AS (SELECT DISTINCT dataset, shard_index, seq_id, len(input_ids) AS n, CASE WHEN seq_id IS NULL THEN input_ids END AS i FROM token_sequences WHERE len(input_ids) > 0)
SELECT dataset, shard_index, CAST(sum(n) AS BIGINT) AS tokens, count(DISTINCT seq_id) AS sequences FROM s GROUP BY 1, 2""",
    "p3_found": """
WITH lens AS (SELECT DISTINCT seq_id, len(input_ids) AS n FROM token_sequences WHERE len(input_ids) > 0
), packs AS (SELECT DISTINCT pack_id, pack_size, seq_ids, seq_start_id, len(input_ids) AS total FROM packed_sequences
), items AS (SELECT pack_id, pack_size, unnest(seq_ids) AS seq_id, unnest(range(1, len(seq_ids) + 1)) AS i, seq_start_id, total, len(seq_ids) AS k FROM packs
), held AS (SELECT pack_id, pack_size, seq_id, sum(CASE WHEN i < k THEN seq_start_id[i + 1] ELSE total END - seq_start_id[i]) AS tokens FROM items GROUP BY ALL)
SELECT DISTINCT pack_id, seq_id FROM held JOIN lens USING (seq_id) WHERE tokens < n AND n <= pack_size""",
}
