"""Mixing sources to target weights (problem 1).

The plan of a blend has, for each source of weight above 0, its share, its target (share of size_ratio times the corpus, in characters)
and its supply (max_repeats times the characters of its documents). To fill a blend the documents of a source are laid end to end and cut
into blocks of fixed length; each output shard draws how many of its slots go to each source from a multinomial distribution; a
source's slots are numbered through all shards, slot k takes block perm(k mod blocks) of the round k div blocks, perm being a keyed
pseudorandom permutation of the source's block numbers for that round; and slots and blocks are joined by number. So no round repeats a
block before every other was used, nothing is shuffled by source alone, and a slot beyond max_repeats rounds stays empty and is reported.

Names are compared trimmed and in lower case. Repeated rows of the specification count once; rows of one blend and name that differ are one
source with the sum of their weights and the largest max_repeats. A null weight is 1, a null max_repeats 1, a weight of 0 or less or a
null name leaves the source out. A null n_chars counts 0. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quernstone.operators.ranges import running_sum

BLOCK_CHARS, SHARD_SLOTS, SLICE_BLOCKS, SEED = 2048, 1024, 4096, 42
#: Shards that are listed in one row before they spread over tasks.
_LISTED = 4096


def name_key(c: str) -> Column:
    return F.lower(F.expr(rf"trim(BOTH ' \t\n\r' FROM `{c}`)"))


def sources(spec: DataFrame) -> DataFrame:
    """One row for each blend and source of weight above 0: size_ratio, weight, category, max_repeats, share."""
    rows = spec.select("blend", "size_ratio", name_key("name").alias("name"), F.coalesce("weight", F.lit(1.0)).alias("weight"), "category", F.coalesce("max_repeats", F.lit(1)).alias("max_repeats"))
    rows = rows.where("weight > 0 and name is not null").distinct()
    one = rows.groupBy("blend", "name").agg(F.max("size_ratio").alias("size_ratio"), F.sum("weight").alias("weight"), F.min("category").alias("category"), F.max("max_repeats").alias("max_repeats"))
    of_blend = one.groupBy("blend").agg(F.sum("weight").alias("weights"), F.max("size_ratio").alias("size_ratio"))
    return one.drop("size_ratio").join(of_blend, "blend").withColumn("share", F.col("weight") / F.col("weights")).drop("weights")


def plan(docs: DataFrame, spec: DataFrame, source_col: str = "source", size_col: str = "n_chars") -> DataFrame:
    """sources() with total (of the corpus), chars (of the source), target and supply; documents are aggregated before they are joined."""
    chars = docs.select(name_key(source_col).alias("name"), F.coalesce(F.col(size_col), F.lit(0)).alias("n")).groupBy("name").agg(F.sum("n").alias("chars"))
    total = chars.agg(F.coalesce(F.sum("chars"), F.lit(0)).alias("total"))
    out = sources(spec).join(chars.where("name is not null"), "name", "left").join(total)
    return out.select(
        "blend", "name", "category", "weight", "share", "max_repeats", "size_ratio", "total", F.coalesce("chars", F.lit(0)).alias("chars"),
        (F.col("size_ratio") * F.col("total") * F.col("share")).alias("target"), (F.col("max_repeats") * F.coalesce("chars", F.lit(0))).alias("supply"),
    )


def shortfalls(planned: DataFrame) -> DataFrame:
    """(blend, name) of the sources whose target is above their supply."""
    return planned.where("target > supply").select("blend", "name")


def unreached(mixed: DataFrame, planned: DataFrame, *, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(blend, name) of the sources of a filled blend that cannot reach their target.

    Candidates are the sources with slots that stayed empty and those whose slots, drawn at random, come within chance of the supply (six standard
    deviations of the count: one source in 10^9 could be missed); the exact comparison of target and supply decides on them.
    """
    filled = mixed.groupBy("blend", "name").agg(F.count("*").alias("slots"), F.count_if(F.col("block").isNull()).alias("empty"))
    filled = filled.select(F.col("blend").alias("_blend"), F.col("name").alias("_name"), "slots", "empty")
    both = planned.join(filled, F.col("blend").eqNullSafe(F.col("_blend")) & (F.col("name") == F.col("_name")), "left")
    slots, empty = F.coalesce("slots", F.lit(0)), F.coalesce("empty", F.lit(0))
    return shortfalls(both.where((empty > 0) | ((slots + 6 * F.sqrt(slots) + 36) * block_chars >= F.col("supply"))))


def blocks(docs: DataFrame, planned: DataFrame, *, block_chars: int = BLOCK_CHARS, slice_blocks: int = SLICE_BLOCKS, id_col: str = "doc_id", source_col: str = "source", size_col: str = "n_chars") -> DataFrame:
    """(name, block, spans, chars): the blocks of every source; spans are (doc, start, end) in characters.

    A source is laid out in slices of about slice_blocks blocks, so no task holds a source; the last block of a slice may be short.
    """
    names = planned.groupBy("name").agg(F.max("chars").alias("chars")).withColumn("slices", F.expr(f"greatest(1L, chars div {slice_blocks * block_chars})"))
    rows = docs.select(name_key(source_col).alias("name"), F.col(id_col).alias("doc"), F.coalesce(F.col(size_col), F.lit(0)).cast("long").alias("n")).where("n > 0")
    rows = rows.join(names.select("name", "slices"), "name").withColumn("slice", F.pmod(F.xxhash64("doc"), F.col("slices"))).drop("slices")
    rows = rows.withColumn("off", F.sum("n").over(W.partitionBy("name", "slice").orderBy("doc").rowsBetween(W.unboundedPreceding, 0)) - F.col("n"))
    cut = rows.select("name", "slice", "doc", "n", "off", F.explode(F.expr(f"sequence(off div {block_chars}, (off + n - 1) div {block_chars})")).alias("b"))
    span = F.struct("off", "doc", F.greatest(F.col("b") * block_chars - F.col("off"), F.lit(0)).alias("start"), F.least((F.col("b") + 1) * block_chars - F.col("off"), F.col("n")).alias("end"))
    packed = cut.select("name", "slice", "b", span.alias("s")).groupBy("name", "slice", "b").agg(F.sort_array(F.collect_list("s")).alias("spans"), F.sum(F.col("s.end") - F.col("s.start")).alias("chars"))
    held = rows.groupBy("name", "slice").agg(F.expr(f"max(off + n - 1) div {block_chars} + 1").alias("held"))
    held = held.withColumn("base", F.sum("held").over(W.partitionBy("name").orderBy("slice").rowsBetween(W.unboundedPreceding, 0)) - F.col("held"))
    spans = F.transform("spans", lambda s: F.struct(s["doc"].alias("doc"), s["start"].alias("start"), s["end"].alias("end")))
    return packed.join(held, ["name", "slice"]).select("name", (F.col("base") + F.col("b")).alias("block"), spans.alias("spans"), "chars")


def draws(planned: DataFrame, *, block_chars: int = BLOCK_CHARS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(blend, shard, name, count): the multinomial draw of every output shard of every blend."""
    per = planned.groupBy("blend").agg(F.max("size_ratio").alias("ratio"), F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("name", "share"))).alias("of"))
    per = per.withColumn("slots", F.ceil(F.col("ratio") * F.col("total") / block_chars)).where("slots > 0")
    per = per.withColumn("last", F.expr(f"(slots - 1) div {shard_slots}"))
    lots = per.select("blend", "slots", "last", "of", F.explode(F.expr(f"sequence(0L, last div {_LISTED})")).alias("lot")).repartition("blend", "lot")
    shards = lots.select("blend", "slots", "of", F.explode(F.expr(f"sequence(lot * {_LISTED}, least(last, lot * {_LISTED} + {_LISTED - 1}))")).alias("shard"))
    shards = shards.select("blend", "shard", F.least(F.lit(shard_slots), F.expr(f"slots - shard * {shard_slots}")).alias("n"), F.col("of.name").alias("names"), F.col("of.share").alias("shares"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            blend, shard, name, count = [], [], [], []
            for bl, sh, n, names, shares in zip(*(c.to_pylist() for c in b.columns)):
                r = np.random.default_rng([seed, xxhash.xxh3_64_intdigest(bl or ""), sh])
                p = np.array(shares)
                drawn = r.multinomial(n, p / p.sum())
                blend += [bl] * len(names)
                shard += [sh] * len(names)
                name += names
                count += drawn.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(blend, pa.string()), pa.array(shard, pa.int64()), pa.array(name, pa.string()), pa.array(count, pa.int64())], ["blend", "shard", "name", "count"])

    return shards.mapInArrow(run, "blend string, shard long, name string, count long").where("count > 0")


def permute(j: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For each element the place of j in a permutation of 0..n-1 that key names: a four-round Feistel network with cycle walking."""
    bits = np.array([max(2, int(x - 1).bit_length()) for x in n.tolist()], np.uint64)
    half = (bits + np.uint64(1)) // np.uint64(2)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = j.astype(np.uint64), np.arange(len(j))
    while len(todo):
        x, h, m, k = out[todo], half[todo], mask[todo], key[todo]
        left, right = x >> h, x & m
        for r in range(4):
            f = (right + k + np.uint64(r)) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f >> np.uint64(32)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def assign(drawn: DataFrame, planned: DataFrame, counts: DataFrame, *, seed: int = SEED) -> DataFrame:
    """(blend, shard, name, slot, round, block): which block each slot takes; a slot beyond the supply has a null round and block.

    counts: (name, n) with the number of blocks of each source.
    """
    begun = running_sum(drawn, ["blend", "name"], ["shard"], "count", "upto").withColumn("start", F.col("upto") - F.col("count"))
    slots = begun.select("blend", "shard", "name", F.explode(F.expr("sequence(start, start + count - 1)")).alias("slot"))
    limits = planned.select("blend", "name", "max_repeats").join(counts, "name", "left").select("blend", "name", "max_repeats", F.coalesce("n", F.lit(0)).alias("n"))
    slots = slots.join(limits, ["blend", "name"]).select("blend", "shard", "name", "slot", "n", "max_repeats")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: dict[tuple, int] = {}
        for b in batches:
            blend, name = b.column(0).to_pylist(), b.column(2).to_pylist()
            slot, n, most = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 4, 5))
            some = np.maximum(n, 1)
            turn = slot // some
            ok = (n > 0) & (turn < most)
            for x in set(zip(blend, name, turn.tolist())) - keys.keys():
                keys[x] = xxhash.xxh3_64_intdigest(repr((seed, x)))
            key = np.array([keys[x] for x in zip(blend, name, turn.tolist())], np.uint64)
            block = permute(slot % some, some, key)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), pa.array(turn, mask=~ok), pa.array(block, mask=~ok)], ["blend", "shard", "name", "slot", "round", "block"])

    return slots.mapInArrow(run, "blend string, shard long, name string, slot long, round long, block long")


def blend(docs: DataFrame, spec: DataFrame, *, block_chars: int = BLOCK_CHARS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(blend, shard, name, slot, round, block, spans, chars): the whole mixture; an unfilled slot has null spans and 0 chars."""
    planned = plan(docs, spec)
    cut = blocks(docs, planned, block_chars=block_chars)
    counts = cut.groupBy("name").agg(F.count("*").alias("n"))
    slots = assign(draws(planned, block_chars=block_chars, shard_slots=shard_slots, seed=seed), planned, counts, seed=seed)
    out = slots.join(cut.withColumnRenamed("name", "n2").withColumnRenamed("block", "b2"), (F.col("name") == F.col("n2")) & (F.col("block") == F.col("b2")), "left").drop("n2", "b2")
    return out.withColumn("chars", F.coalesce("chars", F.lit(0)))


def shares(mixed: DataFrame, planned: DataFrame) -> DataFrame:
    """Target and reached characters and shares of each blend, by name and (with a null name) by category; uses is how often a block of it was used at most."""
    got = mixed.groupBy("blend", "name").agg(F.sum("chars").alias("got"), (F.coalesce(F.max("round"), F.lit(-1)) + 1).alias("uses"), F.count_if(F.col("block").isNull()).alias("unfilled"))
    by = planned.join(got, ["blend", "name"], "left").groupingSets([["blend", "category", "name"], ["blend", "category"]], "blend", "category", "name")
    by = by.agg(F.sum("target").alias("target_chars"), F.sum("share").alias("target_share"), F.coalesce(F.sum("got"), F.lit(0)).alias("reached_chars"), F.coalesce(F.max("uses"), F.lit(0)).alias("uses"), F.coalesce(F.sum("unfilled"), F.lit(0)).alias("unfilled_slots"), F.grouping("name").alias("by_category"))
    whole = mixed.groupBy("blend").agg(F.sum("chars").alias("whole"))
    out = by.join(whole, "blend", "left")
    return out.select("blend", "category", "name", "by_category", F.round("target_chars").cast("long").alias("target_chars"), "reached_chars", F.round("target_share", 6).alias("target_share"), F.round(F.col("reached_chars") / F.nullif("whole", F.lit(0)), 6).alias("reached_share"), "uses", "unfilled_slots")


def block_texts(mixed: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(blend, shard, name, slot, text) of every filled slot: the characters of its spans in order."""
    parts = mixed.select("blend", "shard", "name", "slot", F.posexplode("spans").alias("i", "s")).select("blend", "shard", "name", "slot", "i", "s.*")
    own = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    cut = parts.join(own, "doc").select("blend", "shard", "name", "slot", F.struct("i", F.expr("substring(text, cast(start as int) + 1, cast(end - start as int))").alias("t")).alias("p"))
    return cut.groupBy("blend", "shard", "name", "slot").agg(F.concat_ws("", F.transform(F.sort_array(F.collect_list("p")), lambda p: p["t"])).alias("text"))
