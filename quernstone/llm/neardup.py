"""Near-duplicate texts by a chosen-path similarity join (problem 2).

A text is the set of its runs of `width` words. A run of the join hashes the words' runs of a text once for each level and
chooses those with a small hash, about `branch / threshold` of them; texts that chose the same one fall into the same node. Nodes
of few texts are compared pair by pair, larger ones are split again by the next level's choices, and nodes still large at the
last level are compared in blocks that spread over tasks, so nothing is dropped. Two texts at the threshold share a choice with
probability 1 - exp(-branch) on a level; `runs` independent runs are made together, and more follow until the estimated share
of found pairs (from the pairs that one run or two runs found) reaches `recall`.

Pairs of a node are first held against each other by a sketch of 64 two-bit minwise symbols, with a margin of four standard
deviations, then by the exact similarity of the whole sets. What the sketch may lose of pairs just at the threshold, by the binomial
distribution of its symbols, counts against the recall; each round has another sketch. A join that doesn't reach the recall fails. Equal
texts are one class; only its least id takes part in the join.

A node that very many texts chose (a common run of words) is named by a count over a sixteenth of the texts before the rows are brought together by
node; its rows go on to the next level as they are, and on the last one into blocks.

Null and empty texts and those of fewer than `min_words` words take no part. Ids must be unique; repeated ids and texts, empty
tables and further columns are no problem.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions.words import pieces, texts, words
from quernstone.operators.components import components
from quernstone.operators.ranges import with_group_min
from quernstone.session import materialize

WIDTH, THRESHOLD, MIN_WORDS = 5, 0.8, 1
RUNS, LEVELS, BRANCH, RECALL = 3, 3, 3.0, 0.999
#: Rounds of runs after which a join that is still below the recall fails; their runs have a bit each in one long.
MOST_ROUNDS = 20
#: Texts of a node that are compared at once, and texts in a block of a node that stays large.
BUCKET, BLOCK = 512, 256
#: Words whose hashes a worker keeps.
_MOST_WORDS = 500_000
_KNOWN: dict[str, int] = {}
#: Bytes of text whose words and hashes are held at once.
_PIECE = 1_500_000
#: The sketch has this many two-bit symbols, in two longs.
_SYMBOLS = 64


def _mix(h: np.ndarray) -> np.ndarray:
    """A finalizer of 64-bit hashes: xor-shifts and odd multipliers."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _seeds(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(seed)
    return r.integers(0, 2**32, n, dtype=np.uint32), r.integers(0, 2**31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _hashes(ws: list[str]) -> np.ndarray:
    try:
        return np.fromiter(map(_KNOWN.__getitem__, ws), np.int64, len(ws)).view(np.uint64)
    except KeyError:
        if len(_KNOWN) > _MOST_WORDS:
            _KNOWN.clear()
        for w in ws:
            if w not in _KNOWN:
                _KNOWN[w] = xxhash.xxh3_64_intdigest(w) - 2**63
        return np.fromiter(map(_KNOWN.__getitem__, ws), np.int64, len(ws)).view(np.uint64)


def word_runs(docs: list[list[str]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's runs of `width` words, one text after another, and where each text starts and ends.

    A text of fewer words is one run; one without words has none.
    """
    sizes = np.array([len(ws) for ws in docs], np.int64)
    if not sizes.sum():
        return np.empty(0, np.uint64), np.zeros(len(docs) + 1, np.int64)
    flat = np.concatenate([_hashes(ws) for ws in docs])
    text = np.repeat(np.arange(len(docs)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(flat))  # words to the end of the text
    h = np.zeros(len(flat), np.uint64)
    for i in range(width):
        part = np.zeros(len(flat), np.uint64)
        part[: len(flat) - i] = flat[i:]
        part[left <= i] = 0
        h = _mix(h + part)
    short = np.repeat(np.minimum(sizes, width), sizes)
    keep = left >= short
    h, text = h[keep], text[keep]
    ends = np.searchsorted(text, np.arange(len(docs) + 1)).tolist()
    for a, b in zip(ends, ends[1:]):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    h, text = h[new], text[new]
    return h, np.searchsorted(text, np.arange(len(docs) + 1))


def sketches(h: np.ndarray, ends: np.ndarray, seed: int = 11) -> np.ndarray:
    """For each text, none of which is empty, 64 symbols of two bits, each of the least hash under one hash function, as two longs."""
    x, m = _seeds(_SYMBOLS, seed)
    low = (h >> np.uint64(32)).astype(np.uint32)
    out = np.zeros((2, len(ends) - 1), np.uint64)
    for k in range(_SYMBOLS):
        least = np.minimum.reduceat((low ^ x[k]) * m[k], ends[:-1])
        out[k % 2] |= (_mix(least.astype(np.uint64) + np.uint64(k)) & np.uint64(3)) << np.uint64(k // 2 * 2)
    return out.view(np.int64)


def choices(h: np.ndarray, ends: np.ndarray, first_run: int, runs: int, levels: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """The elements whose hash is below share / size, for each text and each run and level within it: signed 32-bit hashes, and ends."""
    low = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    x, m = _seeds((first_run + runs) * levels, 23)
    x, m = x[first_run * levels :], m[first_run * levels :]
    sizes = np.diff(ends)
    most = np.minimum(2.0**32 - 1, share / np.maximum(sizes, 1) * 2**32).astype(np.uint32)
    text, most = np.repeat(np.arange(len(sizes)), sizes), np.repeat(most, sizes)
    slot, element = [], []
    for k in range(len(x)):
        v = (low ^ x[k]) * m[k]
        v = (v ^ (v >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        e = np.flatnonzero(v <= most)
        slot.append(text[e] * len(x) + k), element.append(low[e])
    slot, element = np.concatenate(slot), np.concatenate(element)
    order = np.argsort(slot, kind="stable")
    return element[order].view(np.int32), np.searchsorted(slot[order], np.arange(len(sizes) * len(x) + 1))


def _signatures(df: DataFrame, id_col: str, text_col: str, width: int, min_words: int, first_run: int, runs: int, levels: int, share: float) -> DataFrame:
    """(doc, key, n, s1, s2, picks_0, ...) of each text with enough words: key is a hash of its words, picks_l its choices of a level, each with its run."""
    names = [f"picks_{level}" for level in range(levels)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, text_col, _PIECE):
            docs = [(i, ws) for i, t in zip(b.column(0).to_pylist(), texts(b.column(1))) if t and i is not None and len(ws := words(t)) >= max(min_words, 1)]
            h, ends = word_runs([ws for _, ws in docs], width)
            if not len(h):
                continue
            s = sketches(h, ends, 11 + first_run)
            picked, at = choices(h, ends, first_run, runs, levels, share)
            slot = np.repeat(np.arange(len(at) - 1), np.diff(at))
            text, slot = np.divmod(slot, runs * levels)
            value = (slot // levels << 32) + (picked.astype(np.int64) & 0xFFFFFFFF)
            picks = []
            for level in range(levels):
                own = slot % levels == level
                picks.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(text[own], np.arange(len(docs) + 1)), pa.int32()), pa.array(value[own])))
            keys = [xxhash.xxh3_128_digest(" ".join(ws)) for _, ws in docs]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in docs], pa.int64()), pa.array(keys, pa.binary()), pa.array(np.diff(ends), pa.int32()), pa.array(s[0]), pa.array(s[1]), *picks], ["doc", "key", "n", "s1", "s2", *names]
            )

    return df.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(run, "doc long, key binary, n int, s1 long, s2 long, " + ", ".join(f"{c} array<long>" for c in names))


def _sets(df: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(doc, runs) with the whole set of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, text_col, _PIECE):
            h, ends = word_runs([words(t) if t else [] for t in texts(b.column(1))], width)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(h.view(np.int64)))], ["doc", "runs"])

    return df.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(run, "doc long, runs array<long>")


def _alike(threshold: float) -> Column:
    """Whether x and y can reach the threshold, by their sizes and sketches."""

    def apart(c: str) -> Column:
        d = F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))
        return F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(0x5555555555555555)))

    return (F.least("x.n", "y.n") >= F.lit(threshold) * F.greatest("x.n", "y.n")) & (apart("s1") + apart("s2") <= _most_apart(threshold))


def blocked_pairs(rows: DataFrame, group: list[str], size: str, id_col: str, block: int) -> DataFrame:
    """Pairs (x, y) of the rows of each group, x.id < y.id: groups are cut into blocks, each pair of blocks is a unit of work.

    rows: columns of `group`, `size` (rows of the group) and `v`, a struct with id_col.
    """
    k = F.ceil(F.col(size) / block).cast("int")
    own = rows.withColumn("_k", k).withColumn("_b", F.pmod(F.xxhash64(f"v.{id_col}"), F.col("_k")).cast("int"))
    left = own.select(*group, "v", F.col("_b").alias("_i"), F.explode(F.sequence(F.col("_b"), F.col("_k") - 1)).alias("_j"))
    right = own.select(*group, "v", F.col("_b").alias("_j"), F.explode(F.sequence(F.lit(0), F.col("_b"))).alias("_i"))
    both = left.withColumnRenamed("v", "x").join(right.withColumnRenamed("v", "y"), [*group, "_i", "_j"])
    both = both.where((F.col("_i") < F.col("_j")) | (F.col(f"x.{id_col}") < F.col(f"y.{id_col}")))
    swap = F.col(f"x.{id_col}") < F.col(f"y.{id_col}")
    return both.select(*group, F.when(swap, F.col("x")).otherwise(F.col("y")).alias("x"), F.when(swap, F.col("y")).otherwise(F.col("x")).alias("y"))


#: Columns of a node's row, and of what a level gives: pairs (with the run's bit) and rows of nodes that are split again.
_ROW = ("node", "rep", "n", "s1", "s2")
_LEVEL = "hot boolean, node long, rep long, n int, s1 long, s2 long, a long, b long, bit long"
_RUN_BITS = 8


def _most_apart(threshold: float) -> int:
    """Differing symbols of two texts at the threshold, four standard deviations above the mean."""
    p = (1 - threshold) * 3 / 4
    return int(_SYMBOLS * p + 4 * (_SYMBOLS * p * (1 - p)) ** 0.5)


def _compared(cols: list[np.ndarray], starts: np.ndarray, size: int, threshold: float) -> list[np.ndarray]:
    """(a, b, bit) of the alike pairs in groups of `size` rows that start at `starts`."""
    node, rep, n, s1, s2 = cols
    i, j = np.triu_indices(size, 1)
    step = max(1, 2_000_000 // len(i))
    out = []
    for k in range(0, len(starts), step):
        at = starts[k : k + step, None]
        x, y = (at + i).ravel(), (at + j).ravel()
        ok = np.minimum(n[x], n[y]) >= threshold * np.maximum(n[x], n[y])
        x, y = x[ok], y[ok]
        apart = np.zeros(len(x), np.int64)
        for sk in (s1, s2):
            d = (sk[x] ^ sk[y]).view(np.uint64)
            apart += np.bitwise_count((d | (d >> np.uint64(1))) & np.uint64(0x5555555555555555))
        ok = (apart <= _most_apart(threshold)) & (rep[x] != rep[y])
        x, y = x[ok], y[ok]
        out.append(np.stack([np.minimum(rep[x], rep[y]), np.maximum(rep[x], rep[y]), np.int64(1) << (node[x] & (_RUN_BITS - 1))]))
    return out


def _level(rows: DataFrame, threshold: float, bucket: int) -> DataFrame:
    """One level: rows are brought together by node, in one shuffle; nodes of up to `bucket` rows give their alike pairs, larger ones their rows.

    A task streams through its nodes and never holds more than a batch and one node of `bucket` rows.
    """

    def made(hot: list[np.ndarray], pairs: list[np.ndarray]) -> pa.RecordBatch:
        nh, np_ = len(hot[0]), len(pairs[0])
        none_h, none_p = pa.nulls(nh, pa.int64()), pa.nulls(np_, pa.int64())
        cols = [pa.array(np.arange(nh + np_) < nh)]
        cols += [pa.concat_arrays([pa.array(h, k), pa.nulls(np_, k)]) for h, k in zip(hot, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))]
        cols += [pa.concat_arrays([none_h, pa.array(x, pa.int64())]) for x in pairs]
        return pa.RecordBatch.from_arrays(cols, ["hot", *_ROW, "a", "b", "bit"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = [np.empty(0, np.int64)] * len(_ROW)
        carry, flowing = empty, None  # rows of the last node so far; the node whose rows are already known to be too many
        for b in batches:
            cols = [np.concatenate([c, x.to_numpy(zero_copy_only=False)]) for c, x in zip(carry, b.columns)]
            hot, pairs, rest = done(cols, flowing, False)
            carry, flowing = rest
            yield made(hot, pairs)
        if len(carry[0]):
            hot, pairs, _ = done(carry, flowing, True)
            yield made(hot, pairs)

    def done(cols: list[np.ndarray], flowing: int | None, last: bool) -> tuple[list[np.ndarray], list[np.ndarray], tuple]:
        node = cols[0]
        edge = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else np.empty(0, np.int64)
        size = np.diff(np.append(edge, len(node)))
        many = (size > bucket) | (node[edge] == flowing if flowing is not None else np.zeros(len(edge), bool))
        keep = [np.empty(0, np.int64)] * len(_ROW)
        after = None
        if not last and len(edge):
            if many[-1]:
                after = int(node[-1])
            else:
                keep = [c[edge[-1] :] for c in cols]
                edge, size, many = edge[:-1], size[:-1], many[:-1]
        whole = np.zeros(len(node) + 1, np.int32)
        whole[edge[many]] += 1
        np.subtract.at(whole, edge[many] + size[many], 1)
        hot = [c[np.cumsum(whole)[:-1] > 0] for c in cols]
        pairs = []
        for k in np.unique(size[~many & (size > 1)]).tolist():
            pairs += _compared(cols, edge[~many & (size == k)], k, threshold)
        return hot, [np.concatenate(x) for x in zip(*pairs)] if pairs else [np.empty(0, np.int64)] * 3, (keep, after)

    return rows.select(*_ROW).repartition("node").sortWithinPartitions("node").mapInArrow(run, _LEVEL)


#: Nodes that are named heavy at most, and the share of the texts whose choices are counted for it.
HEAVY_NODES, HEAVY_SHARE = 1_000, 16


def _heavy(rows: DataFrame, bucket: int) -> list[int]:
    """The nodes with most rows, at most HEAVY_NODES, of those with about HEAVY_SHARE x bucket or more, by the rows of every HEAVY_SHARE-th text by hash.

    It only decides by which way a node's rows go on, so a node that is missed or named wrongly costs time, not pairs.
    """
    few = rows.where(F.pmod(F.xxhash64("rep"), F.lit(HEAVY_SHARE)) == 0).groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > bucket)
    return [r["node"] for r in few.orderBy(F.desc("n")).limit(HEAVY_NODES).collect()]


def _candidates(reps: DataFrame, runs: int, levels: int, threshold: float, bucket: int, block: int) -> DataFrame:
    """(a, b, mask): pairs that a node brought together and whose sketches are alike; mask has a bit for each run."""

    def node(path: Column, run: Column) -> Column:
        return F.xxhash64(path, "t").bitwiseAND(F.lit(-_RUN_BITS)).bitwiseOR(run.cast("long"))

    value = ("rep", "n", "s1", "s2")
    rows = reps.select(*value, F.explode("picks_0").alias("t")).select(node(F.lit(0), F.shiftright("t", 32)).alias("node"), *value)
    out, heavy = None, []
    for level in range(levels):
        # a node's rows are some of its parent's, so only heavy nodes have heavy children
        heavy = _heavy(rows, bucket) if heavy or not level else []
        cold = rows.where(~F.col("node").isin(heavy)) if heavy else rows
        given = materialize(_level(cold, threshold, bucket), "level")
        pairs = given.where("not hot").select("a", "b", "bit")
        out = pairs if out is None else out.unionByName(pairs)
        hot = given.where("hot").select(*_ROW)
        if heavy:
            hot = hot.unionByName(rows.where(F.col("node").isin(heavy)).select(*_ROW))
        if hot.isEmpty():
            break
        if level == levels - 1:
            sized = with_group_min(hot, ["node"], "rep", "_least", "c")
            both = blocked_pairs(sized.select("node", "c", F.struct(*value).alias("v")), ["node"], "c", "rep", block).where(_alike(threshold))
            out = out.unionByName(both.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), F.expr(f"shiftleft(1L, cast(node & {_RUN_BITS - 1} as int))").alias("bit")))
            break
        own = reps.select(F.col("rep").alias("_r"), F.col(f"picks_{level + 1}").alias("p"))
        # a text's own choices are read along the run of the node
        run = F.col("node").bitwiseAND(F.lit(_RUN_BITS - 1))
        rows = hot.join(own, F.col("rep") == F.col("_r")).select("node", *value, F.explode("p").alias("t")).where(F.shiftright("t", 32) == run)
        rows = rows.select(node(F.col("node"), run).alias("node"), *value)
    return out.groupBy("a", "b").agg(F.bit_or("bit").alias("mask"))


def _verified(pairs: DataFrame, df: DataFrame, id_col: str, text_col: str, width: int, threshold: float) -> DataFrame:
    """Pairs whose sets have the exact similarity; the sets of the texts in question are made once and written."""
    ids = pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc"))).distinct()
    own = df.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).join(ids, "doc", "left_semi")
    sets = materialize(_sets(own, "doc", "text", width), "sets")
    both = pairs.join(sets.select(F.col("doc").alias("a"), F.col("runs").alias("ra")), "a").join(sets.select(F.col("doc").alias("b"), F.col("runs").alias("rb")), "b")
    shared, sizes = F.size(F.array_intersect("ra", "rb")), F.size("ra") + F.size("rb")
    # shared / (sizes - shared) >= threshold, with the intersection, which a filter computes for each place that names it, named once
    alike = both.where(shared * (1 + threshold) >= F.lit(threshold) * sizes - 1e-9)
    return alike.select("a", "b", "mask", (shared / (sizes - shared)).alias("similarity"))


def sketch_loss(threshold: float) -> float:
    """The probability that the sketches of two texts just at the threshold differ in too many symbols; it is less for more similar ones."""
    p, most = (1 - threshold) * 3 / 4, _most_apart(threshold)
    return 1 - sum(comb(_SYMBOLS, k) * p**k * (1 - p) ** (_SYMBOLS - k) for k in range(most + 1))


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = WIDTH, threshold: float = THRESHOLD, min_words: int = MIN_WORDS,
    runs: int = RUNS, levels: int = LEVELS, branch: float = BRANCH, recall: float = RECALL, most_rounds: int = MOST_ROUNDS, bucket: int = BUCKET, block: int = BLOCK,
) -> tuple[DataFrame, DataFrame, float]:
    """(members, pairs, reached): members (doc, rep) has every text that takes part and the least id of the texts with the same words;
    pairs (a, b, similarity) has the pairs of representatives a < b whose similarity reaches the threshold; reached is the estimated recall."""
    if not 1 <= runs <= _RUN_BITS or runs * most_rounds > 63:
        raise ValueError(f"{runs} runs in {most_rounds} rounds: at most {_RUN_BITS} runs a round and 63 in all")
    members, pairs, reached = None, None, 0.0
    for round_ in range(most_rounds):
        base = materialize(_signatures(df, id_col, text_col, width, min_words, round_ * runs, runs, levels, branch / threshold), "signatures")
        if members is None:
            members = materialize(with_group_min(base.select("doc", "key").distinct(), ["key"], "doc", "rep", "copies").select("doc", "rep", "copies"), "members")
        firsts = members.where("doc = rep").select("doc")
        reps = materialize(base.join(firsts, "doc", "left_semi").select(F.col("doc").alias("rep"), *[c for c in base.columns if c not in ("doc", "key")]), "representatives")
        found = materialize(_candidates(reps, runs, levels, threshold, bucket, block), "candidates")
        new = _verified(found, df, id_col, text_col, width, threshold)
        if pairs is None:
            pairs = materialize(new, "pairs")
        else:
            both = pairs.unionByName(new.withColumn("mask", F.expr(f"shiftleft(mask, {round_ * runs})")))
            pairs = materialize(both.groupBy("a", "b").agg(F.bit_or("mask").alias("mask"), F.first("similarity").alias("similarity")), "pairs")
        times = F.bit_count("mask")
        n, once, twice = pairs.agg(F.count("*"), F.coalesce(F.sum((times == 1).cast("int")), F.lit(0)), F.coalesce(F.sum((times == 2).cast("int")), F.lit(0))).first()
        missing = once * once / (2 * twice) if twice else once * (once - 1) / 2
        reached = (n / (n + missing) if n else 1.0) * (1 - sketch_loss(threshold) ** (round_ + 1))
        if reached >= recall:
            return members, pairs.select("a", "b", "similarity"), reached
    raise RuntimeError(f"the join reached a recall of {reached:.4f} in {most_rounds} rounds; {recall} was asked for")


def document_pairs(members: DataFrame, pairs: DataFrame, block: int = 1024) -> DataFrame:
    """(a, b), a < b: the pairs of documents that pairs of representatives and equal texts stand for."""
    left, right = members.select(F.col("doc").alias("x"), F.col("rep").alias("a")), members.select(F.col("doc").alias("y"), F.col("rep").alias("b"))
    across = pairs.select("a", "b").join(left, "a").join(right, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    equal = members.where("copies > 1").select("rep", "copies", F.struct("doc").alias("v"))
    within = blocked_pairs(equal, ["rep"], "copies", "doc", block).select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b"))
    return across.unionByName(within)


def groups(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """(doc, group, links): the least id of the texts that links connect, and the number of links of the text's class."""
    comp = components(pairs, "a", "b")
    links = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).groupBy(F.col("a").alias("rep")).agg(F.count("*").alias("links"))
    out = members.join(comp.withColumnRenamed("node", "rep"), "rep", "left").join(links, "rep", "left")
    return out.select("doc", F.coalesce("component", "rep").alias("group"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))
