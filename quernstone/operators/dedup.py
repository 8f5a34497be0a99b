"""Exact, fuzzy, substring and semantic deduplication."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quernstone.functions.text import tokens
from quernstone.functions.words import pieces, texts
from quernstone.operators.components import components
from quernstone.operators.ranges import with_group_min
from quernstone.session import materialize


#: What parts tokens, as in functions.text.tokens.
_BLANKS = re.compile(r"[ \t\r\n]+")


def exact_groups(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(digest, survivor, copies) of every text that is there; hashes are aggregated before the shuffle, texts never move."""
    return df.where(F.col(text_col).isNotNull()).select(F.md5(text_col).alias("digest"), id_col).groupBy("digest").agg(F.min(id_col).alias("survivor"), F.count("*").alias("copies"))


def exact_duplicates(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Ids of all copies but the one with the least id. Copies never meet: hashes are aggregated to the survivors, and the join is by id."""
    survivors = exact_groups(df, id_col, text_col).select(F.col("survivor").alias(id_col))
    return df.where(F.col(text_col).isNotNull()).select(id_col).join(survivors, id_col, "left_anti")


def exact_survivors(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """df without the copies; rows without text stay."""
    survivors = exact_groups(df, id_col, text_col).select(F.col("survivor").alias(id_col))
    return df.where(F.col(text_col).isNotNull()).join(survivors, id_col, "left_semi").unionByName(df.where(F.col(text_col).isNull()))


def char_shingles(text: Column, n: int) -> Column:
    return F.when(F.length(text) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, F.lit(n)))))


def minhash(df: DataFrame, id_col: str, text_col: str, *, chars: int = 24, bands: int = 20, rows: int = 13, seed: int = 1) -> DataFrame:
    """(id_col, bands): a hash of each band of the min-hashes of a text's character n-grams; texts shorter than n have none."""
    kind = df.schema[id_col].dataType.simpleString()
    k = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.random.default_rng(seed)
        a, x = r.integers(0, 2**31, k, dtype=np.uint32) * np.uint32(2) + np.uint32(1), r.integers(0, 2**32, k, dtype=np.uint32)
        mix = r.integers(0, 2**63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for b in pieces(batches, text_col, 300_000):  # small enough for the processor's cache
            own = [(i, t) for i, t in enumerate(texts(b.column(1))) if t is not None and len(t) >= chars]
            low = np.empty((k, len(own)), np.uint32)
            if own:
                c = np.frombuffer("".join(t for _, t in own).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
                sizes = np.array([len(t) for _, t in own])
                h = np.zeros(len(c) - chars + 1, np.uint64)
                for j in range(chars):
                    h = h * np.uint64(1_000_003) + c[j : len(c) - chars + 1 + j]
                # n-grams that reach into the next text are left out
                left = (np.repeat(np.cumsum(sizes), sizes) - np.arange(len(c)))[: len(h)]
                h = (h[left >= chars] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)
                starts = np.concatenate([[0], np.cumsum(sizes - chars + 1)[:-1]])
                for j in range(k):
                    low[j] = np.minimum.reduceat((h ^ x[j]) * a[j], starts)
            out = ((low.reshape(bands, rows, len(own)).astype(np.uint64) + np.uint64(1)) * mix[None, :, None]).sum(axis=1).view(np.int64).T
            ends = np.arange(len(own) + 1, dtype=np.int32) * bands
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([i for i, _ in own], pa.int64())), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(out).ravel()))], [id_col, "bands"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, bands array<long>")


def lsh_edges(signatures: DataFrame, id_col: str) -> DataFrame:
    """(a, b): each member of a bucket with the bucket's least id, so a bucket of n gives n - 1 edges; a bucket may hold most rows."""
    rows = signatures.select(F.col(id_col).alias("b"), F.posexplode("bands").alias("band", "h"))
    return with_group_min(rows, ["band", "h"], "b", "a", "n").where("n > 1 and a <> b").select("a", "b").distinct()


def fuzzy_groups(df: DataFrame, id_col: str, text_col: str, **options: int) -> DataFrame:
    """(node, component) of the texts that share a band with another.

    Copies are min-hashed once: only the survivor of equal texts has a signature, and each copy is linked to it. Signatures and edges are written once.
    """
    digests = df.where(F.col(text_col).isNotNull() & (F.length(text_col) >= options.get("chars", 24))).select(F.col(id_col).alias("b"), F.md5(text_col).alias("h"))
    copies = materialize(with_group_min(digests, ["h"], "b", "a", "n").where("n > 1 and a <> b").select("a", "b"), "copies")
    firsts = df.join(copies.select(F.col("b").alias(id_col)), id_col, "left_anti")
    signatures = materialize(minhash(firsts, id_col, text_col, **options), "signatures")
    return components(lsh_edges(signatures, id_col).unionByName(copies))


def fuzzy_survivors(df: DataFrame, id_col: str, text_col: str, **options: int) -> DataFrame:
    """df without the texts that aren't the least of their component."""
    out = fuzzy_groups(df, id_col, text_col, **options).where("node <> component").select(F.col("node").alias(id_col))
    return df.join(out, id_col, "left_anti")


def repeated_windows(df: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id_col, start, stop, first): merged ranges of the tokens that lie in a window of `width` tokens which occurs more than once; first marks
    windows' first occurrences apart.

    Windows are hashed where the text is; only (hash, id, place) is shuffled.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in pieces(batches, text_col):
            at, place, hashes = [], [], []
            for i, t in enumerate(texts(b.column(1))):
                ws = [w for w in _BLANKS.split(t) if w] if t else []
                if len(ws) < width:
                    continue
                h = np.array([xxhash.xxh3_64_intdigest(w) for w in ws], np.uint64)
                out = np.zeros(len(ws) - width + 1, np.uint64)
                for j in range(width):
                    out = (out ^ h[j : j + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
                    out ^= out >> np.uint64(29)
                at += [i] * len(out)
                place.append(np.arange(len(out)))
                hashes.append(out.view(np.int64))
            cat = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(cat(place), pa.int64()), pa.array(cat(hashes), pa.int64())], [id_col, "place", "h"])

    rows = materialize(df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, place long, h long"), "windows")
    # of the windows that occur once nothing goes on
    many = rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    repeated = rows.join(many, "h", "left_semi").select("h", F.struct(id_col, "place").alias("at"))
    hit = with_group_min(repeated, ["h"], "at", "first", "n").select(f"at.{id_col}", "at.place", (F.col("at") == F.col("first")).alias("first"))
    return merge_ranges(hit.select(id_col, F.col("place").alias("start"), (F.col("place") + width).alias("stop"), "first"), [id_col, "first"])


def merge_ranges(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping or touching ranges of each key as one, by gaps and islands."""
    w = W.partitionBy(*keys).orderBy("start", "stop")
    seen = F.max("stop").over(w.rowsBetween(W.unboundedPreceding, -1))
    marked = ranges.withColumn("_new", F.when(seen >= F.col("start"), 0).otherwise(1)).withColumn("_g", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_g").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("_g")


def substring_dedup(df: DataFrame, id_col: str, text_col: str, width: int, keep_first: bool = True) -> DataFrame:
    """(id_col, text) with the repeated token ranges taken out, first occurrences kept unless told otherwise; blanks between tokens become single in texts that are cut."""
    ranges = repeated_windows(df, id_col, text_col, width)
    if keep_first:
        ranges = ranges.where("not first")
    else:
        ranges = merge_ranges(ranges.select(id_col, "start", "stop"), [id_col])
    per = ranges.groupBy(id_col).agg(F.collect_list(F.struct("start", "stop")).alias("_cut"))
    toks = tokens(F.col(text_col))
    kept = F.filter(F.transform(toks, lambda x, i: F.when(~F.exists("_cut", lambda r: (i >= r["start"]) & (i < r["stop"])), x)), lambda x: x.isNotNull())
    return df.select(id_col, text_col).join(per, id_col, "left").select(id_col, F.when(F.col("_cut").isNull(), F.col(text_col)).otherwise(F.array_join(kept, " ")).alias("text"))


def semantic_pairs(df: DataFrame, id_col: str, vec_col: str, cluster_col: str, least: float, block: int = 512) -> DataFrame:
    """(a, b, similarity): pairs of the same cluster, a < b, with a cosine above `least`.

    A cluster is cut into blocks of about `block` rows, and each pair of blocks is one matrix product, so a large cluster spreads over
    tasks. Ids are integers; null vectors and those without length have no pairs.
    """
    sizes = df.groupBy(cluster_col).agg(F.ceil(F.count("*") / block).cast("int").alias("_k"))
    rows = df.where(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("i"), F.col(vec_col).cast("array<double>").alias("v"), cluster_col).join(sizes, cluster_col)
    blocks = rows.withColumn("_b", F.pmod(F.xxhash64("i"), F.col("_k")).cast("int")).groupBy(F.col(cluster_col).alias("_cl"), "_k", "_b").agg(F.collect_list("i").alias("ids"), F.flatten(F.collect_list("v")).alias("vs"))
    left = blocks.select("_cl", F.col("_b").alias("_i"), F.explode(F.sequence(F.col("_b"), F.col("_k") - 1)).alias("_j"), F.col("ids").alias("xi"), F.col("vs").alias("xv"))
    right = blocks.select("_cl", F.col("_b").alias("_j"), F.col("ids").alias("yi"), F.col("vs").alias("yv"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def unit(ids: np.ndarray, flat: np.ndarray) -> np.ndarray:
            m = flat.reshape(len(ids), -1)
            n = np.sqrt((m * m).sum(axis=1, keepdims=True))
            return np.divide(m, n, out=np.full_like(m, np.nan), where=n > 0)

        for b in batches:
            for r in range(b.num_rows):
                same = b.column(0)[r].as_py()
                xi, xv, yi, yv = (b.column(c)[r].values.to_numpy(zero_copy_only=False) for c in (1, 2, 3, 4))
                s = unit(xi, xv) @ unit(yi, yv).T
                with np.errstate(invalid="ignore"):
                    hit = (s > least) & ((xi[:, None] < yi[None, :]) if same else (xi[:, None] != yi[None, :]))
                p, q = np.nonzero(hit)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(xi[p], yi[q])), pa.array(np.maximum(xi[p], yi[q])), pa.array(s[p, q])], ["a", "b", "similarity"])

    both = left.join(right, ["_cl", "_j"]).select((F.col("_i") == F.col("_j")).alias("same"), "xi", "xv", "yi", "yv")
    return both.mapInArrow(run, "a long, b long, similarity double")


def kmeans_clusters(df: DataFrame, id_col: str, vec_col: str, k: int, seed: int = 1) -> DataFrame:
    """df with a cluster from k-means on its vectors."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    vectors = df.withColumn("_v", array_to_vector(F.col(vec_col).cast("array<double>")))
    return KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="cluster").fit(vectors).transform(vectors).drop("_v")
