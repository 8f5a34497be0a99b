"""Splits, shard selection and sampling; driver-side plans hold one row a shard or source."""

from __future__ import annotations

import hashlib
import json
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quernstone.functions.text import md5_int
from quernstone.operators.ranges import rank_within


#: Categories whose weights are broadcast at most.
MOST_CATEGORIES = 100_000


def ratio_split(df: DataFrame, key: str, ratios: dict[str, float], seed: int) -> DataFrame:
    """df with a split that the key and the seed fix; no shuffle, and a row stays in its split when others come or go."""
    if abs(sum(ratios.values()) - 1) > 1e-9:
        raise ValueError("ratios must sum to 1")
    bucket = F.pmod(md5_int(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), F.lit(10_000))
    names = list(ratios)
    out, upper = F.lit(names[-1]), 1.0
    for name in reversed(names[:-1]):
        upper = sum(ratios[n] for n in names[: names.index(name) + 1])
        out = F.when(bucket < round(upper * 10_000), F.lit(name)).otherwise(out)
    return df.withColumn("split", out)


def tail_holdout(df: DataFrame, order: str, n: int, train: str = "train", val: str = "val") -> DataFrame:
    """The last n rows are val; all are train when there are n or fewer. The bound is the n-th greatest key, one value."""
    total = df.agg(F.count("*").alias("_n"))
    bound = df.select(order).orderBy(F.desc(order)).limit(n).agg(F.min(order).alias("_from"))
    out = df.join(F.broadcast(total)).join(F.broadcast(bound))
    return out.withColumn("split", F.when((F.col("_n") > n) & (F.col(order) >= F.col("_from")), val).otherwise(train)).drop("_n", "_from")


def head_holdout(df: DataFrame, order: str, n: int) -> DataFrame:
    """The first min(n, a tenth) rows are val."""
    total = df.count()
    k = min(n, total // 10)
    bound = df.select(order).orderBy(order).limit(k).agg(F.max(order).alias("_to"))
    return df.join(F.broadcast(bound)).withColumn("split", F.when(F.coalesce(F.col(order) <= F.col("_to"), F.lit(False)), "val").otherwise("train")).drop("_to")


def stratified_split(df: DataFrame, key: str, stratum: str, every: int) -> DataFrame:
    """A share of 1 / every of each stratum, rounded down, is val, those with the smallest hashes of the key; a stratum may hold most rows."""
    ranked = rank_within(df.withColumn("_h", md5_int(F.col(key).cast("string"))), [stratum], ["_h", key], "_r", "_n")
    return ranked.withColumn("split", F.when(F.col("_r") <= F.expr(f"_n div {every}"), "val").otherwise("train")).drop("_n", "_r", "_h")


def fractional_split(df: DataFrame, key: str, seed: int, val: float, test: float) -> DataFrame:
    """df with a split: in an order that key and seed fix, the first floor(n val) rows are val, the next floor(n test) test, the others train."""
    ranked = rank_within(df.withColumn("_h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))), [], ["_h", key], "_r", "_n")
    v, t = F.floor(F.col("_n") * val), F.floor(F.col("_n") * test)
    return ranked.withColumn("split", F.when(F.col("_r") <= v, "val").when(F.col("_r") <= v + t, "test").otherwise("train")).drop("_r", "_n", "_h")


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows in an order that the key and the seed fix."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string"))), key)


def weighted_draws(categories: DataFrame, name: str, weight: str, draws: DataFrame, draw: str) -> DataFrame:
    """(draw, name): a category for each draw, with replacement, in proportion to the weights, by an inverse-CDF range join on hashes.

    The categories, one row each, are broadcast, so there may be MOST_CATEGORIES at most.
    """
    n = categories.where(F.col(weight) > 0).limit(MOST_CATEGORIES + 1).count()
    if n > MOST_CATEGORIES:
        raise ValueError(f"more than {MOST_CATEGORIES} categories")
    w = W.orderBy(name).rowsBetween(W.unboundedPreceding, 0)
    cdf = categories.where(F.col(weight) > 0).select(name, weight).withColumn("_hi", F.sum(weight).over(w)).withColumn("_total", F.sum(weight).over(W.partitionBy()))
    cdf = cdf.select(name, ((F.col("_hi") - F.col(weight)) / F.col("_total")).alias("_lo"), (F.col("_hi") / F.col("_total")).alias("_hi"))
    u = md5_int(F.col(draw).cast("string")) / F.lit(float(1 << 60))
    return draws.withColumn("_u", u).join(F.broadcast(cdf), (F.col("_u") >= F.col("_lo")) & (F.col("_u") < F.col("_hi"))).select(draw, name)


def select_shards(shards: DataFrame, source: str, order: str, rows: str, weight: str) -> DataFrame:
    """The shards of each source that bring it closest to its share.

    T is the least of rows / share over the sources; a source takes shards in order until one more gets it no closer to share * T, at
    least one. With equal weights every shard is taken.
    """
    per = shards.groupBy(source).agg(F.sum(rows).alias("_rows"), F.max(weight).alias("_w")).where("_w > 0")
    all_ = per.agg(F.sum("_w").alias("_ws"), F.min("_w").alias("_wmin"), F.max("_w").alias("_wmax"))
    per = per.join(F.broadcast(all_)).withColumn("_share", F.col("_w") / F.col("_ws"))
    t = per.agg(F.min(F.col("_rows") / F.col("_share")).alias("_t"))
    per = per.join(F.broadcast(t)).select(source, (F.col("_share") * F.col("_t")).alias("_target"), (F.col("_wmin") == F.col("_wmax")).alias("_same"))
    w = W.partitionBy(source).orderBy(order)
    run = shards.join(per, source).withColumn("_before", F.coalesce(F.sum(rows).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    run = run.withColumn("_closer", (F.row_number().over(w) == 1) | (F.abs(F.col("_before") + F.col(rows) - F.col("_target")) < F.abs(F.col("_before") - F.col("_target"))))
    run = run.withColumn("_ok", F.min(F.col("_closer").cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return run.where("_same or _ok = 1").select(*shards.columns)


def assign_splits(prefixes: list[tuple[float, str]], n_valid: int, n_test: int, seed: int) -> dict[str, list[tuple[float, str]]]:
    """Shards of all sources to test, then valid, then train, after a seeded shuffle; counts are clamped to what there is."""
    pool = list(prefixes)
    random.Random(seed).shuffle(pool)
    test, rest = pool[: max(0, min(n_test, len(pool)))], pool[max(0, min(n_test, len(pool))) :]
    valid, train = rest[: max(0, min(n_valid, len(rest)))], rest[max(0, min(n_valid, len(rest))) :]
    return {"train": train, "valid": valid, "test": test}


def split_counts(total: int, valid: float, test: float) -> tuple[int, int]:
    """Numbers of valid and test shards for ratios; two shards or fewer have neither, and train keeps one at least."""
    if total <= 2:
        return 0, 0
    v, t = (max(1, round(total * r)) if r > 0 else 0 for r in (valid, test))
    while v + t > total - 1:
        if v >= t and v:
            v -= 1
        else:
            t -= 1
    return v, t


def sample_shards(n: int, sample: str | int, dataset: str, seed: int) -> list[int]:
    """Which of n shards a sample of "10%" or k takes; one at least, fixed by dataset and seed."""
    if isinstance(sample, str) and sample.endswith("%"):
        k = int(n * float(sample[:-1]) / 100)
    else:
        k = int(sample)
    own = int.from_bytes(hashlib.sha256(f"{seed}:{dataset}".encode()).digest()[:8], "big")
    return sorted(random.Random(own).sample(range(n), min(n, max(1, k))))


def shard_count(total_bytes: int, target_bytes: int) -> int:
    return max(1, -(-total_bytes // target_bytes))


def balanced_plan(files: list[tuple[str, int]], shards: int) -> list[list[str]]:
    """Files, largest first, each to the lightest shard; in turn when no size is known."""
    ordered = sorted(files, key=lambda f: (-f[1], f[0]))
    out: list[list[str]] = [[] for _ in range(shards)]
    if not any(s for _, s in ordered):
        for i, (p, _) in enumerate(ordered):
            out[i % shards].append(p)
        return out
    load = [0] * shards
    for p, s in ordered:
        i = min(range(shards), key=lambda k: (load[k], k))
        out[i].append(p)
        load[i] += s
    return out


def row_split_plan(files: list[tuple[str, int]], shards: int) -> list[tuple[str, int, int]]:
    """(file, modulus, remainder) of each shard when there are fewer files than shards: one each, the rest in proportion to the sizes by largest remainders."""
    if not files:
        return []
    total = sum(s for _, s in files) or len(files)
    sizes = [s for _, s in files] if sum(s for _, s in files) else [1] * len(files)
    spare = shards - len(files)
    exact = [spare * s / total for s in sizes]
    take = [int(x) for x in exact]
    for i in sorted(range(len(files)), key=lambda i: (-(exact[i] - take[i]), i))[: spare - sum(take)]:
        take[i] += 1
    return [(p, take[i] + 1, r) for i, (p, _) in enumerate(files) for r in range(take[i] + 1)]


def run_hash(config: dict, force: float | None = None) -> str:
    """A name of a configuration, the same for equal ones; `force` makes it new."""
    body = json.dumps(config | ({"_force": force} if force is not None else {}), sort_keys=True, default=str)
    return hashlib.sha256(body.encode()).hexdigest()[:16]


def validate_blend(blend: dict) -> dict:
    """Exactly one of datasets or train / valid / test; a weight is 1 unless given."""
    split = [k for k in ("train", "valid", "test") if blend.get(k)]
    if bool(blend.get("datasets")) == bool(split):
        raise ValueError("a blend has either datasets or train, valid and test")
    return {k: [{"weight": 1.0} | d for d in v] for k, v in blend.items() if v}


def data_paths(blend: list[dict]) -> list[dict]:
    """The datasets of weight above 0."""
    return [d for d in blend if d.get("weight", 1.0) > 0]


def split_name(name: str) -> str:
    return "val" if name == "validation" else name
