"""Ranks, running sums and group minima over many partitions, hot keys and ties; repair of encodings; components of what they give."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quernstone.operators import blending, dedup, ranges, segments, web


@pytest.fixture
def many(spark):
    """Small adaptive partitions, so that ranges are many."""
    new = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}
    old = {k: spark.conf.get(k) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def test_global_rank_of_many_rows(many):
    n = 2_000_000
    df = many.range(n).select(F.pmod(F.col("id") * 7_919 + 13, F.lit(n)).alias("k"), F.md5(F.col("id").cast("string")).alias("payload"))
    out = segments.global_rank(df, ["k"], "r")
    assert out.columns == ["k", "payload", "r"]
    got = out.agg(F.count("*"), F.countDistinct("r"), F.sum((F.col("r") != F.col("k") + 1).cast("int"))).first()
    assert tuple(got) == (n, n, 0)


def test_bundles_and_samples_over_many_partitions(many):
    df = many.range(100_000).withColumn("g", (F.col("id") % 3).cast("string"))
    sizes = {r["n"] for r in segments.bundles(df, "id", 7).groupBy("bundle").agg(F.count("*").alias("n")).collect()}
    assert sizes == {7, 100_000 % 7}
    mixed = segments.bundles(df, "id", 3, "interleaved", "g").join(df, "id").groupBy("bundle").agg(F.countDistinct("g").alias("n")).where("n < 3").count()
    assert mixed <= 1


def test_hot_group_is_ranked_by_many_tasks(many):
    """One stratum holds half of the rows; ranks and sizes are right, and no range holds a third of it."""
    df = many.range(40_000).withColumn("g", F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 3 == 0, None).otherwise((F.col("id") % 50).cast("string"))).withColumn("x", F.md5(F.col("id").cast("string")))
    w = W.partitionBy("g")
    want = df.withColumn("r", F.row_number().over(w.orderBy("x"))).withColumn("n", F.count("*").over(w))
    got = ranges.rank_within(df, ["g"], ["x"], "r", "n")
    assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == 40_000
    most = ranges.ranged(df, ["g", "x"]).where("g = 'hot'").groupBy("_p").count().agg(F.max("count")).first()[0]
    assert most < 20_000 / 3
    split = blending.stratified_split(df, "id", "g", 10).where("g = 'hot'").groupBy("split").count().collect()
    assert {r[0]: r[1] for r in split} == {"val": 2_000, "train": 18_000}


def test_running_sums(many):
    df = many.range(30_000).select("id", (F.col("id") % 11).alias("v"))
    out = segments.exclusive_sum(df, "id", "v", "before").where("before <> (id div 11) * 55 + ((id % 11) * (id % 11 - 1)) div 2")
    assert out.count() == 0
    assert ranges.running_sum(df.limit(0), [], ["id"], "v", "s").count() == 0 and ranges.rank_within(df.limit(0), ["v"], ["id"], "r").count() == 0


def test_group_minima_of_a_hot_key(many):
    df = many.range(30_000).select(F.when(F.col("id") < 15_000, 0).otherwise(F.col("id")).alias("k"), (F.lit(99_999) - F.col("id")).alias("v"))
    out = ranges.with_group_min(df, ["k"], "v", "least", "n")
    hot = out.where("k = 0").agg(F.count("*"), F.min("least"), F.max("least"), F.max("n")).first()
    assert tuple(hot) == (15_000, 85_000, 85_000, 15_000) and out.where("k <> 0 and (n <> 1 or least <> v)").count() == 0


def test_copies_and_near_copies(many):
    """Half of all texts are one text; all of them are in one group, and one survives."""
    long = "the archive keeps all of the old notes in one place and nobody looks at them twice in a year, says the report of the board"
    rows = [(i, long) for i in range(500)] + [(500 + i, f"{i * 7919} other text number {i} of this little test, {i * 31} words and more {i}") for i in range(400)] + [(900, long + "."), (901, None), (902, ""), (903, "short")]
    df = many.createDataFrame(rows, "doc_id long, text string")
    groups = {r["node"]: r["component"] for r in dedup.fuzzy_groups(df, "doc_id", "text").collect()}
    assert all(groups[i] == 0 for i in range(500)) and groups.get(900, 0) == 0
    assert dedup.exact_survivors(df, "doc_id", "text").count() == 405 and dedup.exact_duplicates(df, "doc_id", "text").count() == 499
    left = {r["doc_id"] for r in dedup.fuzzy_survivors(df, "doc_id", "text").collect()}
    assert 0 in left and not left & set(range(1, 500)) and {901, 902, 903} <= left
    assert dedup.fuzzy_groups(df.limit(0), "doc_id", "text").count() == 0


def test_windows_with_a_shorter_hop(spark):
    df = spark.createDataFrame([(1, "abcdefghij"), (2, "abc"), (3, "")], "doc_id long, text string")
    got = [tuple(r) for r in segments.windows(df, "doc_id", "text", 4, 3).orderBy("doc_id", "k").collect()]
    assert got == [(1, 0, 0, 4, "abcd"), (1, 1, 3, 7, "defg"), (1, 2, 6, 10, "ghij"), (2, 0, 0, 4, "abc"), (3, 0, 0, 4, "")]
    assert [r["window"] for r in segments.windows(df.where("doc_id = 1"), "doc_id", "text", 4, 4).collect()] == ["abcd", "efghij"]


def test_repair_by_characters():
    broken = lambda t, e: t.encode().decode(e)
    assert web.repaired("DespuÃ©s de mayorÃ\xada, resúmenes — и漢字") == "Después de mayoría, resúmenes — и漢字"
    assert web.repaired(broken("“naïve” – 漢字 🙂 ß", "latin-1")) == "“naïve” – 漢字 🙂 ß"
    assert web.repaired("It’s".encode().decode("cp1252")) == "It’s"
    for sound in ("", "plain", "Ãndrea", "â la carte", "CÔTÉ Â", "ÀÉÎÕÜ ñ ç", "漢字", "š € ™"):
        assert web.repaired(sound) == sound


def test_blocks_that_restart(spark):
    rows = [("a", i, n) for i, n in enumerate([3, 4, 4, 9, 10, 1, 1, 1])] + [(None, 0, 10), (None, 1, 1), ("b", 5, 0)]
    df = spark.createDataFrame(rows, "k string, i long, n long")
    got = {(r["k"], r["i"]): r["b"] for r in ranges.restarting_blocks(df, ["k"], "i", "n", 10, "b").collect()}
    assert [got["a", i] for i in range(8)] == [0, 0, 1, 2, 3, 4, 4, 4] and got[None, 0] == 0 and got[None, 1] == 1 and got["b", 5] == 0
    one = spark.range(200_000).select(F.lit("hot").alias("k"), F.col("id").alias("i"), F.lit(1).cast("long").alias("n"))
    assert ranges.restarting_blocks(one, ["k"], "i", "n", 7, "b").agg(F.max("b")).first()[0] == 199_999 // 7
    assert ranges.restarting_blocks(df.limit(0), ["k"], "i", "n", 10, "b").count() == 0


def test_fuzzy_recall_against_brute_force(spark):
    """Of the pairs whose 24-grams are alike to nine tenths or more, at least nine in ten are in one group."""
    import random

    r = random.Random(3)
    rows = []
    for base in range(30):
        text = " ".join("".join(r.choice("abcdefghijklm") for _ in range(r.randint(2, 9))) for _ in range(150))
        for _ in range(4):
            t = list(text)
            for _ in range(r.randint(0, 2)):
                t[r.randrange(len(t))] = "z"
            rows.append((len(rows), "".join(t)))
    groups = {x["node"]: x["component"] for x in dedup.fuzzy_groups(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    sets = [{t[i : i + 24] for i in range(len(t) - 23)} for _, t in rows]
    alike = [(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows)) if len(sets[a] & sets[b]) >= 0.9 * len(sets[a] | sets[b])]
    found = [groups.get(a, -1) == groups.get(b, -2) for a, b in alike]
    assert len(alike) > 60 and sum(found) >= 0.9 * len(found)
