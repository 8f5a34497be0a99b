"""The training-data operators against brute force, exact round trips and held-out accuracy, and their edge cases."""

import math
import os
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quernstone.functions.words import words
from quernstone.llm import binpack, bpe, leakage, mixing, neardup, queries
from quernstone.session import table
from tests import oracle

PROSE = "We measured fewer late pages than before, so the team of the archive keeps the old notes. The reviewers look at them on the second pass."


# queries


@pytest.fixture(scope="module")
def duck(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, sf, duck, name):
    oracle.same(queries.QUERIES[name](spark, sf), duck, queries.ORACLE[name])


# 6: encoding


@pytest.fixture(scope="module")
def vocab():
    if not os.path.exists(bpe.VOCAB):
        pytest.skip("no vocabulary here")
    return bpe.load()


@given(st.text(max_size=60) | st.text(alphabet=" \t\n\x1c  'sdtmlvre1é漢.!", max_size=40))
@settings(max_examples=300, deadline=None)
def test_encoding_equals_the_library_and_decodes(vocab, text):
    from tokenizers import Tokenizer

    t = test_encoding_equals_the_library_and_decodes.__dict__.setdefault("t", Tokenizer.from_file(bpe.VOCAB))
    t.encode_special_tokens = True
    ids = test_encoding_equals_the_library_and_decodes.__dict__.setdefault("e", bpe.encoder(vocab))(text)
    assert ids == t.encode(text, add_special_tokens=False).ids
    assert bpe.decode(ids, vocab) == text


def test_encoding_edges(spark, vocab):
    rows = [(1, None, 0), (2, "", 0), (3, "a" * 50_000, 0), (4, "hello", 0), (4, "hello", 0), (None, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    out = sorted(((r["doc_id"] or 0), len(r["ids"])) for r in bpe.encode_texts(df).collect())
    assert [x for x in out if x[0] in (1, 2)] == [(1, 0), (2, 0)] and len(out) == 6
    back = {r["doc_id"]: r["text"] for r in bpe.decode_ids(bpe.encode_texts(df)).collect()}
    assert back[3] == "a" * 50_000 and back[1] == ""
    assert bpe.encode_texts(df.limit(0)).count() == 0


# 2: near-duplicates


def _brute_pairs(rows, width, threshold, least):
    sets = {}
    for i, t in rows:
        ws = words(t) if t else []
        if len(ws) >= least:
            sets[i] = {tuple(ws[k : k + width]) for k in range(max(1, len(ws) - width + 1))}
    ids = sorted(sets)
    return {(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9}


@pytest.mark.parametrize("bucket", [512, 3])
def test_near_duplicates_against_brute_force(spark, bucket):
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for base in range(12):
        text = [r.choice(vocabulary) for _ in range(80)]
        for _ in range(5):
            t = list(text)
            for _ in range(r.randint(0, 9)):
                t[r.randrange(len(t))] = r.choice(vocabulary)
            rows.append((len(rows), " ".join(t)))
    rows += [(len(rows) + i, rows[0][1].upper() + "!") for i in range(3)] + [(900, None), (901, ""), (902, "too short")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rep", F.lit("clash")).withColumn("n", F.lit("clash"))
    members, found, reached = neardup.near_duplicates(df, **queries.P2, bucket=bucket, block=4)
    assert {tuple(x) for x in neardup.document_pairs(members, found, block=2).collect()} == _brute_pairs(rows, 3, 0.6, 50)
    assert reached >= neardup.RECALL
    groups = {x["doc"]: x["group"] for x in neardup.groups(members, found).collect()}
    assert len(groups) == len(rows) - 3 and all(groups[a] == groups[b] for a, b in _brute_pairs(rows, 3, 0.6, 50))


def test_near_duplicates_of_nothing(spark):
    members, found, reached = neardup.near_duplicates(spark.createDataFrame([(1, None)], "doc_id long, text string"))
    assert members.count() == 0 and found.count() == 0


def test_hot_node_and_copies(spark):
    """All texts share a run of words that half of all choices fall on, and half of the texts are one text: the node is found heavy and nothing is lost."""
    r = random.Random(9)
    shared = " ".join(f"s{i}" for i in range(40))
    rows = [(i, shared + " " + " ".join(f"x{r.randrange(10**6)}" for _ in range(8))) for i in range(300)] + [(300 + i, shared + " and the same end of it") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    members, found, _ = neardup.near_duplicates(df, width=3, threshold=0.6, bucket=8, block=64)
    assert members.groupBy("rep").count().agg(F.max("count")).first()[0] == 300
    assert {tuple(x) for x in neardup.document_pairs(members, found, block=64).collect()} == _brute_pairs(rows, 3, 0.6, 1)
    base = neardup._signatures(df, "doc_id", "text", 3, 1, 0, 3, 3, 5.0)
    rows_ = base.select(F.col("doc").alias("rep"), F.explode("picks_0").alias("node"))
    assert 0 < len(neardup._heavy(rows_, 2)) <= neardup.HEAVY_NODES


def test_recall_is_reached_or_the_join_fails(spark):
    df = spark.createDataFrame([(i, " ".join(f"w{j + i // 2 * 100 + (j == 3) * i}" for j in range(60))) for i in range(80)], "doc_id long, text string")
    assert 0 < neardup.sketch_loss(0.6) < 2e-4 and neardup.sketch_loss(0.8) < 2e-4
    with pytest.raises(RuntimeError, match="recall"):
        neardup.near_duplicates(df, width=3, threshold=0.6, runs=1, levels=1, branch=0.05, most_rounds=1)
    with pytest.raises(ValueError, match="runs"):
        neardup.near_duplicates(df, runs=9)


# 7: leakage


def _brute_leaks(docs, items):
    out = set()
    for d, t in docs:
        text = f" {' '.join(words(t))} " if t else ""
        for item, *fields in items:
            for f in fields:
                ws = words(f) if f else []
                if len(ws) >= 8:
                    k = min(13, len(ws))
                    if any(f" {' '.join(ws[i : i + k])} " in text for i in range(len(ws) - k + 1)):
                        out.add((d, item))
    return out


def test_leaks_against_brute_force(spark):
    r = random.Random(2)
    vocabulary = ["a", "b", "the", "of", "archive", "keeps", "old", "notes", "page", "x1", "über"]
    fields = [" ".join(r.choice(vocabulary) for _ in range(n)) for n in (7, 8, 9, 12, 13, 14, 30, 40)]
    items = [(i, f, fields[-1 - i] if i % 2 else None) for i, f in enumerate(fields)] + [(99, None, None), (100, "", fields[6])]
    docs = []
    for i in range(60):
        ws = [r.choice(vocabulary) for _ in range(30)]
        f = words(r.choice(fields))
        k = r.randint(5, 16)
        at = r.randint(0, max(0, len(f) - k))
        docs.append((i, ", ".join(ws[:10] + f[at : at + k] + ws[10:])))
    docs += [(60, None), (61, ""), (62, fields[4].upper()), (63, "x" + fields[4]), (64, fields[4] + "s")]
    d, e = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1)), spark.createDataFrame(items, "item_id long, question string, passage string")
    assert {tuple(x) for x in leakage.leaks(d, e).collect()} == _brute_leaks(docs, items)
    assert leakage.leaks(d, e.limit(0)).count() == 0 and leakage.leaks(d.limit(0), e).count() == 0
    assert {tuple(x) for x in leakage.leaks(d, e, most_index_chars=150).collect()} == _brute_leaks(docs, items)


def test_leaks_with_edits(spark):
    q = "which statement best describes the situation of the archive when the old notes are lost in winter"
    docs = [(1, f"so {q} then"), (2, q.replace("archive", "archve").join(["so ", " then"])), (3, q.replace("old notes", "new pages")), (4, "nothing of it here at all, really")]
    d, e = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, q, None)], "item_id long, question string, passage string")
    assert {x["doc_id"] for x in leakage.leaks(d, e).collect()} == {1}
    assert {x["doc_id"] for x in leakage.leaks(d, e, edits=1).collect()} == {1, 2}
    assert leakage.aligned("abc def", "xx abc deg yy", 1) == 1 and leakage.aligned("abc", "abcd", 0) is None


# 3: containers


@given(st.lists(st.integers(1, 50), max_size=80), st.integers(1, 6))
@settings(max_examples=80, deadline=None)
def test_open_bins(lengths, most):
    b = binpack.OpenBins(50, most)
    out = [x for i, n in enumerate(lengths) for x in b.put((i, n), n)] + list(b.flush())
    assert sorted(i for x in out for i, _ in x) == list(range(len(lengths)))
    assert all(0 < sum(n for _, n in x) <= 50 for x in out)


def test_fullest_closes_first():
    b = binpack.OpenBins(10, 2)
    assert [list(b.put(n, n)) for n in (6, 7)] == [[], []]
    assert list(b.put(5, 5)) == [[7]]
    assert list(b.put(4, 4)) == [[6, 4]]


def test_packs_hold_every_token_once(spark):
    r = random.Random(1)
    rows = [(i, "a" if i % 3 else None, i % 2, [i] * r.choice([1, 5, 30, 70, 250]), [1] * 3 if i % 5 == 0 else None) for i in range(60)]
    rows += rows[:5] + [(100, "a", 0, [], None), (101, "a", 0, None, None), (None, "a", 0, [7, 7], [0, 1]), (None, "a", 0, [7, 7], None)]
    df = spark.createDataFrame(rows, "seq_id long, dataset string, shard_index int, input_ids array<int>, loss_mask array<int>").withColumn("lane", F.lit("x"))
    sizes = spark.createDataFrame([("a", 100)], "dataset string, pack_size int")
    packs = binpack.pack(df, sizes, default_size=64, lane_tokens=800).collect()
    want = Counter(t for i, _, _, ids, _ in {str(x): x for x in rows if x[0] is not None}.values() for t in ids or []) + Counter({7: 4})
    assert Counter(t for p in packs for t in p["input_ids"]) == want
    for p in packs:
        assert len(p["input_ids"]) <= p["pack_size"] == (100 if p["dataset"] else 64) and len(p["loss_mask"]) == len(p["input_ids"])
        ends = [*p["seq_start_id"][1:], len(p["input_ids"])]
        assert len(p["seq_ids"]) == len(ends) and all(p["loss_mask"][e - 1] == 0 for e in ends)
    places = binpack.placements(df, sizes, default_size=64, lane_tokens=800).groupBy("seq_id").agg(F.countDistinct("lane", "bin").alias("bins"), F.sum("tokens").alias("n"), F.first("pack_size").alias("size")).where("seq_id is not null")
    assert all(x["bins"] == math.ceil(x["n"] / x["size"]) for x in places.collect())
    assert binpack.pack(df.limit(0), sizes).count() == 0


# 1: blends


def test_permutations():
    for n in (1, 2, 3, 10, 97, 1000):
        j = np.arange(n)
        out = mixing.permute(j, np.full(n, n), np.full(n, 12345, np.uint64))
        assert sorted(out.tolist()) == list(range(n))
    assert mixing.permute(np.arange(1000), np.full(1000, 1000), np.full(1000, 1, np.uint64)).tolist() != mixing.permute(np.arange(1000), np.full(1000, 1000), np.full(1000, 2, np.uint64)).tolist()


def test_blend_reaches_its_shares(spark):
    docs = [(i, s, "x" * 997) for i, s in enumerate([" Web"] * 600 + ["code"] * 300 + ["rare "] * 20 + [None] * 10)]
    docs = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumn("n_chars", F.length("text").cast("long")).withColumn("name", F.lit("clash"))
    spec = [("b", 2.0, "WEB", 3.0, "w", 4), ("b", 2.0, "web ", 3.0, "w", 4), ("b", 2.0, "code", None, "c", 5), ("b", 2.0, "rare", 1.0, "r", 2), ("b", 2.0, "none", 0.0, "n", 1), ("b", 2.0, "ghost", 1.0, "g", 1), ("b", 2.0, None, 1.0, "g", 1)]
    spec = spark.createDataFrame(spec, "blend string, size_ratio double, name string, weight double, category string, max_repeats int")
    planned = mixing.plan(docs, spec)
    assert {r["name"] for r in mixing.shortfalls(planned).collect()} == {"rare", "ghost"}
    mixed = mixing.blend(docs, spec, block_chars=256, shard_slots=64).cache()
    uses = mixed.where("block is not null").groupBy("name", "block").agg(F.count("*").alias("n")).groupBy("name").agg(F.max("n").alias("most"), F.min("n").alias("least")).collect()
    assert all(r["most"] <= {"web": 4, "code": 5, "rare": 2}[r["name"]] and r["most"] - r["least"] <= 1 for r in uses)
    got = {r["name"]: r for r in mixing.shares(mixed, planned).where("by_category = 0").collect()}
    assert abs(got["web"]["reached_chars"] / got["web"]["target_chars"] - 1) < 0.1 and got["ghost"]["reached_chars"] == 0
    texts_ = mixing.block_texts(mixed.where("name = 'rare'"), docs)
    assert {len(r["text"]) for r in texts_.collect()} <= set(range(1, 257))
    assert mixing.blend(docs.limit(0), spec).count() == 0 and mixing.plan(docs, spec.limit(0)).count() == 0


def test_brute_force_on_the_tables(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text").collect()
    items = table(spark, sf, "eval_items").select("item_id", "question", "passage").collect()
    assert {tuple(r) for r in queries.p7_found(spark, sf).collect()} == _brute_leaks([tuple(r) for r in docs], [tuple(r) for r in items])
    assert {tuple(r) for r in queries.p2_found(spark, sf).collect()} == _brute_pairs([tuple(r) for r in docs], 3, 0.6, 50)


