"""Queries that take all rows of their tables: against brute force over the whole tables, with cases that a cut would lose."""

import numpy as np
import pyarrow.parquet as pq

from quernstone.operators import packing, relational, retrieval
from quernstone.plans import registry


def test_range_join_takes_all_events_and_parts(spark, sf):
    events, parts = (pq.read_table(f"{sf}/{t}.parquet").to_pylist() for t in ("events", "part"))
    prices = [(p["p_partkey"], float(p["p_retailprice"]) / 20) for p in parts]
    want = sorted((e["event_id"], k) for e in events if e["value"] is not None for k, lo in prices if lo <= e["value"] < lo + 0.5)
    got = sorted(tuple(r) for r in registry.QUERIES["range_join_prices"](spark, sf).select("event_id", "p_partkey").collect())
    assert got == want and any(e % 50 for e, _ in got) and any(k % 10 for _, k in got)


def test_range_join_of_hot_buckets_odd_values_and_ties(spark, monkeypatch):
    monkeypatch.setattr(relational, "BLOCK_ROWS", 4)
    monkeypatch.setattr(relational, "POINT_ROWS", 16)
    monkeypatch.setattr(relational, "RANGE_ROWS", 8)
    r = np.random.default_rng(6)
    nan, odd = float("nan"), [-0.0, 0.0, -3.25, 1e12, 2.0, 2.5, 900.0]
    points = [*enumerate([*odd, *odd, *r.choice([2.0, 2.25, 2.5, 7.0], 150).tolist()]), (900, None), (901, nan), (902, 2.0), (902, 2.0)]
    ranges = [*((i, lo, lo + w) for i, (lo, w) in enumerate(zip(r.choice([1.5, 2.0, 2.25, 6.9], 90).tolist(), r.choice([0.5, 0.25, 6.0, 0.0], 90).tolist(), strict=True)))]
    ranges += [(500, -4.0, 950.0), (501, 3.0, 1.0), (502, None, 3.0), (503, 0.0, 0.5), (504, 0.0, 0.5), (505, 0.0, None)]
    p, q = spark.createDataFrame(points, "i long, v double").repartition(3), spark.createDataFrame(ranges, "k long, lo double, hi double").repartition(2)
    out = relational.range_join(p, q, "v", "lo", "hi", 1.0)
    want = sorted((i, k) for i, v in points if v is not None for k, lo, hi in ranges if lo is not None and hi is not None and lo <= v < hi)
    assert sorted((x["i"], x["k"]) for x in out.collect()) == want and out.columns == ["i", "v", "k", "lo", "hi"]
    assert out.rdd.getNumPartitions() > 20 and relational.range_join(p.limit(0), q, "v", "lo", "hi", 1.0).count() == 0


def test_range_join_is_written_in_few_bytes(spark, tmp_path):
    p = spark.range(3000).selectExpr("id * 1000003 % 4000037 AS i", "id % 3000 / 10000 + 45.5 AS v")
    q = spark.range(4000).selectExpr("id * 999983 % 5000011 AS k", "45 + id % 10 / 20 AS lo", "45.5 + id % 10 / 20 AS hi")
    relational.range_join(p, q, "v", "lo", "hi", 1.0).select("i", "k").write.parquet(f"{tmp_path}/out")
    rows = sum(pq.read_metadata(f).num_rows for f in tmp_path.glob("out/*.parquet"))
    want = p.join(q, (p.v >= q.lo) & (p.v < q.hi)).count()
    assert rows == want > 5_000_000 and sum(f.stat().st_size for f in tmp_path.glob("out/*.parquet")) < 0.3 * rows


def test_hard_negatives_look_below_any_rank(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 2)
    monkeypatch.setattr(retrieval, "SCORE_CELLS", 50)
    r = np.random.default_rng(5)
    v = np.abs(r.normal(size=(200, 8)))
    positives = {0: [1, 2], 1: [0], 2: [int((v @ v[2] / np.linalg.norm(v, axis=1)).argmin())], 3: [190, 191, 192, 193]}
    rows = [(i, x) for i, x in enumerate(v.tolist())] + [(200, None), (201, [0.0] * 8)]
    e = spark.createDataFrame(rows, "d long, v array<double>").repartition(3)
    q = spark.createDataFrame([(i, rows[i][1]) for i in range(5)], "q long, v array<double>")
    p = spark.createDataFrame([(k, d) for k, of in positives.items() for d in [*of, of[0], 200]], "q long, d long")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = []
    for k, of in positives.items():
        s = u @ u[k]
        ok = [i for i in range(200) if i != k and i not in of and s[i] <= 0.99 * s[of].min()]
        want += [(k, i, n) for n, i in enumerate(sorted(ok, key=lambda i: (-round(s[i], 9), i))[:4], 1)]
    out = retrieval.hard_negatives(q, e, p, "q", "d", "v", 0.99, 4, same=True)
    assert sorted((x["q"], x["d"], x["rank"]) for x in out.collect()) == sorted(want) and len(want) > 8
    assert retrieval.hard_negatives(q.limit(0), e, p, "q", "d", "v", 0.99, 4).count() == 0


def test_markdown_of_texts_with_any_line_end(spark, tmp_path):
    import duckdb

    text = "# a\r\n> b\r\n- c\r# d\r> e\u2028* f\x85# g\n# h\r"
    spark.createDataFrame([(1, text), (2, "## plain"), (3, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["plain"] for r in registry.QUERIES["markdown_removal"](spark, str(tmp_path)).collect()}
    assert got == {1: "a\r\nb\r\nc\r# d\r> e\u2028* f\x85# g\nh\r", 2: "plain"}
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert {r[0]: r[1] for r in c.execute(registry.ORACLE["markdown_removal"]).fetchall()} == got


def test_page_elements_of_questions_with_angle_brackets(spark, tmp_path):
    spark.createDataFrame([(1, "is a < b > c?"), (2, "<p>x</p>"), (3, None)], "item_id long, question string").write.parquet(f"{tmp_path}/eval_items.parquet")
    got = {r["item_id"]: r["content"] for r in registry.QUERIES["page_elements"](spark, str(tmp_path)).collect()}
    assert got == {1: "is a < b > c?", 2: "<p>x</p>"}


def test_packs_cut_only_items_longer_than_the_capacity(spark, tmp_path):
    import hashlib

    r = np.random.default_rng(4)
    rows = [(i, "d", int(i % 2), r.integers(0, 999, n).tolist(), None) for i, n in enumerate([1500, 1024, 1, *r.integers(1, 700, 60).tolist()])]
    spark.createDataFrame(rows, "seq_id long, dataset string, shard_index int, input_ids array<int>, loss_mask array<int>").write.parquet(f"{tmp_path}/token_sequences.parquet")
    got = registry.QUERIES["materialized_packs"](spark, str(tmp_path)).orderBy("shard_index", "bin").collect()
    want = []
    for shard in (0, 1):
        lists = [x[3][:1024] for x in rows if x[2] == shard]
        bins = packing.next_fit([len(x) for x in lists], 1024)
        want += [(shard, b, hashlib.md5(",".join(str(t) for i in items for t in lists[i]).encode()).hexdigest(), len(items)) for b, items in enumerate(bins)]
    assert [(x["shard_index"], x["bin"], x["ids"], len(x["starts"].split(","))) for x in got] == want


def test_tags_of_any_kind_are_stripped(spark, tmp_path):
    import duckdb

    texts = ["<p>a <b>b</b></p>\n<br>c", "x<SCRIPT type='m'>if (a < b) {}\n</Script>y<style>p {}</style>z", "<script>a<style></script>b</style>c", "<styled>d</styled>", "no tag", "  1 < 2 ", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["plain"] for r in registry.QUERIES["tag_stripping"](spark, str(tmp_path)).collect()}
    assert got == {0: "a b c", 1: "x y z", 2: "b c", 3: "d", 4: "no tag", 5: "1 < 2", 6: ""}
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert {r[0]: r[1] for r in c.execute(registry.ORACLE["tag_stripping"]).fetchall()} == got


def test_base64_holds_the_whole_text(spark, tmp_path):
    import base64

    texts = ["", "short", "ü€ " * 100, "line\r\n" * 40]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["b64"] for r in registry.QUERIES["hash_functions"](spark, str(tmp_path)).collect()}
    assert {k: base64.b64decode(v, validate=True).decode() for k, v in got.items()} == dict(enumerate(texts))


def test_main_text_of_signs_that_look_like_markup(spark, tmp_path):
    from quernstone.operators import web

    good = "The team of the archive keeps all of the old notes for the people who look at them, and the rest of the pages are in the same place as they were before. It is not much, but it is what we have, and we will be at it for some time."
    odd = ["x![ <![0\n[ x|a c09> y", "<![foo[x]]>", "<![ ]", "<![", "<![x", "<!", "<!%>", "&#" + "9" * 5000 + ";", "&#" + "0" * 5000 + "65;", "&#xD800;"]
    texts = [f"{x}\n\n{good}" for x in odd[:2]] + [f"{good}\n\n{x}" for x in odd]
    spark.createDataFrame([*enumerate(texts), (99, None), (100, "")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["chars"] for r in registry.QUERIES["html_main_text"](spark, str(tmp_path)).collect()}
    assert got.keys() == {*range(len(texts)), 100} and all(got[i] >= len(good) for i in range(len(texts)))
    assert web.main_text(f"<p>{good} <![0 x> &#{'0' * 5000}65; &#{'9' * 5000};</p>") == f"{good} A \ufffd"
    assert web.main_text(f"<p>{good}</p><![CDATA[a > b]]><p>{good}</p>") == f"{good}\n{good}"
