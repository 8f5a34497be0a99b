"""Operators on small tables with their invariants and edge cases."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quernstone.functions import text as T
from quernstone.functions.words import words
from quernstone.operators import blending, chat, dedup, packing, quality, relational, retrieval, segments, tokenization
from quernstone.operators.components import components
from quernstone.sources import discovery, readers, sinks


@given(st.lists(st.integers(0, 150), max_size=60), st.sampled_from(sorted(packing.PACKERS)))
@settings(max_examples=80, deadline=None)
def test_packers_keep_every_item_once(lengths, name):
    bins = packing.PACKERS[name](lengths, 100, 7)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(min(lengths[i], 100) for i in b) <= 100 for b in bins)
    assert bins == packing.PACKERS[name](lengths, 100, 7)


def test_first_fit_takes_the_first_bin():
    assert packing.first_fit([6, 5, 4, 5], 10) == [[0, 2], [1, 3]]
    assert packing.first_fit_decreasing([3, 7, 3, 7], 10) == [[1, 0], [3, 2]]
    assert packing.next_fit([6, 5, 4, 5], 10) == [[0], [1, 2], [3]]


@given(st.integers(1, 40), st.integers(1, 80))
@settings(max_examples=60, deadline=None)
def test_row_splits_are_disjoint_and_whole(files, shards):
    sizes = [(f"f{i:02d}", random.Random(i).randint(0, 100)) for i in range(files)]
    if shards > files:
        plan = blending.row_split_plan(sizes, shards)
        assert len(plan) == shards
        for p, _ in sizes:
            own = [(m, r) for q, m, r in plan if q == p]
            assert {m for m, _ in own} == {len(own)} and sorted(r for _, r in own) == list(range(len(own)))
    else:
        assert sorted(p for s in blending.balanced_plan(sizes, shards) for p in s) == [p for p, _ in sizes]


def test_shard_splits():
    paths = [(1.0, f"s{i}") for i in range(10)]
    out = blending.assign_splits(paths, 2, 1, 3)
    assert [len(out[k]) for k in ("train", "valid", "test")] == [7, 2, 1]
    assert sorted(p for v in out.values() for p in v) == paths
    assert blending.split_counts(2, 0.1, 0.1) == (0, 0) and blending.split_counts(10, 0.05, 0.1) == (1, 1)
    assert blending.sample_shards(100, "10%", "a", 1) == blending.sample_shards(100, "10%", "a", 1) and len(blending.sample_shards(100, "10%", "a", 1)) == 10
    assert blending.shard_count(0, 10) == 1 and blending.shard_count(21, 10) == 3
    with pytest.raises(ValueError):
        blending.validate_blend({"datasets": [{"name": "a"}], "train": [{"name": "b"}]})


def test_words():
    assert words("Ａｂ­c d_e 1½ don't") == ["abc", "d", "e", "11", "2", "don", "t"]
    assert words("") == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (103, 101), (200, 200), (None, 5)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 103: 100, 200: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_and_fuzzy_dedup(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away from here " * 4
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, ""), (6, base), (7, base + "!"), (8, "short")]
    df = spark.createDataFrame(rows, "id long, t string")
    assert sorted(r[0] for r in dedup.exact_survivors(df, "id", "t").collect()) == [1, 3, 4, 6, 7, 8]
    assert {tuple(r) for r in dedup.fuzzy_groups(df, "id", "t").collect()} == {(6, 6), (7, 6)}
    assert dedup.exact_duplicates(df.limit(0), "id", "t").count() == 0


def test_substring_dedup(spark):
    shared = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, f"a b {shared} c"), (2, f"x {shared} y z"), (3, None), (4, "few words")], "id long, t string")
    out = dict(map(tuple, dedup.substring_dedup(df, "id", "t", 25).collect()))
    assert out == {1: f"a b {shared} c", 2: "x y z", 3: None, 4: "few words"}
    assert dict(map(tuple, dedup.substring_dedup(df, "id", "t", 25, keep_first=False).collect()))[1] == "a b c"


def test_weighted_thresholds_against_formula(spark):
    import numpy as np

    r = np.random.default_rng(0)
    v, w = np.round(r.random(400), 2), r.integers(1, 50, 400)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(v, w)], "s double, w long")
    got = {r["p"]: r["threshold"] for r in quality.weighted_thresholds(df, ["s"], F.col("w")).collect()}
    order = np.argsort(v, kind="stable")
    cdf = np.cumsum(w[order]) / w.sum()
    assert got == {p: float(v[order][np.searchsorted(cdf, p / 100)]) for p in quality.PERCENTILES}


def test_segments(spark):
    df = spark.createDataFrame([(1, "a b\nc\nd e f\ng"), (2, "x"), (3, None), (4, "")], "id long, t string")
    lines = segments.split_lines(df, "id", "t")
    out = {(r["id"], r["block"]): r["text"] for r in segments.join_segments(lines, "id", "segment_id", "segment", 3).collect()}
    assert out == {(1, 0): "a b\nc", (1, 1): "d e f", (1, 2): "g", (2, 0): "x", (4, 0): ""}
    wins = {(r["id"], r["k"]): r["window"] for r in segments.windows(df.where("id < 3"), "id", "t", 5, 5).collect()}
    assert wins == {(1, 0): "a b\nc", (1, 1): "\nd e f\ng"[0:8], (2, 0): "x"}
    ranked = segments.global_rank(spark.range(1000).withColumn("k", F.md5(F.col("id").cast("string"))), ["k"], "r").orderBy("k").collect()
    assert [r["r"] for r in ranked] == list(range(1, 1001))


def test_sums_before(spark):
    rows = [(i, (i * 7) % 11) for i in range(500)]
    got = {r["i"]: r["before"] for r in segments.exclusive_sum(spark.createDataFrame(rows, "i long, v long"), "i", "v", "before").collect()}
    total = 0
    for i, v in rows:
        assert got[i] == total
        total += v


def test_chat_template():
    ms = [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yes", "reasoning_content": "think"}, {"role": "user", "content": "more"}, {"role": "assistant", "content": "ok", "reasoning_content": "again"}]
    text = "".join(c for _, c in chat.chunks(ms))
    assert text.startswith("<|im_start|>system\n<|im_end|>\n") and "<think></think>yes" in text and "<think>\nagain\n</think>\nok" in text
    assert [len(s) for s in chat.split_at_thoughts(ms)] == [2, 4]
    assert chat.split_at_thoughts([{"role": "user", "content": "a"}]) == [[{"role": "user", "content": "a"}]]
    tool = chat.chunks([{"role": "assistant", "content": "", "tool_calls": [{"function": {"name": "f", "arguments": '{"a": 1}'}}]}, {"role": "tool", "content": "x"}, {"role": "tool", "content": "y"}], [{"name": "f"}])
    assert [r for r, _ in tool] == ["system", "assistant", "user"] and "# Tools" in tool[0][1] and tool[2][1].count("<tool_response>") == 2


def test_render_reports_bad_rows(spark):
    df = spark.createDataFrame([(1, json.dumps({"messages": [{"role": "user", "content": "q"}]})), (2, "{bad"), (3, None)], "id long, j string")
    rows = chat.render(df, "id", "j").collect()
    assert [(r["id"], r["role"]) for r in rows] == [(1, "system"), (1, "user"), (2, None)]


def test_tokenizers(spark):
    assert tokenization.safely(lambda b: [[1]] * len(b) if "bad" not in b else 1 / 0, ["a", "bad", "c"]) == [[1], None, [1]]
    df = spark.createDataFrame([(1, "héllo"), (2, None), (3, "")], "id long, t string")
    out = {r["id"]: (r["ids"], r["truncated"]) for r in tokenization.tokenize(df, "id", "t", "bytes", most_tokens=3, eos=256).collect()}
    assert out == {1: ([104, 195, 169], True), 2: (None, False), 3: ([256], False)}


def test_masks(spark):
    df = spark.createDataFrame([(1, [5, 6, 7], [1, 0, 1]), (2, [8, 9], None)], "id long, i array<int>, m array<int>").withColumn("b", F.lit(0))
    r = packing.materialize_bins(df, ["b"], "id", "i", "m", 4).first()
    assert (r["input_ids"], r["loss_mask"], r["seq_start_id"]) == ([5, 6, 7, 8], [0, 1, 0, 1], [0, 3])


def test_retrieval(spark):
    e = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0])], "id long, v array<double>")
    q = e.where("id = 1").select(F.col("id").alias("q"), "v")
    got = [tuple(r) for r in retrieval.top_k(q, e.withColumnRenamed("id", "d"), "q", "d", "v", 2, same=True).select("d", "rank").orderBy("rank").collect()]
    assert got == [(2, 1), (3, 2)]
    assert retrieval.top_k(q.limit(0), e.withColumnRenamed("id", "d"), "q", "d", "v", 2).count() == 0
    d = retrieval.metric_delta(spark.createDataFrame([("m", 0.0), ("n", 2.0)], "k string, v double"), spark.createDataFrame([("m", 1.0), ("n", 1.0)], "k string, v double"), "k", "v").orderBy("k").collect()
    assert d[0]["percent"] == float("inf") and d[1]["percent"] == -50 and d[1]["drifted"]


def test_joins(spark):
    left = spark.createDataFrame([("a", 3, 1), ("a", 5, 2), ("b", 1, 3)], "k string, t int, id int")
    right = spark.createDataFrame([("a", 3, 30), ("a", 4, 40)], "k string, t int, x int")
    assert sorted(tuple(r) for r in relational.asof_join(left, right, ["k"], "t", ["x"]).select("id", "x").collect()) == [(1, 30), (2, 40), (3, None)]
    with pytest.raises(Exception, match="no partner"):
        relational.complete_left_join(left, right.select("k", "x"), "k").collect()


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2, 3]), (2, []), (3, None), (4, [70000])], "id long, ids array<int>").coalesce(1)
    parts = sinks.write_token_files(df, "ids", str(tmp_path / "tok"))
    assert sinks.read_token_file(parts[0][1]) == [[1, 2, 3], [70000]]
    with pytest.raises(Exception, match="does not fit"):
        sinks.write_token_files(df, "ids", str(tmp_path / "small"), "uint16")
    for kind in ("none", "zstd"):
        rows = sinks.write_jsonl(df.select("id", F.lit("ä").alias("t"), F.lit(None).cast("string").alias("n")), str(tmp_path / kind), kind)
        assert sum(r[2] for r in rows) == 4
    back = readers.read(spark, str(tmp_path / "none"), ["id", "t", "n"], "id long, t string, n string")
    assert sorted(r["id"] for r in back.collect()) == [1, 2, 3, 4] and back.first()["t"] == "ä"
    art = sinks.Artifacts(str(tmp_path / "art"))
    art.publish("x", df.select("id"))
    art.publish("x", df.select("id").where("id = 1"))
    assert art.read(spark, "art://x:v1").count() == 4 and art.read(spark, "art://x").count() == 1
    receipts = spark.createDataFrame([(0, "completed", 1), (0, "completed", 2), (1, "failed", 3)], "shard_index int, status string, created_at int")
    assert [r[0] for r in sinks.pending(spark.createDataFrame([(0,), (1,), (2,)], "shard_index int"), receipts).orderBy("shard_index").collect()] == [1, 2]


def test_discovery(spark, tmp_path):
    for n in ("train-0.parquet", "training.parquet", "note.txt"):
        (tmp_path / n).write_text("")
    assert [p.rsplit("/", 1)[1] for p in discovery.discover(str(tmp_path))] == ["train-0.parquet", "training.parquet"]
    df = spark.createDataFrame([("a/train-0.parquet",), ("a/training.parquet",), ("train/x.json",)], "p string")
    assert [r[0] for r in df.select(discovery.matches_split(F.col("p"), "train")).collect()] == [True, False, True]
    with pytest.raises(ValueError):
        discovery.folder_format(["a.json", "b.parquet"])
    assert discovery.fetch_limit([("a", 100), ("b", 100), ("c", 100)], 10, 8) == ["a", "b"]


def test_functions(spark):
    row = spark.range(1).select(
        T.size_in_bytes(F.lit("1.5G")).alias("size"), T.snake_case(F.lit("PackedSFTParquetStage")).alias("snake"), T.count_text(F.lit(1_500_000)).alias("count"), T.json_in_fences(F.lit('```json\n{"a": 1}\n```')).alias("j"),
        T.used_in(F.lit("a, b"), "b").alias("u"), T.is_number(F.lit("-3/4")).alias("n"), T.fill_question(F.lit("Q: {question}!"), F.lit("x")).alias("f"), T.without_quotes(F.lit('"a"')).alias("q"),
    ).first()
    assert (row["size"], row["count"], row["j"], row["u"], row["n"], row["f"], row["q"]) == (int(1.5 * 2**30), "1.5M", '{"a": 1}', True, True, "Q: x!", "a")


def test_web(spark):
    from quernstone.operators import web

    good = "The reviewers of the archive look at the notes that are on the page, and it is not for them to say which of the notes can be kept in the folder or not. " * 2
    html = f"<html><head><title>x</title></head><body><nav><a href='/'>home</a> <a href='/b'>more links here</a></nav><h1>Report</h1><p>{good}</p><p>Short.</p><p>{good}</p><script>var a;</script></body></html>"
    assert web.main_text(html).split("\n")[0] == "Report" and "home" not in web.main_text(html) and "var a" not in web.main_text(html)
    assert web.identify("Der Hund ist nicht auf dem Dach und wir auch nicht")[1] == "de" and web.identify("xyz") == (0.0, None)
    assert web.repaired("cafÃ©") == "café" and web.repaired("café") == "café" and web.repaired("漢字") == "漢字"
    assert web.char_f("abc def", "abc def") == 100 and web.char_f("abc", "xyz") == 0
    df = spark.createDataFrame([(1, None), (2, "")], "id long, t string")
    assert [r["language"] for r in web.languages(df, "id", "t").collect()] == [None, None]


def test_discovery_on_any_file_system(spark, tmp_path):
    for name in ("b.parquet", "a.jsonl", "_hidden.json", ".x.json", "notes.txt"):
        (tmp_path / name).write_text("x" * len(name))
    (tmp_path / "sub").mkdir()
    names = lambda found: [(p.rsplit("/", 1)[-1], n) for p, n in found]
    assert names(discovery.discover_with(spark, f"file://{tmp_path}")) == [("a.jsonl", 7), ("b.parquet", 9)]
    assert names(discovery.discover_with(spark, f"{tmp_path}/*.parquet")) == [("b.parquet", 9)]
    assert discovery.discover_with(spark, f"{tmp_path}/none/*") == []


def test_file_partitions():
    files = [("a", 5), ("b", 4), ("c", 20), ("d", 1), ("e", 9)]
    assert discovery.partitioned_by_size(files, 10) == [["a", "b"], ["c"], ["d", "e"]]
    assert discovery.partitioned_by_size([], 10) == [] and discovery.partitioned_by_count(list("abcde"), 2) == [["a", "b"], ["c", "d"], ["e"]]


def test_files_go_to_a_mounted_folder_only(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="mounted"):
        sinks.write_jsonl(df, "s3://bucket/x")
    sinks.write_jsonl(df, str(tmp_path / "out"))
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith(".mark")]


def test_json_answers_and_paths(spark):
    cases = {'["x", "y"]': "x", '{"a": "v", "b": 1}': "v", '{"n": 3}': "3", "plain": "plain", '"quoted"': "quoted", "12": "12", "[]": None, "{broken": "{broken", "": ""}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()] + [(None, None)], "raw string, want string")
    assert [r["raw"] for r in df.where(~T.json_answer(F.col("raw")).eqNullSafe(F.col("want"))).collect()] == []
    paths = {"https://a.b/c/d.txt?x=1#y": "c/d.txt", "data\\sub\\f.png": "data/sub/f.png", "./x/y": "x/y", "f": "f", "": ""}
    df = spark.createDataFrame(list(paths.items()), "raw string, want string")
    assert df.where(~T.normalized_path(F.col("raw")).eqNullSafe(F.col("want"))).count() == 0
    got = spark.range(1).select(T.clip_key(F.lit("v_1_2.50_7")).alias("a"), T.restored(F.lit(None).cast("string"), F.lit("q\n\n"), F.lit("\n")).alias("b")).first()
    assert tuple(got) == ("v_1", "q") and T.segment_budget(2048, 46) == 2000


def test_shard_states_cases(spark):
    receipts = [(1, "completed", "2026-01-01 00:00:00", "p2", "o1"), (2, "started", "2026-01-01 00:50:00", "p2", None), (3, "started", "2026-01-01 00:10:00", "p2", None), (4, "failed", "2026-01-01 00:20:00", "p2", None), (5, "completed", "2025-12-01 00:00:00", "p1", "o5"), (6, "completed", "2026-01-01 00:30:00", "p2", "gone"), (4, "started", "2026-01-01 00:01:00", "p2", None)]
    r = spark.createDataFrame(receipts, "shard_index int, status string, created_at string, plan_hash string, output_file string").withColumn("created_at", F.col("created_at").cast("timestamp"))
    shards, there = spark.createDataFrame([(i,) for i in range(1, 8)], "shard_index int"), spark.createDataFrame([("o1",), ("o5",)], "output_file string")
    got = {x[0]: x[1] for x in sinks.shard_states(shards, r, F.lit("2026-01-01 01:00:00").cast("timestamp"), outputs=there).collect()}
    assert got == {1: "done", 2: "claimed", 3: "pending", 4: "failed", 5: "pending", 6: "pending", 7: "pending"}
    assert {x[1] for x in sinks.shard_states(shards, r.limit(0), F.current_timestamp()).collect()} == {"pending"}
