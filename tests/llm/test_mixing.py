"""Sources that cannot reach their target, found in the filled blend."""

from quernstone.llm import mixing, queries


def test_found_comes_from_the_filled_blend(spark, sf, monkeypatch):
    filled, whole = [], mixing.blend
    monkeypatch.setattr(mixing, "blend", lambda *a, **k: filled.append(whole(*a, **k)) or filled[-1])
    assert queries.p1_found(spark, sf).count() > 0 and len(filled) == 1
    # the blend decides on the candidates: without its slots a source of large supply is none
    planned = spark.createDataFrame([("b", "x", 10.0**9, 10**8), ("b", "y", 5.0, 10), ("b", "z", 11.0, 10)], "blend string, name string, target double, supply long")
    none = filled[0].limit(0)
    assert {r["name"] for r in mixing.unreached(none, planned).collect()} == {"z"}
    empty = spark.createDataFrame([("b", "x", None)], "blend string, name string, block long")
    assert {r["name"] for r in mixing.unreached(empty, planned).collect()} == {"x", "z"}


def test_targets_close_to_the_supply(spark):
    """Sources whose targets are hardly above or below their supply, so that the draw alone can't tell."""
    sizes = {f"s{i}": 40_000 + 997 * i for i in range(12)}
    docs = spark.createDataFrame([(1000 * i + j, n, c // 40) for i, (n, c) in enumerate(sizes.items()) for j in range(40)], "doc_id long, source string, n_chars long")
    rows = [(b, ratio, n, float(c) * (1 + 0.002 * (i % 2)), None, 1) for b, ratio in (("even", 1.0), ("twice", 2.0), ("half", 0.5)) for i, (n, c) in enumerate(sizes.items())]
    spec = spark.createDataFrame(rows, "blend string, size_ratio double, name string, weight double, category string, max_repeats int")
    planned = mixing.plan(docs, spec)
    want = sorted(tuple(r) for r in mixing.shortfalls(planned).collect())
    for seed in range(3):
        got = mixing.unreached(mixing.blend(docs, spec, block_chars=256, seed=seed), planned, block_chars=256)
        assert sorted(tuple(r) for r in got.collect()) == want
    assert 12 < len(want) < 24 and {b for b, _ in want} == {"even", "twice"}
    assert mixing.unreached(mixing.blend(docs.limit(0), spec), mixing.plan(docs.limit(0), spec)).count() == 0
