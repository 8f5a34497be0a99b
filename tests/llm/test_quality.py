"""Text statistics against plain Python, the learned rules on held-out documents, their SQL, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.functions.words import fold, words
from quernstone.llm import quality
from quernstone.session import table

PROSE = "We measured fewer late pages than before, so the team of the archive keeps the old notes. The reviewers look at them on the second pass."
SAMPLES = {
    "list": ["\n".join(f"- {a} {b}: {c}, tickets" for a, b, c in zip("Red Blue Green Grey Pale Dark Tall".split(), "lamp desk box chair shelf door plate".split(), "late dense empty rare packed short long".split())), "\n".join(f"{i}. queries ({i * 7})" for i in range(1, 12))],
    "table": ["| a | b |\n|---|---|\n" + "\n".join(f"| cell {i} | {i} |" for i in range(9)), "name;size;day\n" + "\n".join(f"x{i};{i};late" for i in range(9)), "<table>\n" + "\n".join(f"<tr><td>a{i}</td><td>{i}</td></tr>" for i in range(9)) + "\n</table>"],
    "junk": ["§$%& !?=+ ~#*<> " * 20, "QzAEWuqYeweOsJM6fRRUZBNMDn6vIAZqV6OyXRFymmXAbk73ffiIfqyaIveTrpw1k4TG0RMkfRwG\n" * 5, "=====\n-----\n" * 20, "buy cheap lamps " * 30, " ".join(str(i * 7919 % 99991) for i in range(90))],
    "prose": [PROSE * 4, "Guest: Who pays for it?\nAgent: There is nothing to pay for the return of it.\n" * 4, PROSE + "\n- one\n- two\n" + PROSE],
}


ODD = [None, "", " \n\t", "ﬁne ½ ＡＢＣ\u200bd  e\u00a0f.", "a_b-c d'e\r\n\r\nNext: line;\n\n«Fin.»", "漢字 и слова!", "x" * 100_000, "12 34b c5\n- one\n- two"]


def test_line_labels():
    for c, ts in SAMPLES.items():
        assert [quality.line_label(t) for t in ts] == [c] * len(ts)
    assert quality.line_label(None) == quality.line_label(" \n") == "prose"


def test_statistics_equal_plain_python(spark):
    ts = ODD + [t for x in SAMPLES.values() for t in x]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    got = {r["doc_id"]: r for r in quality.describe(df).collect()}
    for i, t in enumerate(ts):
        r = got[i]
        ws, plain = words(t or ""), fold(t or "")
        lines = [x for x in plain.split("\n") if x.strip(" ")] if plain.strip() else []
        dense, letters = sum(c not in " \n\t\r" for c in plain), sum(map(len, ws))
        stopped = sum(x.rstrip(quality.CLOSERS)[-1:] in quality.STOPS for x in lines if x.rstrip(quality.CLOSERS))
        want = {
            "n_chars": len(t or ""), "n_words": len(ws), "mean_word_length": letters / max(1, len(ws)), "symbol_ratio": max(0, dense - letters) / max(1, dense), "n_lines": len(lines),
            "punct_line_share": stopped / max(1, len(lines)), "common_word_share": sum(w in quality.FREQUENT for w in ws) / max(1, len(ws)), "distinct_share": len(set(ws)) / max(1, len(ws)),
        }
        assert {k: pytest.approx(v) for k, v in want.items()} == {k: r[k] for k in want}, (i, t and t[:50])


def test_rules_hold_out(spark, sf):
    """Rules from one half of the documents, against the labels of the other, which they never saw; the labeller's shares are no statistics."""
    docs = table(spark, sf.replace("sf0.001", "sf0.1"), "documents").select("doc_id", "text")
    rules, report = quality.learn(docs.where("doc_id % 2 = 0"))
    assert {c for c, _ in rules} == set(quality.CLASSES) and "CASE WHEN" in quality.case_sql(rules)
    assert all(r["precision"] > 0.9 and r["recall"] > 0.9 and r["held_out"] > 20 for r in report.values())
    rest = docs.where("doc_id % 2 = 1")
    both = quality.classify(rest, rules).select("doc_id", "text_class").join(quality.describe(rest, labelled=True).select("doc_id", "label"), "doc_id").collect()
    assert sum(r["text_class"] == r["label"] for r in both) >= 0.99 * len(both)
    for c in quality.CLASSES:
        right = sum(r["text_class"] == r["label"] == c for r in both)
        assert right >= 0.95 * sum(r["label"] == c for r in both) and right >= 0.95 * sum(r["text_class"] == c for r in both)


def test_sql_equals_rules(spark, sf):
    docs = table(spark, sf, "documents")
    rules = [("junk", [(3, ">", 0.3)]), ("list", [(8, "<=", 6.5), (7, ">", 4.0)]), ("table", [(1, ">", 300.0)])]
    rows = quality.classify(docs, rules).collect()
    assert [r["text_class"] for r in rows] == quality.apply_rules(rules, np.array([[r[s] for s in quality.STATISTICS] for r in rows])).tolist()


def test_induction_finds_planted_rules():
    r = np.random.default_rng(0)
    x = r.random((3000, len(quality.STATISTICS)))
    y = np.where(x[:, 2] > 0.9, "junk", np.where((x[:, 4] <= 0.3) & (x[:, 5] > 0.5), "list", "prose"))
    flipped = r.random(len(y)) < 0.02
    rules = quality.best_list(x, np.where(flipped, "table", y).tolist())
    assert (quality.apply_rules(rules, x) == y).mean() > 0.98
    assert quality.induce(x, ["prose"] * len(x)) == [] and quality._tightest([(1, ">", 2.0), (1, ">", 3.0), (1, "<=", 9.0)]) == [(1, ">", 3.0), (1, "<=", 9.0)]


def test_classes_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "\n "), (3, "\n ")], "doc_id long, text string").withColumn("label", F.lit(1))
    rows = quality.classify(df, quality.learn(df)[0]).collect()
    assert len(rows) == 4 and {r["text_class"] for r in rows} == {"prose"} and {r["n_words"] for r in rows} == {0}
    assert quality.learn(df.limit(0)) == ([], {}) and quality.classify(df.limit(0), []).count() == 0
