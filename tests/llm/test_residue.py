"""The residue classifier: the model alone decides; held-out hosts, planted sentences, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.llm import residue
from quernstone.session import table

PROSE = "We measured fewer late pages than before, so the team of the archive keeps the old notes. The reviewers look at them on the second pass."
RESIDUE = {
    "placeholder": ["Hello {{ first_name }}, thank you.", "Dear [YOUR CITY], welcome.", "Welcome to %(city)s, the home of @@author@@.", "This page about [object Object] was last changed.", "All rights to (add company here) belong to us."],
    "filler": ["Lorem ipsum dolor sit amet, consectetur elit sed magna.", "Your headline goes here.", "Votre titre apparaîtra ici."],
    "error_page": ["404 Not Found\nThe page /a/b does not exist on this server.", "Traceback (most recent call last):\n  File \"a.py\", line 3, in load\nKeyError: 'x'", "Error interno del servidor (500). Vuelva a intentarlo en 3 minutos."],
    "script_notice": ["Please enable JavaScript to view this page.", "Bitte aktivieren Sie JavaScript, um die Seite zu nutzen."],
    None: [PROSE, "In the prompt file, `{{ city }}` is filled from the seed record before the call is made.", "Here is the template:\n\n```\nDear {{ company }}, your request is on its way.\n```", "Visitors were asked in a survey whether they allow JavaScript, and most of them do.", "Older versions returned a 503 status during maintenance, which confused the retry counter.", "Designers often use Latin filler text in drafts, but the reviewers remove it."],
}


@pytest.fixture(scope="module")
def fitted(spark, sf):
    docs = table(spark, sf.replace("sf0.001", "sf0.1"), "documents")
    return docs, residue.fit(residue.sample(docs, "doc_id", "text", "source_id"))


def test_weak_labels():
    for c, ts in RESIDUE.items():
        for t in ts:
            found = {residue.label(" ".join(p)) for p in residue.sentences(residue.shown(t))} - {None}
            assert found == ({c} if c else set()), t


def test_sentences_and_features_agree():
    odd = ["", " . . ", "a.\n\n\n b. c", "****\n----", "x\x00y", "{{{{ a }}}}", "…… a… b", "²³ ½.  ", "\r\n\r\n q. \r\n", "İ. ﬁ!", "__ a __ . __"]
    shown = [residue.shown(t.replace("\x00", " ")) for t in odd]
    _, start, of = residue.features(shown)
    assert [int((of == i).sum()) for i in range(len(odd))] == [len(residue._labels(t)) for t in shown]
    w = np.random.default_rng(0).normal(size=(1 << residue.BITS, 5)).astype(np.float32)
    value, start, _ = residue.features(shown)
    assert np.allclose(residue.scores(w, value, start), residue.probabilities(w, shown)[0], atol=1e-4)


def test_unseen_hosts(fitted):
    report = fitted[1][2]
    assert report["sentences"] > 100 and report["precision"] > 0.97 and report["recall"] > 0.97 and report["cutoff"] in residue.CUTOFFS


def test_planted_sentences(spark, fitted):
    docs, (weights, cutoff, _) = fitted
    rows = [(f"{c}-{i}", PROSE + "\n\n" + t + "\n\n" + PROSE) for c, ts in RESIDUE.items() for i, t in enumerate(ts)] + [("none", None), ("empty", ""), ("long", PROSE * 5_000)]
    df = spark.createDataFrame(rows + rows[:1], "doc_id string, text string").withColumn("score", F.lit("clash"))
    got = residue.find(df, weights, cutoff).collect()
    assert len([r for r in got if r["doc_id"] == rows[0][0]]) == 2
    got = {r["doc_id"]: r["residue"] for r in got}
    want = {f"{c}-{i}": c for c, ts in RESIDUE.items() if c for i in range(len(ts))}
    assert set(got) <= set(want) and all(want[k] == v for k, v in got.items()) and len(got) >= 0.8 * len(want)


def test_the_model_alone_decides(spark, fitted):
    """Without weights there are no rows, and with those of another class only that class."""
    docs, (weights, cutoff, _) = fitted
    assert residue.find(docs, np.zeros_like(weights), 0.9).count() == 0
    turned = weights[:, [0, 2, 1, 3, 4]]
    count = lambda w: {r["residue"]: r["count"] for r in residue.find(docs, w, cutoff).groupBy("residue").count().collect()}
    plain, other = count(weights), count(turned)
    assert plain["placeholder"] == other["filler"] and plain["filler"] == other["placeholder"] and plain["error_page"] == other["error_page"]


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, None, None)], "doc_id long, text string, source_id string")
    rows = residue.sample(df, "doc_id", "text", "source_id")
    assert rows == [] and residue.sample(df.limit(0), "doc_id", "text", "source_id") == []
    weights, cutoff, report = residue.fit(rows)
    assert report["sentences"] == 0 and residue.find(df, weights, cutoff).count() == 0 and residue.find(df.limit(0), weights, cutoff).count() == 0
