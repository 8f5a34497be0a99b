"""Broken pairs: labelled examples, what the functions vote on, the label model, the validated cutoffs, edge cases."""

import itertools
import re
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.functions.words import WORD, normalize, words
from quernstone.llm import pairs
from quernstone.session import table

PROSE = "We measured fewer late pages than before, so the team of the archive keeps the old notes. The reviewers look at them on the second pass."
LABELLED = [
    ("How do I report a late delivery?", None, "empty"), ("How do I report a late delivery?", "n/a.", "empty"), ("How?", "​", "empty"), ("How?", "<think>\n</think>", "empty"), ("What is it?", "[]", "empty"),
    ("How do I report a late delivery?", "HOW DO I REPORT A LATE DELIVERY.", "copy"), ("Who pays for the return?", 'You asked: "Who pays for the return?"', "copy"), ("Is a lost parcel covered by the plan?", "Is a lost parcel by the plan?", "copy"),
    ("Who pays?", "I'm sorry, but I can't help with that.", "refusal"), ("Who pays?", "Hello and welcome. I'd rather not get into that topic. Have a nice day!", "refusal"), ("Wer zahlt?", "Dazu möchte ich mich nicht äußern. Bitte stellen Sie eine andere Frage.", "refusal"),
    ("Who pays the return postage of the parcel?", "Ersatz verlässt unser Lager innerhalb von 4 Tagen. Der Tarif gilt ab dem Kauf für 3 Monate.", "language"), ("¿Quién paga el envío?", "There is nothing to pay for the return. Take two photos in daylight.", "language"),
    ("Who pays?", "There is nothing to pay for the return. Once the form is sent, the status changes to", "truncated"), ("Who pays?", "There is nothing to pay.\n\n1. Open the page.\n2. Choose the entry.\n3. ", "truncated"), ("Who pays?", 'Take two photos.\n\n```json\n{"a": 4, "b": ', "truncated"),
    ("Who pays?", "I'm sorry about a late delivery; that should not have happened. There is nothing to pay for the return.", None), ("Who pays?", "I can't change the entry myself, but the form on the page does it at once.", None),
    ("Who pays? Bitte auf Deutsch.", "Für die Rücksendung müssen Sie nichts bezahlen.", None), ("Who pays?", "There is nothing to pay.\n- batches: 4\n- pages: 12", None), ("Who pays?", "There is nothing to pay.\n```\nx = 1\n```", None), ("Who pays?", "There is nothing to pay.\n\n– Team Lamp", None),
    ("Who pays the return?", 'You asked: "Who pays the return?" There is nothing to pay for the return. A replacement leaves our warehouse within 4 days of your report.', None),
]


@pytest.fixture(scope="module")
def answers(spark, sf):
    d = sf.replace("sf0.001", "sf0.01")
    return pairs.chat_pairs(table(spark, d, "sdg_chat"), table(spark, d, "sdg_preference")).cache()


def test_pair_defects(spark, answers):
    """Labelled examples among the answers of the tables, from which the label model learns."""
    rows = [(10**9 + i, "assistant_response", q, a, "EN", d) for i, (q, a, d) in enumerate(LABELLED)]
    rows += [(2 * 10**9 + i, "assistant_response", "Who pays the return postage?", f"{PROSE} It takes {i} days.", None, None) for i in range(120)]
    own = spark.createDataFrame([r[:5] for r in rows] + [rows[0][:5]], answers.schema)
    posts, cutoffs, _ = pairs.posteriors(answers.unionByName(own).withColumn("empty", F.lit("clash")))
    got = {r["record_id"]: r["defect"] for r in pairs.worst(posts, cutoffs).where("record_id >= 1000000000").collect()}
    wrong = [(q, a, d, got.get(10**9 + i)) for i, (q, a, d) in enumerate(LABELLED) if got.get(10**9 + i) != d]
    assert not wrong and not [i for i in got if i >= 2 * 10**9]


def test_functions_have_evidence_of_their_own(answers):
    """No defect's functions are copies of one another: on the answers that any of them votes against, each pair of functions disagrees somewhere."""
    rows = [tuple(r) for r in answers.select("query", "answer", "lang").distinct().collect()]
    mixed, positive = Counter(), Counter()
    for d in pairs.DEFECTS:
        votes = {tuple(pairs.VOTES[d](pairs.Pair(*r))) for r in rows}
        some = [v for v in votes if 1 in v]
        assert all(any(v[i] != v[j] for v in votes) for i in range(4) for j in range(i)), d
        assert len(some) >= 2, d
        for r in rows:
            v = pairs.VOTES[d](pairs.Pair(*r))
            positive[d] += v.count(1) >= 2
            mixed[d] += v.count(1) >= 2 and len(set(v)) > 1
    assert sum(mixed.values()) > 0.2 * sum(positive.values())


def test_cutoffs_are_validated(answers):
    _, cutoffs, report = pairs.posteriors(answers)
    assert set(cutoffs) == set(pairs.DEFECTS)
    for d, r in report.items():
        assert r["cutoff"] == cutoffs[d] and r["cases"] > 100 and r["precision"] > 0.95 and r["recall"] > 0.95, (d, r)


def test_cutoff_lies_in_the_widest_gap():
    models = {d: pairs.fit({}, 4) for d in pairs.DEFECTS}
    assert pairs.calibrated(models, [])[0] == dict.fromkeys(pairs.DEFECTS, pairs.DEFAULT)
    codes = {pairs.pattern(pairs.VOTES["empty"](pairs.Pair("Who pays for it?", a))) for a in ("", "n/a")}
    models["empty"] = {k: 0.2 if k in codes else 0.05 for k in range(81)}
    cut = pairs.calibrated(models, [("Who pays for the return of it?", PROSE, "en")] * 50)[0]["empty"]
    assert 0.05 < cut < 0.2


def test_label_model_finds_accuracies():
    r = np.random.default_rng(0)
    y = r.random(5000) < 0.1
    counts = Counter()
    for t in y:
        votes = [int(t if r.random() < acc else not t) if r.random() < 0.9 else -1 for acc in (0.97, 0.9, 0.93)]
        counts[pairs.pattern(votes)] += 1
    post = pairs.fit(counts, 3)
    assert post[pairs.pattern([1, 1, 1])] > 0.95 and post[pairs.pattern([0, 0, 0])] < 0.02
    assert pairs.unpattern(pairs.pattern([1, -1, 0]), 3) == [1, -1, 0] and pairs.fit({}, 3) == {} and len(post) == 27


def test_pairs_of_nothing(spark):
    schema = "record_id long, resp_field string, query string, answer string, lang string"
    none = spark.createDataFrame([], schema)
    posts, cutoffs, _ = pairs.posteriors(none)
    assert posts.count() == 0 and pairs.worst(posts, cutoffs).count() == 0 and pairs.defects(posts, cutoffs).count() == 0
    odd = spark.createDataFrame([(1, "response_a", None, None, None), (None, None, "", "", ""), (2, "response_b", None, "word " * 50_000, "xx"), (1, "response_a", None, None, None)], schema)
    assert pairs.posteriors(odd)[0].count() == 3


def test_models_and_cutoffs_come_from_all_answers(spark, answers):
    """The validation set holds every sound answer and all that it can be broken into; how the rows are split makes no difference."""
    rows = answers.count()
    votes = pairs.vote(answers).cache()
    counts = pairs.pattern_counts(votes)
    assert all(sum(counts["all"][d].values()) == rows for d in pairs.DEFECTS)
    _, cutoffs, report = pairs.posteriors(answers)
    sound = votes.where("sound").count()
    assert sound > 0.8 * rows > 2_000 and all(r["sound"] == sound for r in report.values()) and report["empty"]["cases"] == sound
    tuples = [tuple(r) for r in answers.select("query", "answer", "lang").collect()]
    models = {d: pairs.fit(counts["all"][d], 4) for d in pairs.DEFECTS}
    assert pairs.calibrated(models, tuples) == (cutoffs, report)
    assert pairs.posteriors(answers.repartition(7, "answer"))[1:] == (cutoffs, report)


def test_broken_pairs_keep_only_what_still_holds():
    """What a broken pair takes over from the sound one gives the same votes as the pair computed anew."""
    for lang, q, a in (("EN", "Who pays the return of the parcel?", PROSE), (None, "Wer zahlt für die Rücksendung des Pakets an das Lager?", "Für die Rücksendung müssen Sie nichts bezahlen, und die Kosten trägt das Lager selbst."), ("de", "Straße, Größe und Maß: wer zahlt für das Paket?", "Für die Rücksendung müssen Sie nichts bezahlen, und die Kosten trägt das Lager.")):
        p = pairs.Pair(q, a, lang)
        _, good, got = pairs.judged(p)
        made = pairs.broken(p)
        assert good and got.keys() == made.keys() >= {"empty"}
        for d, x in made.items():
            assert got[d] == pairs.pattern(pairs.VOTES[d](pairs.Pair(x.query, x.answer, x.lang))), (d, x.answer)
    assert pairs.judged(pairs.Pair("Who pays?", "", "en"))[1:] == (False, {})


def test_fast_forms_give_what_the_definitions_give(answers):
    """Words and small letters of Latin-1 texts, names of languages, the likeness of a text without a run of words, which needs no matcher."""
    r = np.random.default_rng(3)
    odd = [*map(chr, range(0x180)), *"—“„…™́​KſﬁＡ東я", "\r\n"]
    made = ["".join(r.choice(odd, r.integers(1, 9))) for _ in range(20_000)] + [f"a{c}b{c.upper()}" for c in odd]
    for x in made + [x or "" for row in answers.select("query", "answer").distinct().collect() for x in row]:
        assert pairs._words(x) == words(x) and pairs._normal(x) == normalize(x), x
        assert pairs._cut(normalize(x)) == WORD.findall(normalize(x)), x
    for k, v in pairs.ASKED.items():
        for form in v.replace(r"\w*", "").split("|"):
            for name in itertools.product(*(x or y + (" " if z else "") for x, y, z in re.findall(r"\[(\w+)\]|(\w)(\??)", form))):
                name = "".join(name).replace(" ", "")
                assert k in pairs.Pair(f"Answer in {name}, please.", "").q.named and k in pairs.Pair(f"ANSWER IN {name.upper()}, PLEASE.", "").q.named, name
    for _ in range(2_000):
        q = [str(w) for w in r.permutation(12)[: r.integers(2, 13)]]
        i, j = sorted(r.integers(0, len(q) + 1, 2))
        for a in (q[:i] + q[j:], q[:i] + ["x"] + q[j:]):
            assert pairs._alike(q, a, True) == SequenceMatcher(None, q, a, autojunk=False).ratio()


def test_each_table_is_read_once_and_copies_need_no_matcher(spark, sf, monkeypatch):
    every = pairs.chat_pairs(table(spark, sf, "sdg_chat"), table(spark, sf, "sdg_preference"))
    assert every._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2
    sides = table(spark, sf, "sdg_preference").count()
    assert every.count() == table(spark, sf, "sdg_chat").count() + 2 * sides and every.where("resp_field = 'response_b'").count() == sides

    def never(*_, **__):
        raise AssertionError("a matcher")

    monkeypatch.setattr(pairs, "SequenceMatcher", never)
    q = "Who pays the return postage of my lost parcel?".split()
    for a in (q, q[1:], q[:4] + q[6:], q[:-1]):
        assert pairs.copy_votes(pairs.Pair(" ".join(q), " ".join(a)))[0] == 1


def test_a_query_that_is_the_answer_keeps_its_words():
    """What broken copies take over from the query is what they would give anew, also with an introduction, repeated sentences, markup and other letters."""
    for q in ("You asked: who pays for the return of it?", "Who pays? Who pays? Who pays for the return of it?", "Who *pays* for the return of <b>it</b> now?", "Straße, Maß und Größe: wer zahlt für das Paket?", "İs the ıtem ﬁxed or not by now?", "Who pays  for the  return of it?  "):
        assert len(pairs.Pair(q, PROSE).q.words) >= 6
        for i in range(40):  # what is drawn depends on the texts
            p = pairs.Pair(q, f"{PROSE} It takes {i} days.", "en")
            x = pairs.broken(p)["copy"]
            assert x.a.rest == pairs.Answer(x.answer).rest and pairs.copy_votes(x) == pairs.copy_votes(pairs.Pair(q, x.answer, "en")), (q, x.answer)


def test_patterns_are_tried_where_one_of_their_words_may_begin():
    """The set before the declining words has every letter that one begins with: without it the same sentences decline."""
    bare = re.compile(pairs.DECLINE.pattern.replace("(?=[a-ehikm-prsuvw])", "", 1), re.X)
    assert bare.pattern != pairs.DECLINE.pattern
    firsts = {m.group()[0] for x in (*pairs.DECLINING, "I'd rather not get into that.", "I refuse to answer.", "Unable to help.", "Damit kann ich nicht helfen.") if (m := bare.search(normalize(x)))}
    texts = [normalize(f"{x}{y}") for x in ("I'd ", "we ", "") for y in ("rather not discuss it", "refuse to answer", "unable to help", "won't share it", "shouldn't comment", "have to decline to answer", "damit nicht helfen", "verstößt gegen regeln", "beyond my rules", "outside what i", "helping with this isn't possible", "kann nicht helfen", "m'est impossible de répondre", "va en contra de mis", "prefiero no", "en tant que modèle", "imposible responder", "against policy")]
    assert len(firsts) > 5 and all(bare.search(x) and pairs.DECLINE.search(x) for x in texts)


def _drawn(parsed, r) -> str:
    """A text that a parsed pattern may match."""
    out = ""
    for op, av in parsed:
        match str(op):
            case "LITERAL":
                out += chr(av)
            case "BRANCH":
                out += _drawn(av[1][r.integers(len(av[1]))], r)
            case "SUBPATTERN":
                out += _drawn(av[-1], r)
            case "MAX_REPEAT":
                out += "".join(_drawn(av[2], r) for _ in range(r.integers(av[0], min(av[0] + 2, av[1]) + 1)))
            case "IN":
                out += {"NEGATE": " ", "CATEGORY": "x", "LITERAL": chr(av[0][1]) if str(av[0][0]) == "LITERAL" else ""}[str(av[0][0])]
    return out


def test_cheap_tests_pass_all_that_the_patterns_find():
    """Whatever DECLINE finds has one of its words or parts, whatever POLITE finds has one of its heads; also inside of longer words and in a text's points."""
    r = np.random.default_rng(4)
    found, kinds = 0, set()
    declining, polite = (re._parser.parse(x.pattern, x.flags & ~re.U) for x in (pairs.DECLINE, pairs.POLITE))
    for _ in range(20_000):
        s = r.choice(["", "x", "we "]) + _drawn(declining, r) + r.choice(["", "x", " so"])
        if m := pairs.DECLINE.search(s):
            found += 1
            kinds.add(m.group()[:4])
            ws = WORD.findall(s)
            assert not pairs._DECLINING_WORDS.isdisjoint(ws) or pairs._declining_part(s), s
        head = _drawn(polite, r).lstrip()[:3]
        assert head in pairs._POLITE_HEADS or head[:2] == "hi", head
    assert found > 10_000 and len(kinds) > 50
    for x in pairs.DECLINING:
        assert pairs.Answer(x).declining[0], x


def test_sentences_without_declining_words_need_no_pattern(monkeypatch):
    """Negative words alone, as sound answers have them, don't lead to the patterns; each pair's words are counted in one pass."""

    class Never:
        def search(self, s):
            raise AssertionError(s)

    monkeypatch.setattr(pairs, "DECLINE", Never())
    for q, a in (("Is a late parcel paid?", "It isn't late, so the fee does not apply. No page has changed outside the office."), ("Wer zahlt das?", "Das ist nicht neu, und es gibt keine Gebühr."), ("Qui paie cela ?", "Ce n'est pas le cas, et la page ne change pas.")):
        assert pairs.refusal_votes(pairs.Pair(q, a))[0] == 0
    a = pairs.Answer("The page is not new, sorry, and no topic is.")
    assert a.told == pairs.language(a.text) and a.declining[2] == sum(w in pairs.REFUSING for w in a.words) / len(a.words) == 0.2


def test_known_patterns_are_those_of_the_broken_pairs(answers):
    """Patterns that judging knows without a pair are what the votes on the broken pair give."""
    some = [pairs.Pair(*x) for x in answers.select("query", "answer", "lang").distinct().collect()]
    odd = ["Who pays? Who pays? Who pays for the return of it?", "Where is it now? Who pays for the return? Tell me.", 'Say "now"? Say "who pays". Say it once more.', "- - - - - - -", "no answer na none of it is there at all", "Go now. Go. We can wait for it here."]
    some += [pairs.Pair(q, f"{PROSE} It takes {i} days.", lang) for q in odd for i in range(20) for lang in (None, "EN")]
    known = set()
    for p in some:
        _, good, got = pairs.judged(p)
        if good:
            made = pairs.broken(p)
            assert got == {d: pairs.pattern(pairs.VOTES[d](pairs.Pair(x.query, x.answer, x.lang))) for d, x in made.items()}, (p.query, p.answer)
            known.update(got)
    assert known == set(pairs.DEFECTS)
