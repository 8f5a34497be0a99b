"""Leaks with edits against the edit distance to every part of a document that starts and ends at word ends."""

import random

from quernstone.llm import leakage


def _distance(window, doc):
    """The least number of edits between the window and a part of the document between word ends."""
    row = [0 if j == 0 or doc[j - 1] == " " else 10**6 for j in range(len(doc) + 1)]
    for i, c in enumerate(window, 1):
        new = [row[0] + 1]
        for j in range(1, len(doc) + 1):
            new.append(min(new[j - 1] + 1, row[j] + 1, row[j - 1] + (doc[j - 1] != c)))
        row = new
    return min(d for j, d in enumerate(row) if j == len(doc) or doc[j] == " ")


def _brute(docs, field, edits):
    cut = leakage.windows(field.split(" "), leakage.SPAN, leakage.LEAST)
    return [min(_distance(field[s:e], d.strip()) for s, e in cut) <= edits for d in docs]


def _found(docs, field, edits):
    return [bool(x) for x in leakage._leaks(docs, leakage.index([(1, field)], leakage.SPAN, leakage.LEAST, edits), edits)]


FIELD8 = "which statement best describes the lost archive room"


def test_two_deletions_at_every_offset_in_a_batch():
    lost = [FIELD8.replace("which", "hic"), FIELD8.replace("statement", "statemt"), FIELD8[2:], FIELD8[:-2]]
    for text in lost:
        docs = [f" {'x' * pad} {text} end " for pad in range(1, 10)]
        assert _brute(docs, FIELD8, 2) == [True] * 9
        assert _found(docs, FIELD8, 2) == [True] * 9
        for before in range(9):  # the same document after others of any length
            assert _found([f" {'y' * (before + 1)} ", docs[0]], FIELD8, 2)[1]


def test_edits_against_brute_force():
    r = random.Random(3)
    fields = [FIELD8, "a test of short words in a list of ten", f"{FIELD8} that the old keepers left in the cold cellar"]
    for field in fields:
        docs = []
        for _ in range(120):
            ws = field.split(" ")
            at = r.randrange(max(1, len(ws) - 12))
            t = list(" ".join(ws[at : at + 13]))
            for _ in range(r.randint(0, 4)):
                i, kind = r.choice([r.randrange(len(t)), r.randrange(3), len(t) - 1 - r.randrange(3)]), r.randrange(3)
                t[i : i + 1] = [[], [r.choice("abe ")], [t[i], r.choice("abe ")]][kind]
            body = " ".join("".join(t).split())
            docs.append(f" {r.choice(['', 'z', 'so ', 'x' * r.randint(1, 5) + ' '])}{body}{r.choice(['', ' then', 's'])} ")
        for edits in (1, 2, 3):
            assert _found(docs, field, edits) == _brute(docs, field, edits)
