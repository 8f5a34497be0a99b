"""Evaluation texts in training texts (problem 7), by q-gram lemma filtering over diagonal bands.

A text is written as its words with one blank between them. A window is `span` consecutive words of a test field (all of them if the
field has only `least` to span - 1). If a window of m characters lies in a document with at most k edits, both share at least
m - q + 1 - k q q-grams whose diagonals (place in the document less place in the field) differ by at most k. So a document's
q-grams are looked up in an index of all fields' q-grams, hits are counted in overlapping bands of diagonals, bands below the
bound are left out, and in the rest each window is aligned with the region of the band, in a band of k around its diagonal (with k = 0,
compared), word ends included.

The index of the test items is broadcast, so they are taken in blocks of a bounded number of characters; of more than one block, each is a pass
over the documents whose rows are written before the next. Documents are never shuffled. Null, empty or short fields
and texts give nothing; repeated documents each give their rows; repeated items count once; empty tables give an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.functions.words import pieces, texts, words
from quernstone.session import materialize

SPAN, LEAST, EDITS = 13, 8, 0
#: Lengths of q-grams, powers of two; a field takes the longest with a bound of at least four q-grams, or else the shortest.
GRAMS = (16, 8, 4, 2, 1)
#: Characters of test items whose index (about 25 bytes a character) is broadcast at once.
MOST_INDEX_CHARS = 4_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 22


def windows(ws: list[str], span: int, least: int) -> list[tuple[int, int]]:
    """(start, end) in characters of each window in " ".join(ws)."""
    if len(ws) < least:
        return []
    ends = np.cumsum([len(w) + 1 for w in ws]) - 1
    k = min(span, len(ws))
    return [(int(ends[i] - len(ws[i])), int(ends[i + k - 1])) for i in range(len(ws) - k + 1)]


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q characters from each place on, by doubling; q is a power of two."""
    h, n, b = codes.astype(np.uint64) + np.uint64(1), 1, _BASE
    while n < q:
        h = h[:-n] + h[n:] * b if len(h) > n else h[:0]
        b, n = np.uint64(int(b) ** 2 % 2**64), 2 * n
    return h * _BASE


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def index(items: list[tuple[int, str | None]], span: int, least: int, edits: int) -> dict:
    """Fields (distinct texts of items' fields) with their items and windows, and for each q the q-grams of the fields that use it."""
    owners: dict[str, set[int]] = defaultdict(set)
    for item, text in items:
        if text and item is not None and len(ws := words(text)) >= least:
            owners[" ".join(ws)].add(item)
    fields, by_q = [], defaultdict(list)
    for text, of in sorted(owners.items()):
        cut = windows(text.split(" "), span, least)
        m = min(e - s for s, e in cut)
        q = next((q for q in GRAMS if m - q + 1 - edits * q >= 4), 1)
        by_q[q].append(len(fields))
        fields.append((text, sorted(of), cut, m - q + 1 - edits * q))
    grams = {}
    for q, of in by_q.items():
        h = [_grams(_codes(fields[f][0]), q) for f in of]
        field, place = np.repeat(np.array(of, np.int64), [len(x) for x in h]), np.concatenate([np.arange(len(x)) for x in h])
        h = np.concatenate(h)
        order = np.argsort(h, kind="stable")
        table = np.zeros(1 << _TABLE_BITS, bool)
        table[h >> np.uint64(64 - _TABLE_BITS)] = True
        grams[q] = (h[order], field[order], place[order], table, np.array([x[3] for x in fields]), max(1, min(fields[f][3] for f in of)), max(len(fields[f][0]) for f in of))
    return {"fields": fields, "grams": grams}


def aligned(pattern: str, region: str, k: int, before: str = " ") -> int | None:
    """The least number of edits, if at most k, between the pattern and some part of the region that starts and ends at word ends.

    The region starts k or fewer characters before the band's first diagonal; `before` is the character before it. Of the bands that hold a window's
    q-grams, whose diagonals span at most k, one has the first of them in its lower half of k + 1; the true start is at most k from each, so at most
    3 k into the region, and a path stays within k of its start. Other cells are left out.
    """
    far = k + 1
    row = {j: 0 for j in range(min(len(region), 3 * k + 1)) if (region[j - 1] if j else before) == " "}
    for i, c in enumerate(pattern, 1):
        new: dict[int, int] = {}
        for j in range(max(0, i - far), min(len(region), i + 4 * k) + 1):
            best = row.get(j, far) + 1
            if j:
                best = min(best, new.get(j - 1, far) + 1, row.get(j - 1, far) + (region[j - 1] != c))
            if best <= k:
                new[j] = best
        row = new
        if not row:
            return None
    ends = [d for j, d in row.items() if j == len(region) or region[j] == " "]
    return min(ends, default=None)


def _leaks(docs: list[str], made: dict, edits: int) -> list[set[int]]:
    """For each document, written with a blank on both sides, the items that it gives away."""
    found: list[set[int]] = [set() for _ in docs]
    if not docs:
        return found
    whole = "\n".join(docs)
    codes = _codes(whole)
    starts = np.cumsum([0, *(len(d) + 1 for d in docs[:-1])])
    fields = made["fields"]
    for q, (grams, field, place, table, bounds, least, longest) in made["grams"].items():
        h = _grams(codes, q)
        if not len(h):
            continue
        hit = table[h >> np.uint64(64 - _TABLE_BITS)]
        # a region has `least` hits among as many places as the longest field has, without edits in a row; other hits can't be in one
        total = np.concatenate([[0], np.cumsum(hit)])
        if edits:
            at = np.flatnonzero(hit)
            near = longest + 2 * edits
            at = at[total[np.minimum(at + near, len(h))] - total[np.maximum(at - near, 0)] >= least]
        else:
            full = np.flatnonzero(total[least:] - total[:-least] == least)
            edge = np.zeros(len(h) + 1, np.int32)
            np.add.at(edge, full, 1), np.add.at(edge, full + least, -1)
            at = np.flatnonzero(np.cumsum(edge)[:-1])
        lo, hi = np.searchsorted(grams, h[at], "left"), np.searchsorted(grams, h[at], "right")
        n = hi - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        which = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        f, pos = field[which], np.repeat(at, n)
        diagonal = pos - place[which]
        doc = np.searchsorted(starts, pos, "right") - 1
        width = edits + 1  # bands of two widths, each a width after the last, so k diagonals lie in one
        keys = np.stack([doc, f, diagonal // width], 1)
        if edits:
            keys = np.concatenate([keys, keys - [0, 0, 1]])
        if not len(keys):
            continue
        order = np.lexsort(keys.T[::-1])
        keys, spots = keys[order], np.tile(place[which], 2 if edits else 1)[order]
        first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
        count = np.diff(np.append(first, len(keys)))
        keep = count >= bounds[keys[first, 1]]
        for (d, i, b), k, n in zip(keys[first[keep]].tolist(), first[keep].tolist(), count[keep].tolist()):
            text, of, cut, _ = fields[i]
            if found[d].issuperset(of):
                continue
            spot = np.unique(spots[k : k + n])
            shared = np.searchsorted(spot, [e - q + 1 for _, e in cut]) - np.searchsorted(spot, [s for s, _ in cut])
            enough = [w for w, x in zip(cut, shared.tolist()) if x >= w[1] - w[0] - q + 1 - edits * q]
            if enough and _holds(docs[d], b * width - int(starts[d]), text, enough, edits):
                found[d].update(of)
    return found


def _holds(doc: str, origin: int, text: str, cut: list[tuple[int, int]], edits: int) -> bool:
    """Whether a window of the text lies in the document near the diagonal."""
    for s, e in cut:
        if edits == 0:
            if origin + s >= 1 and doc[origin + s - 1 : origin + e + 1] == f" {text[s:e]} ":
                return True
        else:
            lo = max(1, origin + s - edits)  # without the document's outer blanks
            if aligned(text[s:e], doc[lo : min(len(doc) - 1, lo + e - s + 4 * edits + 1)], edits, doc[lo - 1]) is not None:
                return True
    return False


def leaks(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", field_cols: tuple[str, ...] = ("question", "passage"),
    span: int = SPAN, least: int = LEAST, edits: int = EDITS, most_index_chars: int = MOST_INDEX_CHARS,
) -> DataFrame:
    """(id_col, item_col): a document holds a window of a field of the item, with at most `edits` edits."""
    flat = items.select(item_col, F.explode(F.array(*field_cols)).alias("t")).where("t is not null").distinct()
    chars = flat.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // most_index_chars))
    found = None
    for block in range(blocks):
        # texts go to blocks by hash, so that equal ones share one
        rows = flat.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == block).collect()
        shared = docs.sparkSession.sparkContext.broadcast(index([(r[0], r[1]) for r in rows], span, least, edits))
        one = _found(docs, items, shared, id_col, text_col, item_col, least, edits)
        if blocks > 1:
            one = materialize(one, "leaks")
            shared.unpersist()
        found = one if found is None else found.unionByName(one)
    return found.distinct()


def _found(docs: DataFrame, items: DataFrame, shared: Broadcast, id_col: str, text_col: str, item_col: str, least: int, edits: int) -> DataFrame:
    kinds = [docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in pieces(batches, text_col, 2_000_000):
            rows = [(i, f" {' '.join(ws)} ") for i, t in enumerate(texts(b.column(1))) if t and len(ws := words(t)) >= least]
            found = _leaks([d for _, d in rows], own, edits)
            at = [i for (i, _), f in zip(rows, found) for _ in f]
            item = [x for f in found for x in sorted(f)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(item, pa.int64())], [id_col, item_col])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kinds[0]}, `{item_col}` {kinds[1]}")
