"""Per-document text statistics and the class of a text (problem 5).

The statistics are built-in expressions over the normalised text, so they run in the JVM; Python only normalises (NFKC, as the definition of
a word asks), in the same pass. A bounded sample of documents is labelled line by line (what most characters belong to); the labeller's
counts are no statistics and are never seen by the rules. From four fifths of the sample an ordered list of rules over the statistics is
induced by incremental reduced-error pruning: for one class after another, the rarest first, a rule grows condition by condition by
information gain on two thirds of the rows, is pruned on the rest, and is kept while it is right more often than wrong there; what it
covers is taken out. The last fifth tells how good the list is. The thresholds are written as an SQL CASE expression, which Spark applies
to the statistics of every document.

Null and blank texts have zero statistics and the class `prose`; texts of any length are read whole; repeated rows each give their row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from operator import add, or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions.lexicon import COMMON
from quernstone.functions.words import WORD, fold, pieces, texts
from quernstone.llm.residue import LATIN

CLASSES = ("list", "table", "junk")
#: About how many documents are labelled, and the share of them that only tells how good the rules are.
SAMPLE_DOCS, HELD_OUT = 16_000, 0.2
#: Lists of rules that are induced; the best one on the training rows is taken.
STARTS = 8

FREQUENT = frozenset().union(*(COMMON[k] for k in ("en", "de", "fr", "es")))

#: A blank within a line, in Java's patterns.
_B = "[^\\S\\n]"
#: What the characters of a line are counted for: the line holds one of the signs, if any are named, and has the pattern (of Java).
LINES = {
    "entry_share": ("", f"^{_B}*(?:[-*•+→·▪◦‣–—>☐☑✓✔]|\\(?(?:\\d{{1,4}}|[a-zA-Z]|[ivxIVX]{{1,5}})[.)\\]]|\\[[ xX]\\]){_B}"),
    "bar_share": ("|│║┼", "[|│║][^|│║]*[|│║]|┼"),
    "tag_share": ("<", "</?(?:t[drh]|table|thead|tbody)\\b"),
    "tab_share": ("\t", "\\S\\t|\\t\\S"),
    "semicolon_share": (";", "^(?!.*; ).*;.*;"),
    "comma_share": (",", "^(?!.*, ).*,.*,"),
    "gap_share": (("   ",), "\\S {3,}\\S"),
}
#: The shares whose sum, at most 1, is that of all cells; few lines have two of them.
CELLS = ("bar_share", "tag_share", "tab_share", "semicolon_share", "comma_share", "gap_share")
STATISTICS = (
    "n_chars", "n_words", "mean_word_length", "symbol_ratio", "punct_line_share", "common_word_share", "digit_ratio", "n_lines", "words_per_line", "distinct_share", "distinct_line_share",
    "short_line_share", "plain_line_share", *LINES, "cell_share", "stop_ratio", "odd_ratio", "foreign_share", "long_word_share",
)

_ENTRY = re.compile(r"^\s*(?:[-*•+→·▪◦‣–—>☐☑✓✔]|\(?(?:\d{1,4}|[a-zA-Z]|[ivxIVX]{1,5})[.)\]])\s+\S|^\s*\[[ xX]\]\s")
#: What lines that end in punctuation end in, before closing signs and blanks.
STOPS, CLOSERS = (".", "!", "?", "。", ":", ";"), " \t\r\"»”“’')]*_"
_SENTENCE = re.compile(r"(?<=[.!?…])\s+")
_CELL_TAG = re.compile(r"</?(?:t[drh]|table|thead|tbody)\b", re.I)
#: Lines between the rows of a drawn table, and what they are drawn with.
_BORDER = re.compile(r"^\s*(?:[├┌└╔╚╠┼][─━═┼┬┴╪╬├┤┐┘╗╝╣\s]*|\+(?:[-=]+\+)+)\s*$")
_DRAWN = re.compile(r"[─━═\-=+|:│┃║├┤┌┐└┘┬┴┼╔╗╚╝╠╣\s]+")
_GAP = re.compile(r"\S {3,}\S")
_ODD = re.compile("[\\ufffd\\u2500-\\u25ff\\ue000-\\uf8ff]|Ã[\\x80-\\xbf]|â€|Â[\\x80-\\xbf]|ã[\\x80-\\xbf]")
_SIGNS = re.compile(r"[§¶Þþðæœ±Ÿž¤™€¬¦]")
_FLIP = re.compile(r"[a-z][A-Z]|\d[A-Za-z]|[A-Za-z]\d")
_FOREIGN = re.compile(r"[^\W\d_\x00-\u036f]")


def _separator(line: str) -> str | None:
    """What parts the cells of a line, if it can be a row."""
    if "<" in line and _CELL_TAG.search(line):
        return "<"
    if line.count("|") >= 2 or line.count("│") >= 2 or line.count("║") >= 2 or _BORDER.match(line):
        return "|"
    if "\t" in line.strip():
        return "\t"
    if line.count(";") >= 2 and "; " not in line:
        return ";"
    if line.count(",") >= 2 and ", " not in line:
        return ","
    if (_GAP.search(line) or line[:8].isspace()) and all(len(c.split()) <= 4 for c in re.split(r" {3,}", line)):
        return " "
    return None


def _sentence_kind(s: str) -> str:
    """prose or junk."""
    ws = WORD.findall(s.lower())
    n = len(s) - s.count(" ")
    if not ws or not n:
        return "junk"
    letters = sum(map(len, ws))
    digits = sum(len(w) for w in ws if w.isdigit())
    if letters < 0.5 * n or digits > 0.5 * letters or sum(len(w) for w in ws if len(w) > 24) > 0.4 * n:
        return "junk"
    if not s.isascii() and len(_ODD.findall(s)) + len(_SIGNS.findall(s)) > 0.12 * n:
        return "junk"
    common = sum(w in FREQUENT for w in ws)
    if common >= max(1, 0.08 * len(ws)) and len(_FLIP.findall(s)) <= 0.4 * len(ws):
        return "prose"
    if n > 40 and (len(_FLIP.findall(s)) > 0.4 * len(ws) or len(ws) <= 2):
        return "junk"
    if sum(w in LATIN for w in ws) >= 0.4 * len(ws) or not s.isascii() and len(_FOREIGN.findall(s)) > 0.5 * letters:
        return "prose"
    return "prose" if len(ws) <= 12 else "junk"


#: A class and its conditions (place in STATISTICS, operator, threshold).
Rule = tuple[str, list[tuple[int, str, float]]]


def shares(text: str) -> dict[str, float]:
    """Shares of a text's characters in running text, entries, rows and junk, line by line."""
    lines = [x for x in text.splitlines() if x.strip()]
    kinds: list[str | None] = [None] * len(lines)
    seps = [_separator(x) for x in lines]
    i = 0
    while i < len(lines):
        j = i
        while j < len(lines) and seps[j] == seps[i]:
            j += 1
        if seps[i] == "<" or seps[i] == "|" and j - i >= 2 or seps[i] and j - i >= 3:
            cells = _DRAWN.sub("", "".join(lines[i:j]))
            if seps[i] == "<" or cells and sum(map(str.isalnum, cells)) >= 0.5 * len(cells):
                kinds[i:j] = ["table"] * (j - i)
        i = j
    chars = dict.fromkeys(("prose", "list", "table", "junk"), 0)
    running: list[str] = []

    def flush() -> None:
        for s in _SENTENCE.split(" ".join(" ".join(running).split())):
            if s:
                chars[_sentence_kind(s)] += len(s)
        running.clear()

    short: list[str] = []

    def settle() -> None:
        """Four or more short lines in a row, none of which reads on, are entries without marks."""
        if len(short) >= 4:
            flush()
            chars["list"] += sum(map(len, short))
        else:
            running.extend(short)
        short.clear()

    for x, kind in zip(lines, kinds):
        if kind == "table":
            settle(), flush()
            chars["table"] += len(x)
            continue
        ws = WORD.findall(x.lower())
        letters = sum(map(len, ws))
        clean = letters >= 0.45 * len(x.replace(" ", "")) and not sum(len(w) for w in ws if w.isdigit()) > 0.7 * letters and not (len(ws) <= 2 and letters > 40)
        if clean and not x.isascii() and len(_ODD.findall(x)) + len(_SIGNS.findall(x)) > 0.1 * letters:
            clean = False
        common = sum(w in FREQUENT for w in ws)
        if clean and _ENTRY.match(x):
            settle()
            if len(ws) >= 10 and common >= 0.2 * len(ws):
                running.append(x)
            else:
                flush()
                chars["list"] += len(x)
        elif clean and 1 <= len(ws) <= 8 and common <= 0.15 * len(ws) and len(_FLIP.findall(x)) <= 0.34 * len(ws):
            short.append(x)
        else:
            settle()
            running.append(x)
    settle(), flush()
    total = max(1, sum(chars.values()))
    return {k: v / total for k, v in chars.items()}


def _repeats(text: str) -> bool:
    """Whether most of a text is one phrase over and over."""
    ws = WORD.findall(text.lower())
    if len(ws) < 12 or len(set(ws)) >= 0.4 * len(ws):
        return False
    top = Counter(zip(ws, ws[1:], ws[2:])).most_common(1)[0][1]
    return top > 3 and 6 * top > len(ws)


def line_label(text: str | None) -> str:
    """The class of a text by what most of its characters belong to; one phrase over and over is junk. Labels the training sample."""
    if not text or not text.strip():
        return "prose"
    x = shares(text)
    if x["table"] <= 0.5 and _repeats(text):
        return "junk"
    best = max(CLASSES, key=lambda c: x[c])
    return best if x[best] > 0.5 else "prose"


def _best_condition(x: np.ndarray, y: np.ndarray) -> tuple[float, int, str, float] | None:
    """(gain, statistic, operator, threshold) of the condition with the most information gain for the class y."""
    p0, n0 = y.sum(), (~y).sum()
    if not p0 or not n0:
        return None
    base = np.log2(p0 / (p0 + n0))
    best = None
    for j in range(x.shape[1]):
        order = np.argsort(x[:, j], kind="stable")
        v, t = x[order, j], y[order]
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        below = np.cumsum(t)[cut].astype(float)
        size = cut + 1.0
        for op, p, n in (("<=", below, size), (">", p0 - below, len(y) - size)):
            with np.errstate(divide="ignore", invalid="ignore"):
                g = np.where(p > 0, p * (np.log2(np.maximum(p, 1e-9) / n) - base), -1)
            k = int(g.argmax())
            if g[k] > 0 and (best is None or g[k] > best[0] + 1e-9):
                best = (float(g[k]), j, op, float((v[cut[k]] + v[cut[k] + 1]) / 2))
    return best


def _covers(rule: list[tuple[int, str, float]], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, op, t in rule:
        out &= x[:, j] <= t if op == "<=" else x[:, j] > t
    return out


def _grown(x: np.ndarray, y: np.ndarray, start: list, most_conditions: int) -> list[tuple[int, str, float]]:
    """A rule for the class y, condition by condition from `start`, until it covers nothing else or has `most_conditions`."""
    rule = list(start)
    left = _covers(rule, x)
    while len(rule) < most_conditions and (~y[left]).any():
        found = _best_condition(x[left], y[left])
        if not found:
            break
        rule.append(found[1:])
        left &= _covers(rule[-1:], x)
    return rule


def _pruned(rule: list, x: np.ndarray, y: np.ndarray) -> tuple[list, float]:
    """The beginning of a rule that is worth most, (p - n) / (p + n), on the pruning rows, and its worth; the shortest of equal ones."""

    def worth(k: int) -> float:
        hit = _covers(rule[:k], x)
        p, n = (hit & y).sum(), (hit & ~y).sum()
        return (p - n) / max(1, p + n)

    k = max(range(1, len(rule) + 1), key=lambda k: (round(worth(k), 6), -k)) if len(x) else len(rule)
    return rule[:k], worth(k) if len(x) else 1.0


def _parts(rows: np.ndarray, y: np.ndarray, r: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two thirds of the rows to grow on and one to prune on, each with its share of the class."""
    rows = r.permutation(rows)
    own, other = rows[y[rows]], rows[~y[rows]]
    a, b = len(own) - len(own) // 3, len(other) - len(other) // 3
    return np.concatenate([own[:a], other[:b]]), np.concatenate([own[a:], other[b:]])


def _errors(rules: list[Rule], x: np.ndarray, y: np.ndarray) -> int:
    return int((apply_rules(rules, x) != y).sum())


def induce(x: np.ndarray, y: list[str], seed: int = 3, most_conditions: int = 6, least: int = 3, passes: int = 2) -> list[Rule]:
    """The ordered rules (class, conditions) by incremental reduced-error pruning; a text that no rule covers is prose.

    Afterwards each rule, in `passes` passes, is held against one grown anew and one grown further, both pruned, and against none, all within the
    whole list; another one takes its place if the list then makes fewer errors on all rows, by at least `least` if it is longer.
    """
    y = np.array(y, object)
    alive = np.ones(len(y), bool)
    rules: list[Rule] = []
    counts = Counter(y.tolist())
    r = np.random.default_rng(seed)
    for c in sorted((c for c in CLASSES if counts[c]), key=lambda c: (counts[c], c)):
        is_c = y == c
        for _ in range(30):
            rows = np.flatnonzero(alive)
            if is_c[rows].sum() < least:
                break
            grow, prune = _parts(rows, is_c, r)
            rule = _grown(x[grow], is_c[grow], [], most_conditions)
            if not rule:
                break
            rule, worth = _pruned(rule, x[prune], is_c[prune])
            hit = _covers(rule, x) & alive
            if worth <= 0 or (hit & is_c).sum() <= (hit & ~is_c).sum():
                break
            rules.append((c, rule))
            alive &= ~hit
    for _ in range(passes):
        for i, (c, rule) in enumerate(rules):
            if not rule:
                continue
            is_c = y == c
            before = np.zeros(len(y), bool)
            for _, other in rules[:i]:
                before |= bool(other) & _covers(other, x)
            grow, prune = _parts(np.flatnonzero(~before), is_c, r)
            best, own = _errors([x_ for x_ in rules if x_[1]], x, y), rule
            for start in ([], rule):
                new = _grown(x[grow], is_c[grow], start, most_conditions)
                for option in ([_pruned(new, x[prune], is_c[prune])[0], new] if new else []):
                    got = _errors([(d, option if k == i else q) for k, (d, q) in enumerate(rules) if q], x, y)
                    if got < best - (least if len(option) > len(own) else 0):
                        best, own = got, option
            if _errors([x_ for k, x_ in enumerate(rules) if k != i and x_[1]], x, y) <= best:
                own = []
            rules[i] = (c, own)
    return [(c, _tightest(rule)) for c, rule in rules if rule]


def _tightest(rule: list[tuple[int, str, float]]) -> list[tuple[int, str, float]]:
    """A rule without conditions that others on the same statistic imply."""
    bounds: dict[tuple[int, str], float] = {}
    for j, op, t in rule:
        bounds[j, op] = (min if op == "<=" else max)(bounds.get((j, op), t), t)
    return [(j, op, t) for (j, op), t in bounds.items()]


def best_list(x: np.ndarray, y: list[str], starts: int = STARTS) -> list[Rule]:
    """Of the lists that `starts` random partings into growing and pruning rows give, the one with the fewest errors on all rows, then the fewest conditions."""
    of = np.array(y, object)
    lists = [induce(x, y, seed) for seed in range(starts)]
    return min(lists, key=lambda rules: (_errors(rules, x, of), sum(len(rule) for _, rule in rules)))


def case_sql(rules: list[Rule]) -> str:
    """The rules as an SQL CASE expression over the columns of STATISTICS."""
    whens = [f"WHEN {' AND '.join(f'{STATISTICS[j]} {op} {t!r}D' for j, op, t in rule)} THEN '{c}'" for c, rule in rules]
    return f"CASE {' '.join(whens)} ELSE 'prose' END" if whens else "'prose'"


def _normalised(docs: DataFrame, id_col: str, text_col: str, labelled: bool) -> DataFrame:
    """(id_col, _t, n_chars) with the normalised text in its own case, null for a null or blank one, and with `labelled` the line label."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, text_col):
            ts = texts(b.column(1))
            own = pa.array([fold(t) if t and not t.isspace() else None for t in ts], pa.string())
            cols = [b.column(0), own, pa.array([len(t or "") for t in ts], pa.int64())]
            if labelled:
                cols.append(pa.array([line_label(t) for t in ts], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, [id_col, "_t", "n_chars", *["label"] * labelled])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, _t string, n_chars long" + ", label string" * labelled)


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: bool = False) -> DataFrame:
    """(id_col, the statistics, and with `labelled` the line label) of every row.

    Line shares are of the characters of the lines that aren't blank: `short` lines have at most eight pieces, `plain` ones are short and don't start
    as entries, `cell` ones have any sign of CELLS. Word shares are of the words: `distinct`, `common`; `digit_ratio` is of words that start with a digit; `stop`
    counts ends of sentences a word, `odd` characters of broken encodings, `foreign` letters beyond the Latin ones, `long` words of over 20
    letters. A text is ASCII where `odd` and `foreign` aren't looked for.
    """
    keep = [id_col, *["label"] * labelled]
    t, w, lines = F.col("_t"), F.col("_w"), F.col("_l")
    rows = _normalised(docs, id_col, text_col, labelled).withColumn("_t", F.coalesce("_t", F.lit("")))
    rows = rows.select(
        *keep, "n_chars", "_t", (F.octet_length(t) > F.length(t)).alias("_wide"),
        F.filter(F.split(t, "\n"), lambda x: F.length(F.trim(x)) > 0).alias("_l"), F.array_remove(F.split(F.lower(t), r"[^a-z0-9\p{L}\p{N}]+"), "").alias("_w"),
    )
    joined = lambda c: F.length(F.array_join(c, ""))

    def has(name: str) -> Callable[[Column], Column]:
        signs, pattern = LINES[name]
        return lambda x: reduce(or_, (x.contains(c) for c in signs)) & x.rlike(pattern) if signs else x.rlike(pattern)

    def short(x: Column) -> Column:
        return F.size(F.split(F.trim(x), " ")) <= 8

    rows = rows.select(
        *keep, "n_chars", "_t", "_wide", F.array_join(w, "").alias("_j"), F.size(w).alias("_n"), F.size(lines).alias("_k"), joined(lines).alias("_c"),
        F.size(F.filter(w, lambda x: x.isin(*sorted(FREQUENT)))).alias("_common"), F.size(F.array_distinct(w)).alias("_distinct"), F.size(F.array_distinct(lines)).alias("_kinds"),
        joined(F.filter(w, lambda x: F.length(x) > 20)).alias("_long"), joined(F.filter(w, lambda x: x < ":")).alias("_digits"), F.size(F.filter(lines, lambda x: F.substring(F.rtrim(x, F.lit(CLOSERS)), -1, 1).isin(*STOPS))).alias("_stopped"),
        F.filter(lines, short).alias("_s"),
        *(joined(F.filter(lines, has(name))).alias(f"_{name}") for name in LINES),
    )
    j = F.col("_j")
    dense = reduce(lambda c, blank: F.replace(c, F.lit(blank), F.lit("")), " \n\t\r", t)
    wide = lambda c: F.when(F.col("_wide"), c).otherwise(0)
    rows = rows.select(
        "*", F.length(j).alias("_letters"), joined("_s").alias("_short"), joined(F.filter("_s", lambda x: ~has("entry_share")(x))).alias("_plain"), F.length(dense).alias("_dense"), 
        wide(F.length(F.regexp_replace(j, "[\\u0000-\\u036f\\u1e00-\\u1fff]+", ""))).alias("_foreign"), reduce(add, ((F.length(t) - F.length(F.replace(t, F.lit(x), F.lit("")))) / 2 for x in (". ", ".\n", "! ", "? "))).alias("_stops"),
        wide(F.regexp_count(t, F.lit("[\ufffd\ue000-\uf8ff§¶ÞþðœŸž¤€¬¦ÂÃ]"))).alias("_odd"),
    )
    ratio = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    out = {
        "n_chars": F.col("n_chars"), "n_words": F.col("_n"), "mean_word_length": ratio("_letters", "_n"), "symbol_ratio": F.greatest(F.lit(0.0), (F.col("_dense") - F.col("_letters")) / F.greatest("_dense", F.lit(1))),
        "punct_line_share": ratio("_stopped", "_k"), "common_word_share": ratio("_common", "_n"), "digit_ratio": ratio("_digits", "_dense"), "n_lines": F.col("_k"), "words_per_line": ratio("_n", "_k"),
        "distinct_share": ratio("_distinct", "_n"), "distinct_line_share": ratio("_kinds", "_k"), "short_line_share": ratio("_short", "_c"), "plain_line_share": ratio("_plain", "_c"),
        **{name: ratio(f"_{name}", "_c") for name in LINES}, "stop_ratio": ratio("_stops", "_n"), "odd_ratio": ratio("_odd", "_dense"),
        "foreign_share": ratio("_foreign", "_letters"), "long_word_share": ratio("_long", "_letters"),
    }
    out["cell_share"] = F.least(F.lit(1.0), reduce(add, (out[c] for c in CELLS)))
    return rows.select(id_col, *(out[s].cast("double").alias(s) for s in STATISTICS), *["label"] * labelled)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = SAMPLE_DOCS) -> tuple[list[Rule], dict]:
    """(rules, report) from a sample of about `most` documents, those with the smallest hashes of their ids; the report tells the precision and
    recall of each class on the held-out fifth."""
    share = min(1.0, most / max(1, docs.count()))
    few = docs.where(F.pmod(F.xxhash64(F.lit(7), F.col(id_col)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).where(F.length(F.trim(text_col)) > 0)
    rows = describe(few, id_col, text_col, labelled=True).orderBy(id_col, *STATISTICS).limit(2 * most).collect()
    if not rows:
        return [], {}
    x, y = np.array([r[1:-1] for r in rows], float), np.array([r[-1] for r in rows])
    held = np.random.default_rng(9).random(len(rows)) < HELD_OUT
    rules = best_list(x[~held], y[~held].tolist())
    given = apply_rules(rules, x[held])
    report = {}
    for c in CLASSES:
        both = int(((given == c) & (y[held] == c)).sum())
        report[c] = {"precision": both / max(1, int((given == c).sum())), "recall": both / max(1, int((y[held] == c).sum())), "held_out": int((y[held] == c).sum())}
    return rules, report


def apply_rules(rules: list[Rule], x: np.ndarray) -> np.ndarray:
    """The class of each row of statistics; case_sql() does the same in Spark."""
    out = np.full(len(x), "prose", object)
    for c, rule in reversed(rules):
        out[_covers(rule, x)] = c
    return out


def classify(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """describe() with text_class."""
    return describe(docs, id_col, text_col).withColumn("text_class", F.expr(case_sql(rules)))
