"""Web text: HTML to text, language of a text, repair of broken encodings, and n-gram overlap of translations."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions.lexicon import COMMON
from quernstone.functions.words import pieces, texts, words

_ALL_STOPS = frozenset().union(*(COMMON[k] for k in ("en", "de", "fr", "es")))
#: Tags that end a block, and those whose content isn't text (fixed values).
BLOCKS = frozenset("p div br li ul ol h1 h2 h3 h4 h5 h6 table tr td th section article header footer nav aside main blockquote pre form hr dd dt".split())
SILENT = frozenset("script style noscript template head svg".split())
#: A reference by a number of so many digits that Python refuses to read it; leading zeros say nothing, and what is left of eight digits is no character.
_LONG_NUMBER = re.compile(r"&#(?=[0-9]{1000})0*([0-9]{0,8})[0-9]*")


class _Blocks(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, bool]] = []
        self.text, self.linked, self.heading, self.silent, self.link = [], 0, False, 0, 0

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Signs such as "<![0" that begin no marked section are a comment up to the next ">", as browsers read them; the library stops with an error."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.parse_bogus_comment(i)

    def close_block(self) -> None:
        body = " ".join("".join(self.text).split())
        if body:
            self.blocks.append((body, self.linked, self.heading))
        self.text, self.linked, self.heading = [], 0, False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in SILENT:
            self.silent += 1
        if tag in BLOCKS:
            self.close_block()
            self.heading = len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
        self.link += tag == "a"

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        if tag in BLOCKS:
            self.close_block()
        if tag == "a":
            self.link = max(0, self.link - 1)

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.text.append(data)
            if self.link:
                self.linked += len(data.strip())


def main_text(html: str, *, most_links: float = 0.2, short: int = 70, long: int = 200, low: float = 0.3, high: float = 0.32) -> str:
    """The blocks that read as running text: by link density, length and share of frequent words; short ones between good neighbours stay, and headings before them."""
    p = _Blocks()
    p.feed(_LONG_NUMBER.sub(lambda m: f"&#{m[1] or 0}", html))
    p.close()
    p.close_block()
    kinds = []
    for body, linked, _ in p.blocks:
        ws = words(body)
        dense = sum(w in _ALL_STOPS for w in ws) / max(1, len(ws))
        if linked > most_links * len(body):
            kinds.append("bad")
        elif len(body) < short:
            kinds.append("short")
        else:
            kinds.append("good" if dense >= high and len(body) > long else "near" if dense >= low else "bad")
    good = [k == "good" for k in kinds]
    for i, k in enumerate(kinds):
        if k in ("short", "near"):
            before = next((x for x in reversed(kinds[:i]) if x in ("good", "bad")), "bad")
            after = next((x for x in kinds[i + 1 :] if x in ("good", "bad")), "bad")
            good[i] = before == after == "good" or k == "near" and "good" in (before, after) or p.blocks[i][2] and after == "good"
    return "\n".join(b for (b, _, _), g in zip(p.blocks, good) if g)


def identify(text: str) -> tuple[float, str | None]:
    """(score, language) by frequent words; the score is the language's share of all frequent words found."""
    ws = words(text)
    hits = {k: sum(w in v for w in ws) for k, v in COMMON.items()}
    best = max(hits, key=hits.get)
    return (hits[best] / sum(hits.values()), best) if hits[best] else (0.0, None)


#: The character that each byte from 0x80 on becomes when it is read as Windows-1252, or as Latin-1 where that has none.
_BYTE_CHARS = [(bytes([b]).decode("cp1252", "ignore") or chr(b)) for b in range(0x80, 0x100)]
_BYTE_OF = {c: 0x80 + i for i, c in enumerate(_BYTE_CHARS)} | {chr(b): b for b in range(0x80, 0x100)}


def _read_as(low: int, high: int) -> str:
    return "[" + re.escape("".join(dict.fromkeys(c for c, b in _BYTE_OF.items() if low <= b <= high))) + "]"


_NEXT = _read_as(0x80, 0xBF)
#: A character of two to four UTF-8 bytes whose bytes were read one by one.
_BROKEN = re.compile(f"{_read_as(0xC2, 0xDF)}{_NEXT}|{_read_as(0xE0, 0xEF)}{_NEXT}{{2}}|{_read_as(0xF0, 0xF4)}{_NEXT}{{3}}")


def _decoded(m: re.Match) -> str:
    try:
        return bytes(_BYTE_OF[c] for c in m[0]).decode()
    except UnicodeDecodeError:
        return m[0]


def repaired(text: str) -> str:
    """Text in which every character whose UTF-8 bytes were read one by one is put together again; sound characters around them stay."""
    return text if text.isascii() else _BROKEN.sub(_decoded, text)


def _mapped(df: DataFrame, id_col: str, text_col: str, names: list[str], kinds: list[pa.DataType], sql: str, fn) -> DataFrame:
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, text_col):
            out = [fn(t) if t is not None else (None,) * len(names) for t in texts(b.column(1))]
            cols = list(zip(*out)) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], [id_col, *names])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {sql}")


def extract(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id_col, text) of HTML pages."""
    return _mapped(df, id_col, html_col, ["text"], [pa.string()], "text string", lambda t: (main_text(t),))


def languages(df: DataFrame, id_col: str, text_col: str, least: float = 0.3) -> DataFrame:
    """(id_col, language) as "[0.95, 'EN']"; null below the least score."""

    def fn(t: str) -> tuple:
        score, code = identify(t)
        return (f"[{score:.2f}, '{code.upper()}']" if code and score >= least else None,)

    return _mapped(df, id_col, text_col, ["language"], [pa.string()], "language string", fn)


def repair(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id_col, text, changed)."""
    return _mapped(df, id_col, text_col, ["text", "changed"], [pa.string(), pa.bool_()], "text string, changed boolean", lambda t: ((r := repaired(t)), r != t))


def char_f(reference: str, candidate: str, n: int = 6, beta: float = 2.0) -> float:
    """The mean character n-gram F score of a translation, from 0 to 100, white space left out."""
    a, b = "".join(reference.split()), "".join(candidate.split())
    scores = []
    for k in range(1, n + 1):
        x, y = Counter(a[i : i + k] for i in range(len(a) - k + 1)), Counter(b[i : i + k] for i in range(len(b) - k + 1))
        if not x or not y:
            continue
        both = sum((x & y).values())
        p, r = both / sum(y.values()), both / sum(x.values())
        scores.append((1 + beta**2) * p * r / (beta**2 * p + r) if both else 0.0)
    return 100 * sum(scores) / len(scores) if scores else 0.0


def strip_tags(html: Column) -> Column:
    """Text of HTML by patterns alone, inside the JVM: no scripts, styles and tags, white space made single."""
    plain = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " "), r"(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(plain, r"[ \t\r\n]+", " "))
