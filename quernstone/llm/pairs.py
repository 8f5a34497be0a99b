"""Broken prompt and response pairs (problem 4).

Several labelling functions vote on each defect of an answer (1 defective, 0 sound, -1 no opinion), each on evidence of its own: length, word
lists, sentence patterns, word and character overlap with the query, word density, letters, the stated language, structure, endings. For each
defect a label model, fitted by expectation maximization on the counts of vote patterns over all answers, learns how often each function votes
how on defective and sound answers, and gives every pattern a posterior. The cutoffs are those that do best on a validation set: all sound answers
and the same answers broken on purpose, in each way, while they are voted on. An answer keeps every defect whose posterior reaches that defect's
cutoff; `worst` reduces them to the most probable one, in ties the first of DEFECTS.

A null or blank answer is `empty`; a null query leaves copy without votes, and the stated language stands for the query's. Very long answers are read whole.
Repeated records give one result each; further columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from difflib import SequenceMatcher
from functools import cache, lru_cache
from itertools import product
from os.path import commonprefix
from struct import Struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.functions.lexicon import COMMON
from quernstone.functions.words import WORD, normalize, pieces, texts
from quernstone.session import materialize

DEFECTS = ("empty", "copy", "refusal", "language", "truncated")
#: The cutoff where the validation set says nothing.
DEFAULT = 0.5

# Words for "no value".
NO_VALUE = frozenset("n/a na none null nil nan undefined empty void unknown tbd nothing keine nichts leer aucun aucune néant vide rien ninguno ninguna nada vacío".split()) | {"no answer", "no response", "not available", "keine antwort", "keine angabe", "sans réponse", "sin respuesta", "pas de réponse"}

_LATIN = [normalize(chr(i)) for i in range(256)]
#: Of each Latin-1 character, what it is among words: a small letter or digit, else a space; those whose normal form is another kind of character.
_LATIN_WORDS = "".join(x if len(x) == 1 and x.isalnum() and x < "\u0100" else " " for x in _LATIN).encode("latin-1")
_NO_LATIN_WORDS = bytes(i for i, x in enumerate(_LATIN) if any(map(str.isalnum, x)) and (len(x) > 1 or x > "\xff"))
_DROPPED = bytes(i for i, x in enumerate(_LATIN) if not x)
#: Latin-1 characters whose normal form isn't their small letter.
_NO_LATIN_LOWER = bytes(i for i, x in enumerate(_LATIN) if x != chr(i).lower())
_ASCII = bytes(range(128))


def _normal(text: str) -> str:
    """What `normalize` gives; most Latin-1 texts need small letters only."""
    if text.isascii():
        return text.lower()
    try:
        of = text.encode("latin-1")
    except UnicodeEncodeError:
        return normalize(text)
    return text.lower() if len(of.translate(None, _NO_LATIN_LOWER)) == len(of) else normalize(text)


def _words(text: str) -> list[str]:
    """What `words` gives; most Latin-1 texts need no pattern."""
    if text.isascii():
        return text.encode().translate(_LATIN_WORDS).decode().split()
    try:
        of = text.encode("latin-1")
    except UnicodeEncodeError:
        return WORD.findall(normalize(text))
    return of.translate(_LATIN_WORDS, _DROPPED).decode("latin-1").split() if len(of.translate(None, _NO_LATIN_WORDS)) == len(of) else WORD.findall(normalize(text))


def _cut(normal: str) -> list[str]:
    """The words of a normalised text."""
    return _words(normal) if normal.isascii() else WORD.findall(normal)


_LANGUAGES_OF = {w: tuple(k for k, v in COMMON.items() if w in v) for w in sorted(frozenset().union(*COMMON.values()))}
#: Letters that few languages have (fixed values).
LETTERS = {"de": "ßäöü", "fr": "çœêèàùâîôû", "es": "ñ¿¡áíóú", "pt": "ãõçáéíóú", "pl": "łążśćęńź", "cs": "řěůšžč", "tr": "ğışç", "sv": "åäö"}
_RARE = frozenset("".join(LETTERS.values()))
#: Names of languages as a query may ask for them (fixed values).
ASKED = {
    "en": r"english|englisch\w*|anglais\w*|ingl[ée]s\w*|inglese|engels|angielsk\w*",
    "de": r"german|deutsch\w*|allemand\w*|alem[áã]n?o?|tedesco|duits|niemieck\w*",
    "fr": r"french|französisch\w*|français\w*|franc[ée]s\w*|francese|frans|francusk\w*",
    "es": r"spanish|spanisch\w*|espagnol\w*|español\w*|espanhol|spagnolo|spaans|hiszpańsk\w*",
    "pt": r"portuguese|portugiesisch\w*|portugais\w*|portugu[ée]s\w*|portoghese|portugees|portugalsk\w*",
    "it": r"italian\w*|italienisch\w*|italien\w*|italiaans|włosk\w*",
    "nl": r"dutch|niederländisch\w*|néerlandais\w*|neerland[ée]s|olandese|nederlands|holandés|niderlandzk\w*",
    "pl": r"polish|polnisch\w*|polonais\w*|polaco|polacco|pools|polsk\w*",
}
_NAMED = re.compile("|".join(ASKED.values()), re.I)
#: One of these is in every word of ASKED, in lower case: a cheap test before it (fixed values); letters that only `re.I` takes for ASCII ones.
NAME_PARTS = tuple("""ngl engels angiel german deutsch allem alem tedesc duits niemi frenc franz franç franc frans spani espa spagn spaan hiszp portug portog itali włosk dutch erland erländ olandes holand polis polni polon polac
    pools polsk""".split())
_ODD_CASE = re.compile("[ſKİı]")
_ASKED = {k: re.compile(rf"\b(?:in|auf|ins|en|em|po|into|to|w|nach|vers|al|al)\s+(?:\w+\s+)?(?:{v})\b|\b(?:{v})\s+(?:please|bitte|por favor|s'il)|\b(?:translate|übersetz|tradui|tradu[cz])\w*\b.*\b(?:{v})\b", re.I) for k, v in ASKED.items()}

# How answers decline, by language; first the letters that one of these begins with, so that it is tried at few places.
DECLINE = re.compile(
    r"""(?=[a-ehikm-prsuvw])(?:(?:can(?:no|')?t|cannot|won't|unable\ to|not\ able\ to|not\ allowed\ to|may\ not|must\ not|not\ something\ i(?:'m|\ am)?|isn't\ possible|not\ possible|don't\ feel\ comfortable|must\ decline|have\ to\ decline|decline\ to|refuse\ to|rather\ not|not\ going\ to|wouldn't|shouldn't)
        [^.!?]{0,60}\b(?:help|assist|answer|respond|discuss|comment|provide|give|guidance|talk\ about|get\ into|support|fulfil|comply|do\ that|information|advice|for\ me|engage|share)\b
      |\b(?:against|outside|beyond)\b[^.!?]{0,30}\b(?:guidelines|policy|policies|rules|what\ i|scope|my\ remit)\b
      |helping\ with\ this\ isn't\ possible|no\ (?:comment|answer|advice)\ can\ be\ given|must\ decline|i\ decline\b|as\ an\ ai\b[^.!?]{0,60}(?:unable|can't|cannot|not|must)
      |(?:kann|darf|möchte|werde)\b[^.!?]{0,60}\b(?:nicht|keine?n?)\b[^.!?]{0,50}\b(?:helfen|beantworten|antworten|äußern|auskunft|antwort|weiterhelfen|angaben|besprechen|geben|unterstützen|sagen)\b
      |(?:dabei|dazu|damit)\b[^.!?]{0,40}\b(?:nicht|keine)\b[^.!?]{0,30}\b(?:helfen|äußern|sagen|auskunft)|\bnicht\ möglich\b[^.!?]{0,40}\b(?:helfen|beantworten|antworten|auskunft)|\bmuss\b[^.!?]{0,30}\bablehnen\b|\bals\ ki\b[^.!?]{0,80}\b(?:nicht|keine)|(?:verstößt|außerhalb)\b[^.!?]{0,40}\b(?:richtlinien|regeln)
      |\bne\ (?:peux|puis|suis|pourrai|souhaite|veux)\b[^.!?]{0,40}\b(?:pas)\b[^.!?]{0,40}\b(?:aider|répondre|traiter|fournir|commenter|donner|discuter|parler|assister|sujet)\b|préfère\ ne\ pas|(?:m'est\ impossible|n'est\ pas\ possible)[^.!?]{0,40}\b(?:aider|répondre|commenter)|dois\ refuser|dois\ décliner|en\ tant\ que\ (?:modèle|ia)\b|(?:contraire|contre)\ (?:à\ )?mes\ (?:règles|consignes|directives)
      |\bno\ (?:puedo|podré|debo|quiero|estoy)\b[^.!?]{0,40}\b(?:ayudar|ayudarle|responder|contestar|tratar|comentar|dar|hablar|proporcionar|asistir|información)\w*\b|\bno\ (?:me\ )?(?:es|resulta)\ posible\b[^.!?]{0,40}\b(?:ayudar|responder|contestar|atender|comentar|hablar)\w*|imposible\ (?:ayudar|responder|contestar)|prefiero\ no|debo\ (?:negarme|rechazar|declinar)|como\ (?:modelo|ia)\b[^.!?]{0,60}|va\ (?:en\ )?contra\ (?:de\ )?mis)""",
    re.X,
)
#: Words, and parts of sentences for forms that may stand inside of words, one of which DECLINE needs whatever it finds: cheap tests before it (fixed values).
_DECLINING_WORDS = frozenset(
    """help assist answer respond discuss comment provide give guidance support fulfil comply information advice engage share guidelines policy policies rules scope ai
    helfen beantworten antworten äußern auskunft antwort weiterhelfen angaben besprechen geben unterstützen sagen möglich ablehnen ki
    aider répondre traiter fournir commenter donner discuter parler assister sujet tant mes puedo podré quiero estoy posible modelo ia contra""".split()
)
_DECLINING_PARTS = (
    "talk about", "get into", "do that", "for me", "what i", "my remit", "helping with this isn", "decline", "helfen", "äußern", "sagen", "auskunft", "richtlinien", "regeln", "préfère ne pas", "impossible", "pas possible", "dois refuser", "dois décliner",
    "debo", "imposible", "prefiero no",
)
#: Limits that full answers state (fixed values): what the company can't do, with what to do instead.
LIMIT = re.compile(r"\b(?:but|aber|mais|pero)\b")
_LIMITS = frozenset(("but", "aber", "mais", "pero"))
_SORRY_BUT = re.compile(r"^[^,;]{0,30}(?:sorry|leid|désolée?|siento|apologies)[^,;]{0,20}[,;]?\s*(?:but|aber|mais|pero)")
#: Words, one of which every sentence that declines has: a cheap test before the patterns (fixed values).
_NEGATIVE_WORDS = frozenset(
    """t not no cannot unable decline declined declines refuse refused against outside beyond nicht kein keine keinen ablehnen verstößt außerhalb pas décliner refuser tant contre contraire impossible
    imposible contra negarme rechazar declinar prefiero préfère modelo ia""".split()
)
# What surrounds a refusal without being an answer.
POLITE = re.compile(
    r"""^(?:hello|hi|hallo|bonjour|hola|guten\ tag|good\ question|thank|thanks|danke|merci|gracias|have\ a\ (?:nice|good)|i\ hope\ you\ understand|i\ understand|sorry|my\ apologies|i\ apologi[sz]e|unfortunately|leider|es\ tut\ mir\ leid|désolé|je\ suis\ désolé|lo\ siento|is\ there\ anything\ else|please\ (?:ask|contact|consult|reach)|ask\ (?:me\ )?(?:something|about)|let\ me\ know|feel\ free|bitte\ (?:stellen|wenden|fragen)|ich\ (?:bitte|hoffe|verstehe)|veuillez\ (?:vous|poser|contacter)|posez|adressez|consultez|je\ (?:comprends|vous\ remercie|espère)|haga\ otra|consulte|pregunte|entiendo|espero|póngase|diríjase|this\ falls|that\ request|schönen|bonne\ journée|que\ tenga|buenos|gern|vielen\ dank|merci|perhaps|maybe|vielleicht)""",
    re.I | re.X,
)

# Words that refusals are full of.
REFUSING = frozenset(
    """sorry apologies apologize apologise unfortunately cannot unable able allowed help assist assistance respond discuss comment provide advice guidance guidelines policy policies rules decline
    declines refuse topic request professional outside scope ai model comfortable rather qualified appropriate answer
    leider leid entschuldigung darf möchte helfen beantworten antworten äußern auskunft richtlinien ablehnen thema fachkraft ki modell andere
    désolé désolée malheureusement peux puis aider répondre traiter fournir commenter préfère refuser décliner sujet professionnel modèle ia règles consignes posez autre
    siento lamento desgraciadamente puedo debo ayudar ayudarle responder contestar tratar comentar prefiero negarme rechazar tema profesional modelo política normas haga otra consulte""".split()
)
_DIGIT = re.compile(r"\d")
_NOT_ASCII = re.compile(r"[^\x00-\x7f]")
#: The first two letters of what POLITE matches, and of these the third ones; "hi" ends there, and `re.I` takes ı for i: cheap tests before it.
_POLITE = [x[:3] for x in re.sub(r"\(\?:|\)\?|\\", "", POLITE.pattern[4:]).split("|")]
_POLITE_HEADS = frozenset(_POLITE) | {f"{x[:2]}ı" for x in _POLITE if x[2:] == "i"}

#: Letters beyond the Latin ones.
_FOREIGN = re.compile(r"[^\W\d\x00-\u036f\u1e00-\u1fff]")
_THINK = re.compile(r"<think>.*?(?:</think>|$)", re.S | re.I)
_CONTROL = re.compile(r"<\|[^|>]{0,40}\|>")
_ASIDE = re.compile(r"```.*?(?:```|$)|https?://\S+|[\"«„“].{0,400}?[\"»“”]", re.S)
_CLOSING_FENCE = re.compile(r"(?:^|\n)\s*(?:```|~~~)\s*$")
_ADDRESS_END = re.compile(r"\s*https?://\S+$")
_HANGING = re.compile(r"[„«]\S*$")
_MARK = re.compile(r"<\|[^|>]{0,40}\|>|</?[a-zA-Z][^<>]{0,80}>|[`*_#~>|]+")
_FENCE = re.compile(r"^\s*(?:```|~~~)", re.M)
_ASKED_PREFIX = re.compile(r"^\W*(?:you asked|your question(?: was| is)?|you wrote|question|sie fragten|ihre frage(?: war| lautet)?|frage|vous (?:avez demandé|demandez|demandiez)|votre question|usted (?:pregunta|preguntó)|su pregunta|pregunta)\s*:?\s*", re.I)
#: A stop, what closes, and space; or line ends. One set comes first, so that the pattern is tried only there.
_SENTENCE = re.compile(r"[.!?…\n](?:(?<=\n)\n*|(?<!\n)[\"»”“’')\]*_]*\s+)")
_SIGNATURE = re.compile(r"^\W*(?:[–—-]+\s*\S.{0,60}|.{0,60}\b(?:support|team|service|desk|kundendienst|équipe|equipo)\b.{0,40}|https?://\S+|www\.\S+)$", re.I)
_ENTRY = re.compile(r"^\s*(?:[-*•+→]|\d{1,3}[.)])\s+\S")
_PAIR = re.compile(r"^\s*[-*•+→]?\s*[^:]{1,60}:\s*\S+\s*$")
_BARE = re.compile(r"^\s*(?:[-*•+→]|\d{1,3}[.)]|\*\*|__|#+|\|)\s*$")
_STOPS, _CLOSERS = frozenset(".!?…。！？؟:;"), "\"»”“’')]*_"
#: Endings of one language's unfinished sentences need no list: a word of COMMON seldom ends a sentence.
_OPENERS = {"(": ")", "[": "]", "{": "}", "«": "»", "„": "“"}


#: A word's points for each language, in tenths, and whether it is one of some lists, each as 32 bits of one number: the sum over words (17 points at most,
#: of 250,000,000 words) adds up all of them at once.
_PLACES = {k: 1 << 32 * i for i, k in enumerate(COMMON)}
_NAMES = tuple(COMMON)
_LISTS = (REFUSING, _NEGATIVE_WORDS, _DECLINING_WORDS)
_BITS = Struct(f"<{len(COMMON) + len(_LISTS)}I")
_COMMON_POINTS = {w: sum(10 * _PLACES[k] for k in _LANGUAGES_OF.get(w, ())) + sum((w in x) << 32 * i for i, x in enumerate(_LISTS, len(COMMON))) for w in frozenset(_LANGUAGES_OF).union(*_LISTS)}


class _Points(dict):
    """The points of a word with its letters; kept for words that come again."""

    def __missing__(self, word: str) -> int:
        out = _COMMON_POINTS.get(word, 0)
        if not word.isascii():
            out += sum(7 * _PLACES[k] for k, letters in LETTERS.items() if any(c in letters for c in word))
        if len(self) > 100_000:
            self.clear()
        self[word] = out
        return out


_POINTS = _Points()


def _marked(text: str) -> bool:
    """Whether a text has a sign that markup may begin with."""
    return "*" in text or "_" in text or "`" in text or "#" in text or "|" in text or "<" in text or ">" in text or "~" in text


def _is_latin(text: str) -> bool:
    """Whether a text surely has no letters beyond the Latin ones."""
    if text.isascii():
        return True
    for of in ("latin-1", "cp1252"):
        try:
            text.encode(of)
        except UnicodeEncodeError:
            continue
        return True
    return False


def _sum(text: str, ws: list[str]) -> int:
    """The points of a text's words."""
    return sum(filter(None, map(_COMMON_POINTS.get if text.isascii() else _POINTS.__getitem__, ws)))


def language(text: str, ws: list[str] | None = None, points: int | None = None) -> tuple[str | None, float, tuple[int, ...]]:
    """The most likely language by frequent words and letters, its lead over the next as a share of the words, and all scores in tenths; None without
    evidence. The points of the words may be given."""
    ws = _words(text) if ws is None else ws
    if not ws:
        return None, 0.0, ()
    if not _is_latin(text):
        foreign = _FOREIGN.findall(text)
        if len(foreign) > 0.4 * sum(map(len, ws)):
            return f"U+{Counter(ord(c) >> 8 for c in foreign).most_common(1)[0][0]:02X}", 1.0, ()
    if points is None:
        points = _sum(text, ws)
    if "¿" in text or "¡" in text:
        points += 10 * _PLACES["es"]
    score = _BITS.unpack(points.to_bytes(_BITS.size, "little"))[: len(COMMON)]
    second, first = sorted(score)[-2:]
    return _NAMES[score.index(first)] if first else None, (first - second) / (10 * len(ws)), score


class _Once:
    """A value that is computed when it is first asked for; what `cached_property` does, in fewer steps."""

    def __init__(self, of: Callable) -> None:
        self.of, self.name = of, of.__name__

    def __get__(self, x: object, kind: type | None = None) -> object:
        out = x.__dict__[self.name] = self.of(x)
        return out


class Query:
    """A query with what the labelling functions share of it, each computed once, some when it is first asked for."""

    def __init__(self, text: str | None) -> None:
        self.text = text
        self.words = _words(text or "")
        self.set = frozenset(self.words)
        #: The words that aren't frequent ones.
        self.topic = self.set.difference(_LANGUAGES_OF)

    @_Once
    def asked(self) -> str | None:
        """The query's language."""
        return language(self.text, self.words)[0] if self.text else None

    @_Once
    def named(self) -> frozenset[str]:
        """The languages that the query asks for."""
        text = self.text or ""
        low = text.lower()
        if (any(map(low.__contains__, NAME_PARTS)) or not text.isascii() and _ODD_CASE.search(text)) and _NAMED.search(text):
            return frozenset(k for k, x in _ASKED.items() if x.search(text))
        return frozenset()


    @_Once
    def plain(self) -> bool:
        """Whether the words of the query, as an answer, are just these, also in quotes: it has no markup, no introduction, and each sentence once."""
        text = self.text or ""
        if _marked(text) or _ASKED_PREFIX.match(text):
            return False
        ss = _SENTENCE.split(_normal(text))
        return len(ss) == 1 or '"' not in text and len(set(ss)) == len(ss)


class Answer:
    """An answer with what the labelling functions share of it, each computed once, some when it is first asked for."""

    def __init__(self, text: str | None) -> None:
        self.text = text
        #: The answer without thoughts and control marks.
        self.spoken = text or ""
        if "<" in self.spoken:
            self.spoken = _CONTROL.sub(" ", _THINK.sub(" ", self.spoken))

    @_Once
    def core(self) -> str:
        """The answer without markup."""
        return _MARK.sub(" ", self.spoken) if _marked(self.spoken) else self.spoken

    @_Once
    def normal(self) -> str:
        """The answer without markup, normalised and in lower case."""
        return _normal(self.core)

    @_Once
    def sentences(self) -> list[str]:
        """The sentences of the answer without markup, normalised and in lower case, and what has no words between them."""
        return _SENTENCE.split(self.normal)

    @_Once
    def words(self) -> list[str]:
        return _words(self.core)

    @_Once
    def points(self) -> int:
        return _sum(self.core, self.words)

    @_Once
    def rest(self) -> list[str]:
        """The answer's words without an introduction such as "you asked", each sentence once."""
        asked = _ASKED_PREFIX.match(self.core)
        ss = _SENTENCE.split(normalize(self.core[asked.end() :])) if asked else self.sentences
        once = dict.fromkeys(ss)
        return self.words if not asked and len(once) == len(ss) else [w for s in once for w in _cut(s)]

    @_Once
    def prose(self) -> str:
        """The answer without code, addresses and quotations."""
        x = self.spoken
        return _ASIDE.sub(" ", x) if '"' in x or "«" in x or "„" in x or "“" in x or "://" in x or "```" in x else self.core

    @_Once
    def letters(self) -> frozenset[str]:
        """The letters of the prose that aren't ASCII."""
        text = self.prose
        if text.isascii():
            return frozenset()
        try:
            beyond = text.encode("latin-1").translate(None, _ASCII).decode("latin-1")
        except UnicodeEncodeError:
            beyond = _NOT_ASCII.findall(text)
        return frozenset(c.lower() for c in set(beyond) if c.isalpha())

    @_Once
    def bare(self) -> tuple[int, bool, bool]:
        """The answer's length, 99 if it has many words; whether it is a word for "no value"; whether it is a few words, none of them common but for such a word."""
        ws = self.words
        if len(ws) >= 10:
            return 99, False, False
        n = len(self.core.strip())
        plain = re.sub(r"^\W+|\W+$", "", normalize(self.core)) if 0 < len(ws) <= 3 else ""
        value = plain in NO_VALUE or re.sub(r"\W+", "", plain) in NO_VALUE if plain else False
        return n, value, len(ws) <= 3 and (value or not any(w in _LANGUAGES_OF for w in ws))

    @_Once
    def told(self) -> tuple[str | None, float, tuple[int, ...]]:
        """The answer's language, as `language` gives it; none of fewer than four words."""
        text = self.prose
        if text is self.core:
            return language(text, self.words, self.points) if len(self.words) >= 4 else (None, 0.0, ())
        ws = _words(text)
        return language(text, ws) if len(ws) >= 4 else (None, 0.0, ())

    @_Once
    def declining(self) -> tuple[bool, int, float]:
        """Whether a sentence declines, the words without such and polite sentences, the share of words that refusals are full of."""
        ws = self.words
        content, declined = len(ws), False
        refusing, negative, declining = _BITS.unpack(self.points.to_bytes(_BITS.size, "little"))[len(COMMON) :]
        may = negative and (declining or _declining_part(self.normal))
        for s in self.sentences:
            if may and _declines(s, of := _cut(s)):
                declined = True
                content -= len(of)
            elif ((head := s.lstrip()[:3]) in _POLITE_HEADS or head[:2] == "hi") and _polite(s):
                content -= len(_cut(s))
        return declined, content, refusing / max(1, len(ws))


@lru_cache(1_024)
def _stated(lang: str | None) -> str | None:
    """The language of a stated one, if its frequent words are known."""
    of = (lang or "").strip().lower()[:2]
    return of if of in COMMON else None


@lru_cache(1_024)
def _query(text: str | None) -> Query:
    """Short queries are kept: they often come again, those of preference records at once."""
    return Query(text)


class Pair:
    """A query and its answer, with the language that is stated for them."""

    def __init__(self, query: str | Query | None, answer: str | Answer | None, lang: str | None = None) -> None:
        self.q = query if type(query) is Query else _query(query) if query is None or len(query) <= 1_000 else Query(query)
        self.a = answer if type(answer) is Answer else Answer(answer)
        self.lang = lang

    @property
    def query(self) -> str | None:
        return self.q.text

    @property
    def answer(self) -> str | None:
        return self.a.text


def empty_votes(p: Pair) -> tuple[int, ...]:
    """By words (there are none), word lists (a word for "no value"), length, and overlap (a few words, none of them common or of the query)."""
    ws = p.a.words
    n, value, few = p.a.bare
    lone = few and p.q.topic.isdisjoint(ws)
    return (0 if ws else 1, -1 if not ws else int(value), 1 if n <= 12 else 0 if n > 40 else -1, int(lone))


def _alike(q: list[str], a: list[str], distinct: bool) -> float:
    """The share of words in matching runs. Where q has each word once and a is q without a run of words, these are all of a's."""
    left = len(q) - len(a)
    if distinct and left > 0:
        k = next((i for i, w in enumerate(a) if w != q[i]), len(a))
        if a[k:] == q[k + left :]:
            return 2 * len(a) / (len(q) + len(a))
    return SequenceMatcher(None, q, a, autojunk=False).ratio()


def copy_votes(p: Pair) -> tuple[int, ...]:
    """By order (matching runs of words), words (share of the answer's that the query has), characters (common beginning and end), and new words."""
    q, a = p.q.words, p.a.rest
    if not q or not a:
        return (-1, -1, -1, -1)
    if q == a:
        return (1, 1, 1, 1)
    n, m = len(q), len(a)
    both = sum(map(p.q.set.__contains__, a))
    new = m - both
    # no more can match than the shorter one has, and than there are words in common
    most = 2 * min(n, both) / (n + m)
    alike = _alike(q, a, len(p.q.set) == n) if most >= 0.55 else 0.0
    covered = 1 - new / m
    edges = 0.0  # of texts whose lengths are far apart, or that begin and end in other letters
    if m <= 4 * n and n <= 4 * m and (q[0][0] == a[0][0] or q[-1][-1] == a[-1][-1]):
        x, y = "".join(q), "".join(a)
        head = len(x) if x == y else len(commonprefix([x, y])) if x[0] == y[0] else 0
        edges = (head + (len(commonprefix([x[head:][::-1], y[head:][::-1]])) if x[-1] == y[-1] else 0)) / max(len(x), len(y))
    return (1 if alike >= 0.75 else 0 if alike < 0.55 else -1, 1 if covered >= 0.8 else 0 if covered < 0.6 else -1, 1 if edges >= 0.8 else 0 if edges < 0.4 else -1, 1 if new <= 2 and m >= 0.5 * n else 0 if new > 5 else -1)


def _declining_part(text: str) -> bool:
    return any(map(text.__contains__, _DECLINING_PARTS))


def _declines(sentence: str, ws: list[str]) -> bool:
    """Whether a sentence, in lower case, declines, without naming another way after a "but"."""
    if _NEGATIVE_WORDS.isdisjoint(ws) or _DECLINING_WORDS.isdisjoint(ws) and not _declining_part(sentence):
        return False
    sentence = sentence.replace("’", "'")
    if not _LIMITS.isdisjoint(ws) and LIMIT.search(sentence) and LIMIT.search(_SORRY_BUT.sub("", sentence)):
        return False
    return bool(DECLINE.search(sentence))


def _polite(sentence: str) -> bool:
    """Whether a sentence, in lower case, goes with a refusal and is no answer."""
    sentence = sentence.lstrip()
    return POLITE.match(sentence.replace("’", "'")) is not None and not LIMIT.search(sentence)


def refusal_votes(p: Pair) -> tuple[int, ...]:
    """By patterns (a sentence declines), content (what is left without such and polite sentences), density of the words of refusals, and topic (a short
    answer without numbers and without the query's own words)."""
    n = len(p.a.words)
    if not n:
        return (-1, -1, -1, -1)
    declined, content, density = p.a.declining
    topic = 0 if n > 60 else 1 if p.q.topic.isdisjoint(p.a.words) and not _DIGIT.search(p.a.core) else 0 if n > 12 else -1
    return (int(declined), 1 if content <= 0.4 * n else 0 if content > 0.6 * n else -1, 1 if density >= 0.2 else 0 if density < 0.12 else -1, topic)


def language_votes(p: Pair) -> tuple[int, ...]:
    """By frequent words against the query's, against the stated language, by what is missing of the query's, and by letters."""
    return _told_votes(p.q, p.a, p.lang)


def _told_votes(q: Query, a: Answer, lang: str | None) -> tuple[int, ...]:
    got, lead, score = a.told
    if got is None:
        return (-1, -1, -1, -1)
    want = q.asked
    stated = _stated(lang)
    if want is None:
        want = stated
    if want == got:
        return (0, -1 if stated is None else 0 if stated == got else 1, 0, _letters_vote(a.letters, want))
    if got in q.named:
        return (0, 0, 0, -1)
    far = lead > 0.04
    first = -1 if want is None or not far else 1
    second = -1 if stated is None else 1 if got != stated and far else 0
    # the query's own frequent words are missing from the answer
    third = -1 if want is None or not score else 1 if far and score[_NAMES.index(got)] >= 2 * (score[_NAMES.index(want)] if want in COMMON else 0) + 10 else 0
    return (first, second, third, _letters_vote(a.letters, want))


def _letters_vote(seen: frozenset[str], want: str | None) -> int:
    """By letters that few languages have: whether the text has some, and the wanted language doesn't use any of them."""
    if want is None or not seen:
        return -1
    return 0 if not seen.isdisjoint(LETTERS.get(want, "")) else 1 if want == "en" or not _RARE.isdisjoint(seen) else -1


def _is_signature(line: str) -> bool:
    # what begins with a letter or digit and is longer than the pattern allows needs no look at it
    return not (len(line) > 110 and " " in line and line[0].isalnum()) and _SIGNATURE.match(line) is not None


def _stops(line: str) -> bool:
    """Whether a stripped line ends in a stop, perhaps with closing quotes, brackets or marks after it."""
    return line.rstrip(_CLOSERS).rstrip()[-1:] in _STOPS


def truncated_votes(p: Pair) -> tuple[int, ...]:
    """By structure (open code, a bare mark), the last line's end, its last word, and open brackets and quotes."""
    return _end_votes(p.a)


def _end_votes(a: Answer) -> tuple[int, ...]:
    text = a.spoken.strip().strip("\u200b\ufeff\u2060").rstrip()
    if not a.words:
        return (-1, -1, -1, -1)
    fenced = "```" in text or "~~~" in text
    # what ends in a word and a stop outside of code is sound for every one of the functions below
    if not fenced and text[-1] in ".!?" and text[-2:-1].isalpha():
        return (0, 0, 0, 0)
    open_fence = fenced and len(_FENCE.findall(text)) % 2 == 1
    if fenced and not open_fence and _CLOSING_FENCE.search(text):
        return (0, 0, 0, 0)
    lines = [x for x in text.split("\n") if x.strip()] if "\n" in text else [text]
    last = lines[-1].strip()
    # what may follow a finished answer: a signature, an address, signs
    while len(lines) > 1 and not open_fence and (_is_signature(last) and not _ENTRY.match(last) and not _stops(last) or not _words(last) and not _BARE.match(last)):
        lines.pop()
        last = lines[-1].strip()
    if "://" in last:
        last = _ADDRESS_END.sub("", last).rstrip() or last
    ends_well = _stops(last) and not last.endswith((":", ";")) or ord(last[-1]) > 0x2190 and not _words(last[-1])
    entry = _ENTRY.match(last) is not None
    tail = _words(last) if entry or ":" in last else _words(last.rsplit(None, 1)[-1]) or _words(last)  # else the last word only counts
    pair = ":" in last and len(tail) <= 6 and _PAIR.match(last) is not None
    one = 1 if open_fence or _BARE.match(last) or last.endswith("**") and last.count("**") % 2 == 1 else 0
    if one and not open_fence:
        two, ends_well = 1, False
    elif ends_well:
        two = 0
    elif entry and not last.endswith((",", "(", ":")):
        earlier = [x for x in lines[:-1] if _ENTRY.match(x)]
        two = 0 if pair or len(tail) <= (8 if earlier else 3) and not any(_stops(x.strip()) for x in earlier) else 1
    else:
        two = 1
    if ends_well and not open_fence:
        return (one, two, 0, 0)
    three = 0 if ends_well else 1 if tail and tail[-1] in _LANGUAGES_OF or not pair and (last[-1] in ",([{:;–—-" or ("„" in last or "«" in last) and _HANGING.search(last)) else -1
    unbalanced = '"' in last and last.count('"') % 2 == 1 or any(o in last and last.count(o) > last.count(c) for o, c in _OPENERS.items())
    return (one, two, three, 1 if unbalanced else 0 if ends_well else -1)


VOTES: dict[str, Callable[[Pair], tuple[int, ...]]] = {"empty": empty_votes, "copy": copy_votes, "refusal": refusal_votes, "language": language_votes, "truncated": truncated_votes}
FUNCTIONS = dict.fromkeys(DEFECTS, 4)


def pattern(votes: Iterable[int]) -> int:
    """Votes as digits to the base of 3."""
    out = 0
    for v in votes:
        out = out * 3 + v + 1
    return out


def unpattern(code: int, n: int) -> list[int]:
    return [(code // 3 ** (n - 1 - i)) % 3 - 1 for i in range(n)]


#: The patterns of a defect's votes; votes by which as many functions find it as don't, or more.
_CODES = {v: pattern(v) for v in product((-1, 0, 1), repeat=4)}
_FINDING = frozenset(code for v, code in _CODES.items() if 1 in v and v.count(1) >= v.count(0))
_ALL_FIND = _CODES[1, 1, 1, 1]


def fit(counts: dict[int, int], n: int, rounds: int = 200, prior: float = 0.05) -> dict[int, float]:
    """Posterior of the defect for every vote pattern of n functions, by expectation maximization over the counts of those that occur.

    Starts from the patterns' majorities; functions are taken as independent given the truth; counts are smoothed, functions being better
    than chance to begin with, so that a defect that no answer has stays without posteriors near one. Without counts there are none.
    """
    if not counts:
        return {}
    codes = sorted(counts)
    votes = np.array([unpattern(c, n) for c in codes])
    weight = np.array([counts[c] for c in codes], float)
    post = np.clip((votes == 1).sum(1) / np.maximum(1, (votes >= 0).sum(1)), 0.01, 0.99)
    # pseudo-counts of outcomes -1, 0, 1 given sound and given defective
    base = np.array([[1.0, 18.0, 1.0], [1.0, 3.0, 16.0]])

    def posterior(of: np.ndarray) -> np.ndarray:
        logit = np.full(len(of), np.log(pi) - np.log1p(-pi))
        for j in range(n):
            logit += np.log(table[1, of[:, j] + 1, j]) - np.log(table[0, of[:, j] + 1, j])
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))

    for _ in range(rounds):
        w = np.stack([weight * (1 - post), weight * post])
        pi = (w[1].sum() + 20 * prior) / (w.sum() + 20)
        table = np.stack([[(w[y][:, None] * (votes == o)).sum(0) + base[y][o + 1] for o in (-1, 0, 1)] for y in (0, 1)])
        table = table / table.sum(1, keepdims=True)
        new = posterior(votes)
        settled = np.abs(new - post).max() < 1e-6
        post = new
        if settled:
            break
    every = np.array([unpattern(c, n) for c in range(3**n)])
    # no positive vote is no defect, whatever the fit
    return dict(enumerate(np.where((every == 1).any(1), posterior(every), 0.0).tolist()))


def vote(pairs: DataFrame, id_col: str = "record_id") -> DataFrame:
    """(id_col, resp_field, a pattern for each defect, sound, a pattern for each defect of the answer broken that way) of rows (id_col, resp_field, query,
    answer, lang). Only what is sound is broken; what can't be broken in a way has null there."""
    kind = pairs.schema[id_col].dataType.simpleString()
    cuts = [f"{d}_broken" for d in DEFECTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "answer"):
            # rows of numbers, since kept dicts would be looked at by Python's garbage collection again and again
            out = [(*own.values(), good, *map(cut.get, DEFECTS)) for own, good, cut in (judged(Pair(*x)) for x in zip(texts(b.column(2)), texts(b.column(3)), texts(b.column(4))))]
            cols = [pa.array(x, pa.bool_() if i == len(DEFECTS) else pa.int32()) for i, x in enumerate(zip(*out))]
            if out:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], [id_col, "resp_field", *DEFECTS, "sound", *cuts])

    kinds = [f"`{id_col}` {kind}", "resp_field string", *(f"`{d}` int" for d in DEFECTS), "sound boolean", *(f"`{c}` int" for c in cuts)]
    return pairs.select(id_col, "resp_field", "query", "answer", "lang").mapInArrow(run, ", ".join(kinds))


#: Sentences that decline (fixed values), from which the validation set's refusals are made.
DECLINING = (
    "I'm sorry, but I can't help with that.", "I must decline to answer. Please ask about something else.", "As an AI model, I'm not able to give advice on this.", "This falls outside what I may comment on.",
    "Dazu möchte ich mich nicht äußern. Bitte stellen Sie eine andere Frage.", "Es tut mir leid, aber dabei kann ich nicht helfen.", "Als KI-Modell darf ich dazu keine Auskunft geben.",
    "Je suis désolé, mais je ne peux pas vous aider.", "Je préfère ne pas traiter ce sujet. Posez une autre question.", "Lo siento, pero no puedo ayudar con eso.", "Prefiero no tratar este tema. Haga otra pregunta.",
)


#: A query in each of some languages (fixed values), from which the validation set's answers in another language are made.
ASKING = {
    "en": "How do I change the entry on the page, and who will be told about it when it is done?", "de": "Wie kann ich den Eintrag auf der Seite ändern, und wer wird davon erfahren, wenn es so weit ist?",
    "fr": "Comment puis-je changer cette ligne sur la page, et qui sera averti de cela quand ce sera fait ?", "es": "¿Cómo puedo cambiar la entrada de la página, y quién lo sabrá cuando todo esté hecho para mí?",
}


@cache
def _fixed() -> tuple[list[tuple[Answer, tuple[int, int]]], dict[str, list[tuple[Answer, tuple[int, int]]]], dict[str | None, list[tuple[str, Query]]]]:
    """Blank answers, answers that decline by language, each with its pattern for queries whose topic has some of its words and none; by language the queries in others."""

    def known(text: str, defect: str) -> tuple[Answer, tuple[int, int]]:
        return (x := Answer(text)), tuple(_CODES[VOTES[defect](Pair(Query(q), x))] for q in (text, None))

    declining: dict[str, list] = {}
    for x in DECLINING:
        declining.setdefault(language(x)[0], []).append(known(x, "refusal"))
    asking = {k: Query(q) for k, q in ASKING.items()}
    return [known(x, "empty") for x in ("", " \n", "-", "[]", "...", *sorted(NO_VALUE))], declining, {k: [x for x in asking.items() if x[0] != k] for k in (None, *COMMON)}


def broken(p: Pair, codes: dict[str, int] | None = None) -> dict[str, Pair]:
    """A sound pair broken in every way that it allows, by defect; what is drawn depends on the texts alone.

    Emptied; the query instead of the answer, as it is, re-cased, quoted or without a word; a sentence that declines; the answer to a query of
    another language; the answer cut inside its last sentence. With `codes`, the patterns of the votes go there, and no pair is made.
    """
    blanks, declining, asking = _fixed()
    q, a, asked = p.q.text, p.a.text, p.q.asked
    out: dict[str, Pair] = {}
    left, k = divmod(xxhash.xxh3_64_intdigest(f"{q}\n{a}"), len(blanks))
    x, known = blanks[k]
    if codes is None:
        out["empty"] = Pair(p.q, x, p.lang)
    else:
        codes["empty"] = known[p.q.topic.isdisjoint(x.words)]
    if q and len(ws := q.split()) >= 6:
        left, k = divmod(left, len(ws) - 2)
        left, way = divmod(left, 4)
        # neither case nor quotes make a difference
        same = way < 3 and p.q.plain and (way != 1 or q.isascii())
        if same and codes is not None and p.q.words:
            codes["copy"] = _ALL_FIND
        else:
            x = Answer(q if way == 0 else q.upper() if way == 1 else f'"{q}"' if way == 2 else " ".join(ws[: k + 1] + ws[k + 2 :]))
            if same:
                x.rest = p.q.words
            if codes is None:
                out["copy"] = Pair(p.q, x, p.lang)
            else:
                codes["copy"] = _CODES[copy_votes(Pair(p.q, x, p.lang))]
    if fixed := declining.get(asked):
        left, k = divmod(left, len(fixed))
        x, known = fixed[k]
        if codes is None:
            out["refusal"] = Pair(p.q, x, p.lang)
        else:
            codes["refusal"] = known[p.q.topic.isdisjoint(x.words)]
    if asked and p.a.told[0] == asked:
        others = asking.get(asked, asking[None])
        left, k = divmod(left, len(others))
        to, x = others[k]
        lang = to if _stated(p.lang) else p.lang
        if codes is None:
            out["language"] = Pair(x, p.a, lang)
        else:
            codes["language"] = _CODES[_told_votes(x, p.a, lang)]
    text = (a or "").rstrip()
    last = text.rpartition("\n")[2]
    if last[-1:] in (".", "!", "?") and last.count(" ") >= 8 and last[-2].isalpha():
        head = last[: last.rfind(" ") + 1]
        at = max(head.rfind(". "), head.rfind("! "), head.rfind("? "), head.rfind("  "))
        at = at + 2 if at >= 0 else int(last[0] == " ")
        tail = last[at:].split(" ")
        if len(tail) >= 5:
            x = Answer(text[: -len(last)] + last[:at] + " ".join(tail[: 2 + left % (len(tail) - 3)]))
            x.words = p.a.words  # what is asked of them is only whether there are any
            if codes is None:
                out["truncated"] = Pair(p.q, x, p.lang)
            else:
                codes["truncated"] = _CODES[_end_votes(x)]
    return out


def judged(p: Pair) -> tuple[dict[str, int], bool, dict[str, int]]:
    """(patterns by defect, whether the pair is sound, patterns by defect of the pair broken that way): sound is that for which, of every defect, fewer
    functions find it than don't, or none finds it."""
    own = {d: _CODES[of(p)] for d, of in VOTES.items()}
    cut: dict[str, int] = {}
    if good := _FINDING.isdisjoint(own.values()):
        broken(p, cut)
    return own, good, cut


def _logit(p: float) -> float:
    return float(np.log(p) - np.log1p(-p))


def calibrated(models: dict[str, dict[int, float]], rows: list[tuple[str | None, str | None, str | None]]) -> tuple[dict[str, float], dict]:
    """best_cutoffs() of rows (query, answer, lang)."""
    sound: dict[str, Counter] = {d: Counter() for d in DEFECTS}
    cut: dict[str, Counter] = {d: Counter() for d in DEFECTS}
    for own, good, other in (judged(Pair(*x)) for x in rows):
        for d in DEFECTS:
            if good:
                sound[d][own[d]] += 1
            if d in other:
                cut[d][other[d]] += 1
    return best_cutoffs(models, sound, cut)


def best_cutoffs(models: dict[str, dict[int, float]], sound: dict[str, dict[int, int]], cut: dict[str, dict[int, int]]) -> tuple[dict[str, float], dict]:
    """(cutoffs, report): for each defect the cutoff with the highest F1 on the answers broken that way and the sound ones, which are given as counts of
    vote patterns. Cutoffs lie halfway, as logits, between neighbouring posteriors; of equal ones the one in the widest gap is taken. The report tells
    the precision and recall there. Answers broken in another way say nothing, since an answer may have several labels."""
    cutoffs, report = {}, {}
    for d in DEFECTS:
        of = [(models[d].get(code, 0.0), n, bad) for counts, bad in ((sound[d], False), (cut[d], True)) for code, n in sorted(counts.items())]
        p, n, y = np.clip([x[0] for x in of], 1e-4, 1 - 1e-4), np.array([x[1] for x in of], int), np.array([x[2] for x in of], bool)
        cases = int(n[y].sum())
        seen = np.unique(np.append(p, [1e-4, 1 - 1e-4]))
        best = None
        for low, high in zip(seen, seen[1:]) if cases else ():
            hit = p >= high
            right, found = int(n[hit & y].sum()), int(n[hit].sum())
            f1 = 2 * right / max(1, found + cases)
            gap = _logit(high) - _logit(low)
            if best is None or (f1, gap) > best[:2]:
                middle = 1 / (1 + np.exp(-(_logit(low) + _logit(high)) / 2))
                best = (f1, gap, round(float(middle), 4), right / max(1, found), right / cases)
        cutoffs[d] = best[2] if best and best[0] > 0 else DEFAULT
        report[d] = {"cutoff": cutoffs[d], "cases": cases, "sound": int(n.sum()) - cases, "precision": round(best[3], 4) if best else 0.0, "recall": round(best[4], 4) if best else 0.0}
    return cutoffs, report


def pattern_counts(votes: DataFrame) -> dict[str, dict[str, dict[int, int]]]:
    """How many answers have each vote pattern, by defect, of all answers, of the sound ones, and of those broken that way; from the rows of vote()."""
    kinds = {"all": lambda d: F.col(d), "sound": lambda d: F.when(F.col("sound"), F.col(d)), "broken": lambda d: F.col(f"{d}_broken")}
    each = F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(d).alias("defect"), of(d).alias("code")) for k, of in kinds.items() for d in DEFECTS))
    out: dict[str, dict[str, dict[int, int]]] = {k: {d: {} for d in DEFECTS} for k in kinds}
    # at most three times 3 to the number of functions for each defect
    for kind, d, code, n in votes.select(F.explode(each).alias("x")).where("x.code is not null").groupBy("x.kind", "x.defect", "x.code").count().collect():
        out[kind][d][code] = n
    return out


def posteriors(pairs: DataFrame, id_col: str = "record_id") -> tuple[DataFrame, dict[str, float], dict]:
    """((id_col, resp_field, a posterior for each defect) with each answer once, cutoffs, report of the validation); models and cutoffs are made of all answers."""
    votes = materialize(vote(pairs, id_col), "votes")
    counts = pattern_counts(votes)
    models = {d: fit(counts["all"][d], FUNCTIONS[d]) for d in DEFECTS}
    cutoffs, report = best_cutoffs(models, counts["sound"], counts["broken"])
    cols = []
    for d in DEFECTS:
        of = F.array(*(F.lit(round(p, 6)) for _, p in sorted(models[d].items())))  # patterns are numbered from 0
        cols.append((F.get(of, F.col(d)) if models[d] else F.lit(0.0)).alias(d))
    return votes.select(id_col, "resp_field", *cols).groupBy(id_col, "resp_field").agg(*(F.max(d).alias(d) for d in DEFECTS)), cutoffs, report


def defects(posts: DataFrame, cutoffs: dict[str, float], id_col: str = "record_id") -> DataFrame:
    """(id_col, resp_field, defect, posterior): every defect that reaches its cutoff."""
    kept = F.filter(F.array(*(F.when(F.col(d) >= cutoffs[d], F.struct(F.lit(d).alias("defect"), F.col(d).alias("posterior"))) for d in DEFECTS)), lambda x: x.isNotNull())
    return posts.select(id_col, "resp_field", F.explode(kept).alias("x")).select(id_col, "resp_field", "x.*")


def worst(posts: DataFrame, cutoffs: dict[str, float], id_col: str = "record_id") -> DataFrame:
    """(id_col, resp_field, defect): the most probable defect of each answer that has one."""
    best = F.lit(-1.0)
    for d in DEFECTS:
        best = F.greatest(best, F.when(F.col(d) >= cutoffs[d], F.round(d, 3)).otherwise(-1.0))
    name = F.lit(None).cast("string")
    for d in reversed(DEFECTS):
        name = F.when((F.col(d) >= cutoffs[d]) & (F.round(d, 3) >= best - 0.02), F.lit(d)).otherwise(name)
    return posts.select(id_col, "resp_field", name.alias("defect")).where("defect is not null")


def chat_pairs(chat: DataFrame, preference: DataFrame) -> DataFrame:
    """The answers of single-turn chats and of preference records as rows (record_id, resp_field, query, answer, lang)."""
    a = chat.select("record_id", F.lit("assistant_response").alias("resp_field"), F.col("user_query").alias("query"), F.col("assistant_response").alias("answer"), "lang")
    # both answers of a record in turn
    sides = F.array(*(F.struct(F.lit(c).alias("resp_field"), F.col(c).alias("answer")) for c in ("response_a", "response_b")))
    b = preference.select("record_id", F.col("prompt").alias("query"), "lang", F.explode(sides).alias("x")).select("record_id", "x.resp_field", "query", "x.answer", "lang")
    return a.unionByName(b)
