"""Template residue, filler, error pages and script notices (problem 8).

A text is cut into sentences; each has hashed features: its tokens, pairs of neighbouring tokens, the shape of tokens around signs, its
length, its place, the status codes in it, and, in the first sentence, the words of the text's title. A multinomial logistic regression
with an L2 penalty is fitted on a bounded sample of documents, whose sentences are labelled weakly, by phrases and response statuses;
penalty and cutoff are those that do best on the hosts that were held out. The classifier alone decides: it scores every sentence of every
text, and the text takes the class of its highest score if that reaches the cutoff. No phrase is looked at then. Code blocks and
back-quoted parts are left out first, since a text that shows such a thing there only explains it.

Null and empty texts give nothing; texts of any length are read whole; repeated rows each give their row; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.functions.words import WORD, normalize, pieces, texts
from quernstone.session import materialize

CLASSES = ("placeholder", "filler", "error_page", "script_notice")
BITS, EPOCHS, PENALTIES = 18, 6, (1e-6, 1e-5, 1e-4)
#: Probabilities of any residue from which a text may be a case; the middle one is taken where nothing was held out.
CUTOFFS = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
#: Bounds of the training sample: documents read, and sentences kept of each kind (labelled, like them, others).
SAMPLE_DOCS, SAMPLE_POSITIVE, SAMPLE_NEAR, SAMPLE_OTHER = 20_000, 8_000, 12_000, 12_000

# Filler words.
LATIN = frozenset(
    """lorem ipsum dolor sit amet consectetur adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris
    nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit
    anim id est laborum vitae lectus nunc morbi felis turpis risus mattis ornare augue porta vel""".split()
)
# Names of what a template asks for.
_FIELD = r"[#/]?\s*(?:if |block |each )?[a-z][a-z_]*(?:[ .][a-z_]+){0,3}"
PLACEHOLDER = re.compile(
    rf"""\{{\{{\s*{_FIELD}\s*\}}\}} | \$\{{\s*{_FIELD}\s*\}} | <%=?\s*{_FIELD}\s*%> | \{{%\s*{_FIELD}\s*%\}} | \[\[\s*{_FIELD}\s*\]\] | \#\{{\s*{_FIELD}\s*\}} | @@\s*{_FIELD}\s*@@
      | %\([a-z_]{{3,}}\)[sd] | (?<![\w%])%[a-z][a-z_]{{2,}}%(?![\w%]) | (?<![\w])__[a-z]+(?:_[a-z]+)*__(?!\w) | (?<![\w{{$\#]){{[a-z]{{3,}}(?:_[a-z]+)*}}(?![\w}}])
      | \[\s*(?:your|insert|enter|add|type|ihre?n?|einfügen|hier|votre|vos|insérez|insérer|ins[eé]rte|su|sus|tu|ponga|escriba|name\ of|todo|tbd)\b[^\[\]]{{1,40}}\]
      | <\s*(?:enter|insert|your|add|type|ihre?n?|votre|su|escriba|geben|saisir|saisissez|introduzca)\b[^<>=/]{{1,40}}>
      | [(\[<]\s*(?:add|insert|enter|insertar|insérer|einfügen|indiquer|añadir)\s[^()\[\]<>]{{1,40}}[)\]>] | [(\[<][^()\[\]<>,;.]{{2,40}}\s(?:here|aquí|ici|hier\s(?:einfügen|einsetzen|eintragen)|einfügen|einsetzen|eintragen)\s*[)\]>]
      | \[object\ object\] | (?<![\w'"./-])undefined(?!\s+(?:function|variable|behaviou?r|method|index|reference|symbol|value|name|is|term|constant|offset|property))(?![\w(=]) | (?<=[\s(])(?:nan|null)(?=[,.!?]?(?:\s|$))(?!\s+(?:value|pointer|hypothesis|and\ void|byte|character|set))""",
    re.X | re.I,
)
# Phrases, of letters and digits with one blank between the words, in lower case.
PHRASES = {
    "script_notice": r"""(?:please|you need to|you must|must|veuillez|bitte) (?:enable|turn on|activate|allow|activer|aktivieren sie|schalten sie) (?:javascript|scripts?|java script)
        |(?:enable|activate|activez|active|habilite|active usted|aktivieren sie|turn on) (?:javascript|scripts) (?:to|in your|and|pour|para|um|in ihrem)\b|doesn t work (?:properly )?without javascript|does not work (?:properly )?without javascript|(?:requires?|needs) javascript (?:to|enabled)
        |browser is blocking scripts|scripts required by this|turn on scripts in your browser|scripts (?:and cookies )?must be (?:allowed|enabled)|javascript (?:is|must be|seems to be) (?:disabled|required|enabled|turned off)(?! the)|enable it to continue|checking your browser before
        |läuft nur mit (?:eingeschalteten|aktivierten) (?:skripten|javascript)|ohne javascript (?:funktioniert|läuft)|ne fonctionne pas si les scripts|ne fonctionne pas sans javascript|scripts sont désactivés|javascript est désactivé
        |necesita que los scripts estén habilitados|no funciona (?:correctamente )?sin javascript|scripts (?:y las cookies )?deben estar""",
    "error_page": r"""(?:error|fehler|erreur) [1-5]\d\d (?:something went wrong|die seite|la page|no se encontró|seite nicht|page introuvable|página no|not found|forbidden|internal)|something went wrong on our side
        |\b40[0-9] (?:not found|forbidden|unauthorized|bad request|gone|nicht gefunden|page introuvable|no encontrad[oa])|\b50[0-9] (?:internal server error|bad gateway|service unavailable|gateway timeout)
        |gateway time ?out|upstream (?:\w+ ){0,3}(?:did not (?:answer|respond)|timed out)|does not exist on this server|do not have permission to (?:open|access|view)|too many requests your client|your client sent more than|application error a client side exception|client side exception has occurred
        |cannot modify header information|headers already sent|call to undefined function|traceback most recent call last|database connection failed|too many clients for|could not connect to (?:the )?database|(?:key|type|value|index|attribute|name|runtime|syntax)error (?:\w+ )?(?:in|at|not)\b
        |(?:service )?temporarily unavailable|down for maintenance until|requested resource could not be loaded|listing has expired or was removed|nothing to (?:see|show|find|display) (?:under|here|at)|session has (?:timed out|expired)|sign in again to continue
        |couldn t find the page you were looking|could not find the page you|page you (?:are looking for|requested) (?:does not|could not|cannot|was not)|we ll be right back|is being upgraded|^(?:.{0,60} )?(?:access denied|accès refusé|acceso denegado|zugriff verweigert) (?:request|requête|solicitud|anfrage|vorgang|reference|incident)
        |wurde nicht gefunden|interner serverfehler|versuchen sie es in \d+ minuten|wegen wartung bis|ist wegen wartung|est introuvable|erreur interne du serveur|réessayez dans \d+ minutes|est en maintenance jusqu|no se encontró la página|error interno del servidor|vuelva a intentarlo en|está en mantenimiento hasta""",
    "filler": r"""sample text that will be replaced|your (?:headline|text|title|content) goes here|add a short description of (?:the|this) section|click edit to change this|(?:dummy|placeholder) (?:copy|text) for layout|write something catchy about|lorem ipsum dolor
        |hier steht später ihre|(?:blindtext|platzhaltertext|fülltext|beispieltext|mustertext) (?:und wird|für das|nur für)|dies ist ein \w+ und wird noch ersetzt|beschreiben sie hier kurz
        |votre titre apparaîtra ici|ajoutez ici une courte description|texte d exemple pour la mise en page|faux texte qui sera remplacé|aquí va su (?:título|texto)|texto de muestra solo para|(?:escriba|añada|describa|agregue|ponga) aquí una breve descripción|texto de relleno que se sustituirá""",
}
_PHRASES = {k: re.compile("|".join(f"(?:{x.strip()})" for x in re.split(r"\n\s*\|", v))) for k, v in PHRASES.items()}

#: Words, at least one of which every phrase of a class has, and what every placeholder has: cheap tests before the patterns (fixed values).
_TRIGGERS = {
    "script_notice": frozenset("javascript script scripts skripten enable checking".split()),
    "error_page": frozenset(
        """error fehler erreur wrong gateway upstream server permission requests client application header headers undefined traceback database clients keyerror typeerror valueerror indexerror attributeerror nameerror runtimeerror
        syntaxerror unavailable maintenance wartung mantenimiento resource listing nothing session sign page upgraded back denied refusé denegado verweigert gefunden serverfehler minuten minutes introuvable encontró vuelva""".split()
    ),
    "filler": frozenset("sample goes description edit copy text catchy ipsum später blindtext platzhaltertext fülltext beispieltext mustertext ersetzt beschreiben votre courte texte faux aquí texto".split()),
}
_STATUS = re.compile(r"^[45]\d\d$")
_MARKS = re.compile(r"[{\[<%@(]|__|undefined|\bnan\b|\bnull\b")
#: What sentences have that are like residue.
_NEAR = re.compile(r"[{}\[\]<>%@]|__|\b(?:undefined|nan|null|[45]\d\d)\b|\b(?:" + "|".join(sorted(frozenset().union(*_TRIGGERS.values()))) + r")\b")
_CODE = re.compile(r"```.*?(?:```|\Z)|~~~.*?(?:~~~|\Z)|`[^`\n]{1,300}`", re.S)
_PARAGRAPH = re.compile(r"\n[^\S\n]*\n\s*")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+(?=\S)")
#: Words, numbers, runs of signs, the ends of sentences and paragraphs, and the mark between two texts.
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[{}\[\]<>%$#@_|/\\:=()\"]{1,3}|[.!?…](?=\s)|\n[^\S\n]*\n|\x00|[^\w\s.,;:!?'’…\x00]{4,}")
#: What a sentence has if it has a word, a number or a sign.
_ANY = re.compile(r"[\w{}\[\]<>%$#@|/\\:=()\"]|[^\w\s.,;:!?'’…\x00]{4}")
_HASHES: dict[str, int] = {}
_MOST_HASHES = 400_000
_MASK = (1 << BITS) - 1
#: Codes that the hashes of words leave free: the ends of a sentence and of a text, and bits that tell numbers and signs.
_END, _END_OF_TEXT = -1, -2
_NUMBER, _SIGN = 1 << 40, 1 << 41
_BIAS = 1

# Examples of each class that join every training sample, so that a small corpus without some form doesn't unlearn it.
SEEDS = {
    "script_notice": """Please enable JavaScript to view this page.|This app doesn't work properly without JavaScript. Enable it to continue.|Your browser is blocking scripts required by this site. Allow them and reload.|You need to turn on scripts in your browser to use this.
        |Scripts and cookies must be allowed.|Checking your browser before you open this.|Bitte aktivieren Sie JavaScript, um diese Seite zu nutzen.|Diese Anwendung läuft nur mit eingeschalteten Skripten.|Veuillez activer JavaScript pour afficher cette page.
        |Ce site ne fonctionne pas si les scripts sont désactivés.|Active JavaScript para ver esta página.|El sitio necesita que los scripts estén habilitados en su navegador.""",
    "error_page": """404 Not Found The page does not exist on this server.|403 Forbidden. You do not have permission to open this.|Error 500: something went wrong on our side. Try again later.|Too many requests. Your client sent more than 9 calls per minute; wait and retry.|Your session has timed out. Sign in again to continue.
        |Application error: a client-side exception has occurred. See the console for details.|Warning: cannot modify header information, output started at line 3|Fatal error: call to undefined function f() in a on line 3|Traceback (most recent call last): File a, line 3, in load KeyError: 'x'|Database connection failed: too many clients for x (3).
        |Service temporarily unavailable (503). We are down for maintenance until 3:00.|The requested resource could not be loaded. Error code 3.|This listing has expired or was removed. Nothing to see under this.|We couldn't find the page you were looking for.|We'll be right back! The site is being upgraded.|Access denied. Request 3.
        |Fehler 404: Die Seite wurde nicht gefunden.|Interner Serverfehler (500). Bitte versuchen Sie es in 3 Minuten erneut.|Der Dienst ist wegen Wartung bis 3:00 nicht erreichbar.|Zugriff verweigert. Anfrage 3.|Erreur 404 : la page est introuvable.|Erreur interne du serveur (500). Réessayez dans 3 minutes.|Le service est en maintenance jusqu'à 3:00.|Accès refusé. Requête 3.
        |Error 404: no se encontró la página.|Error interno del servidor (500). Vuelva a intentarlo en 3 minutos.|El servicio está en mantenimiento hasta las 3:00.|Acceso denegado. Solicitud 3.""",
    "filler": """This is sample text that will be replaced later.|Your headline goes here.|Add a short description of the section in this block.|Click edit to change this paragraph.|Dummy copy for layout only.|Write something catchy about your product.|Hier steht später Ihre Überschrift.|Dies ist ein Blindtext und wird noch ersetzt.|Beschreiben Sie hier kurz den Inhalt.
        |Votre titre apparaîtra ici.|Ajoutez ici une courte description.|Texte d'exemple pour la mise en page.|Ceci est un faux texte qui sera remplacé.|Aquí va su título.|Texto de muestra solo para el diseño.|Escriba aquí una breve descripción.|Este es un texto de relleno que se sustituirá.
        |Lorem ipsum dolor sit amet, consectetur adipiscing elit sed magna.|Ut enim minim veniam quis nostrud ullamco laboris nisi aliquip.|Duis aute irure dolor in voluptate velit esse cillum fugiat nulla.|Morbi felis turpis risus mattis ornare augue porta lectus nunc vitae.""",
    "placeholder": """Hello {{ first_name }}, thank you for your interest.|Welcome to ${city}, the home of ${city}.|This page about <%= author %> was last changed.|All rights to {% block company %} belong to us.|Contact [[reviewer]] if it is missing.|Hello #{price}, welcome.|Dear @@author@@, hello.|Hello %FIRST_NAME%, thank you.|Welcome to %(city)s, the home.|All rights to __AUTHOR__ belong to us.
        |Welcome to {city}, the home of {city}.|All rights to [YOUR CITY] belong to us.|Contact [Insert reviewer here] now.|Hello <enter first name>, thank you.|All rights to (add company here) belong to us.|Hallo [IHR COMPANY], danke.|Bonjour [VOTRE FIRST NAME], merci.|Bienvenidos a [SU PAGE TITLE], la casa.|Hola [insertar order ref aquí], gracias.|Hello undefined, thank you for your interest.|This page about [object Object] was last changed.|Hello {{#if city}}{{/if}}, thank you.""",
}
_SEED_TIMES = 3


def seeds() -> list[tuple[int, np.ndarray]]:
    """(class, features) of the examples."""
    out = []
    for c, text in SEEDS.items():
        value, start, _ = features([shown(" ".join(x.split())) for x in text.split("|")])
        out += [(CLASSES.index(c) + 1, x) for x in np.split(value, start[1:])] * _SEED_TIMES
    return out


def label(paragraph: str) -> str | None:
    """The class that the exact phrases give a paragraph without code; the weak label of training and the check of what the classifier finds."""
    low = normalize(paragraph)
    ws = WORD.findall(low.replace("_", " "))
    joined, own = " ".join(ws), set(ws)
    for k in ("script_notice", "error_page", "filler"):
        if (not own.isdisjoint(_TRIGGERS[k]) or k == "error_page" and any(_STATUS.match(w) for w in own)) and _PHRASES[k].search(joined):
            return k
    if _MARKS.search(low) and PLACEHOLDER.search(low):
        return "placeholder"
    if len(ws) >= 5 and sum(w in LATIN for w in ws) >= 0.6 * len(ws):
        return "filler"
    return None


def shown(text: str) -> str:
    """A text without code blocks and back-quoted parts, normalised."""
    return normalize(_CODE.sub(" ", text) if "`" in text or "~~~" in text else text)


def sentences(text: str) -> list[list[str]]:
    """The sentences of each paragraph of a shown() text, those with a token only, as features() cuts them."""
    paragraphs = [[s for s in _SENTENCE.split(p) if _ANY.search(s)] for p in _PARAGRAPH.split(text)]
    return [p for p in paragraphs if p]


def _hash(token: str) -> int:
    if token == "\x00":
        return _END_OF_TEXT
    if token[0] in ".!?…\n":
        return _END
    if len(token) > 3 and not token[0].isalnum():
        return xxhash.xxh32_intdigest("#ruler") | _SIGN
    if token.isdigit():
        return xxhash.xxh32_intdigest("#status" if len(token) == 3 and token[0] in "45" else "#number") | _NUMBER
    return xxhash.xxh32_intdigest(token) | (0 if token[0].isalpha() else _SIGN)


def _token_hashes(tokens: list[str]) -> np.ndarray:
    try:
        return np.fromiter(map(_HASHES.__getitem__, tokens), np.int64, len(tokens))
    except KeyError:
        if len(_HASHES) > _MOST_HASHES:
            _HASHES.clear()
        for t in tokens:
            if t not in _HASHES:
                _HASHES[t] = _hash(t)
        return np.fromiter(map(_HASHES.__getitem__, tokens), np.int64, len(tokens))


def _mixed(*parts: np.ndarray) -> np.ndarray:
    h = np.zeros(len(parts[0]), np.int64)
    for p in parts:
        h = (h + p) * 0x9E3779B1
        h ^= h >> 29
    return (h >> 7) & _MASK


def _parts(docs: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, int]:
    """([(features, the sentence of each)], the text of each sentence, number of sentences) of some texts without code.

    All texts are cut by one pass of one pattern; each list of features is in the order of the sentences.
    """
    h = _token_hashes(_TOKEN.findall("\x00".join(d.replace("\x00", " ") for d in docs)))
    inside = h >= 0
    at = np.cumsum(~inside)
    text = np.cumsum(h == _END_OF_TEXT)[inside]
    at, h = at[inside], h[inside]
    if not len(h):
        return [], np.empty(0, np.int64), 0
    new = np.concatenate([[True], at[1:] != at[:-1]])
    start = np.flatnonzero(new)
    at = np.cumsum(new) - 1
    of = text[start]
    same = at[1:] == at[:-1]
    pair = np.flatnonzero(same)
    # the kind of a token around a sign: the sign itself, a number or a word
    sign = h >= _SIGN
    shape = np.where(sign, h, np.where(h >= _NUMBER, 3, 5))
    three = np.flatnonzero(same[1:] & same[:-1] & (sign[2:] | sign[1:-1] | sign[:-2])) if len(h) > 2 else np.empty(0, np.int64)
    first = np.concatenate([[True], of[1:] != of[:-1]])
    alone = first & np.concatenate([of[1:] != of[:-1], [True]])
    size = np.minimum(np.log2(np.diff(np.append(start, len(h))) + 1).astype(np.int64), 9)
    n = len(start)
    title = np.flatnonzero(first[at])
    title = title[title - start[at[title]] < 12]
    out = [
        (_mixed(h), at), (_mixed(h[pair], h[pair + 1]), at[pair]), (_mixed(shape[three], shape[three + 1], shape[three + 2]), at[three]),
        (_mixed(h[title], np.full(len(title), 11)), at[title]), (_mixed(size + 16 * first + 32 * alone, np.full(n, 13)), np.arange(n)), (np.full(n, _BIAS), np.arange(n)),
    ]
    return out, of, n


def features(docs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of all sentences of some texts without code in a row, where each sentence's features start, and the text of each."""
    parts, of, n = _parts(docs)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), of
    where = np.concatenate([x for _, x in parts])
    order = np.argsort(where, kind="stable")
    return np.concatenate([x for x, _ in parts])[order], np.searchsorted(where[order], np.arange(n)), of


def _softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return e / e.sum(axis=1, keepdims=True)


def scores(weights: np.ndarray, value: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Probabilities of none and of each class for each sentence."""
    return _softmax(np.add.reduceat(weights[value], start, axis=0))


def probabilities(weights: np.ndarray, docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(scores() of the sentences of some texts without code, the text of each), summed without bringing each sentence's features together."""
    parts, of, n = _parts(docs)
    z = np.zeros((n, weights.shape[1]), np.float32)
    for value, at in parts:
        if len(at):
            new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            z[at[new]] += np.add.reduceat(weights[value], new, axis=0)
    return _softmax(z) if n else z, of


@dataclass(frozen=True)
class Batch:
    """Some rows (class, features) side by side, their features in order, and where each feature's places begin in that order."""

    value: np.ndarray
    start: np.ndarray
    kinds: np.ndarray
    order: np.ndarray
    row: np.ndarray
    used: np.ndarray
    first: np.ndarray


def batches(rows: list[tuple[int, np.ndarray]], size: int = 256, seed: int = 5) -> list[Batch]:
    """The rows in mini-batches by chance; their features are grouped once for all epochs and penalties."""
    out = []
    mixed = np.random.default_rng(seed).permutation(len(rows))
    for k in range(0, len(mixed), size):
        part = [rows[i] for i in mixed[k : k + size]]
        sizes = np.array([len(f) for _, f in part])
        value = np.concatenate([f for _, f in part])
        order = np.argsort(value, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(value[order]) > 0]))
        row = np.repeat(np.arange(len(part)), sizes)[order]
        out.append(Batch(value, np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.array([c for c, _ in part]), order, row, value[order][first], first))
    return out


def train(parts: list[Batch], penalty: float, epochs: int = EPOCHS, seed: int = 5) -> np.ndarray:
    """Weights of a multinomial logistic regression by mini-batches, in another order each epoch, with per-weight step sizes."""
    w = np.zeros((1 << BITS, len(CLASSES) + 1))
    if not parts:
        w[_BIAS, 0] = 5.0
        return w.astype(np.float32)
    seen = np.full(w.shape, 1e-6)
    r = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in r.permutation(len(parts)):
            b = parts[k]
            g = scores(w, b.value, b.start)
            g[np.arange(len(b.kinds)), b.kinds] -= 1
            grad = np.add.reduceat(g[b.row], b.first, axis=0) / len(b.kinds) + penalty * w[b.used]
            seen[b.used] += grad**2
            w[b.used] -= 0.5 * grad / np.sqrt(seen[b.used])
    return w.astype(np.float32)


def _labels(text: str) -> list[tuple[int, bool]]:
    """(weak label, whether it is near residue) of each sentence of a shown() text: a class from 1, 0 for none, -1 for a sentence of a labelled paragraph that
    has no label itself. Where only two neighbouring sentences together have the label, both get it. A text of one sentence is near."""
    out = []
    own = sentences(text)
    for p in own:
        whole = label(" ".join(p))
        found = [whole and (label(s) if len(p) > 1 else whole) for s in p]
        if whole and not any(found):
            for i in range(len(p) - 1):
                if label(f"{p[i]} {p[i + 1]}"):
                    found[i] = found[i + 1] = whole
        for s, c in zip(p, found):
            out.append((CLASSES.index(c) + 1 if c else -1 if whole else 0, bool(_NEAR.search(s)) or len(own) == len(p) == 1))
    return out


def sample(docs: DataFrame, id_col: str, text_col: str, host_col: str, most: int = SAMPLE_DOCS) -> list[tuple[int, float, str, np.ndarray]]:
    """(class, weight, host, features) of a bounded sample of sentences, of the documents with the smallest hashes.

    Labelled sentences, those that hold a word or sign of the phrases, and others are kept up to a bound each, by hash; the weight is how
    many a kept one stands for. The labelled sample is written once.
    """
    share = min(1.0, most / max(1, docs.count()))
    keyed = docs.select(F.pmod(F.xxhash64(F.lit(7), F.col(id_col)), F.lit(1 << 30)).alias("h"), F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("t"))
    few = keyed.where(F.col("h") < F.lit(int(share * (1 << 30)))).where("t is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "t"):
            own = [shown(t.replace("\x00", " ")) for t in texts(b.column(2))]
            value, start, of = features(own)
            known = [x for t in own for x in _labels(t)]
            if len(known) != len(start):
                raise AssertionError(f"{len(known)} labels for {len(start)} sentences")
            kind = np.array([(1 if c > 0 else 2 if near else 3) if c >= 0 else 0 for c, near in known], np.int64)
            at = np.flatnonzero((kind > 0) & ((kind < 3) | (np.arange(len(kind)) * 2654435761 % 2**32 < 2**32 // 4)))
            ends = np.append(start[1:], len(value))
            hosts = b.column(1).to_pylist()
            f = pa.array([value[start[i] : ends[i]].astype(np.int32) for i in at], pa.list_(pa.int32()))
            cols = [pa.array(kind[at], pa.int32()), pa.array([known[i][0] for i in at], pa.int32()), pa.array([hosts[of[i]] or "" for i in at], pa.string()), f]
            yield pa.RecordBatch.from_arrays(cols, ["kind", "c", "host", "f"])

    rows = materialize(few.mapInArrow(run, "kind int, c int, host string, f array<int>").withColumn("o", F.xxhash64("f", "host")), "sentences")
    counts = {r[0]: r[1] for r in rows.groupBy("kind").agg(F.count("*")).collect()}
    out = []
    for kind, bound in ((1, SAMPLE_POSITIVE), (2, SAMPLE_NEAR), (3, SAMPLE_OTHER)):
        part = rows.where(F.col("kind") == kind).orderBy("o").limit(bound).select("c", "host", "f").collect()
        stands = counts.get(kind, 0) / max(1, len(part)) * (4 if kind == 3 else 1)
        out += [(r[0], stands, r[1], np.array(r[2], np.int64)) for r in part]
    return out


def _best_cutoff(p: np.ndarray, c: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """(cutoff, precision, recall) of the sentences with any residue: the cutoff with the highest F1, the middle one of equal ones."""
    of = p[:, 1:].argmax(1) + 1
    got = []
    for cut in CUTOFFS:
        hit = 1 - p[:, 0] >= cut
        right = (weight * (hit & (of == c))).sum()
        precision, recall = right / max(1e-9, (weight * hit).sum()), right / max(1e-9, (weight * (c > 0)).sum())
        got.append((float(2 * precision * recall / max(1e-9, precision + recall)), cut, float(precision), float(recall)))
    best = [x[1:] for x in got if x[0] >= max(got)[0] - 1e-6]
    return best[len(best) // 2]


def fit(rows: list[tuple[int, float, str, np.ndarray]]) -> tuple[np.ndarray, float, dict]:
    """(weights, cutoff, report). A fifth of the hosts is held out: the penalty is the one with the least loss there, the cutoff the one with
    the highest F1; the report tells both, the held-out sentences, and the precision and recall on them. The weights are then fitted to all rows."""
    if not rows:
        return train([], PENALTIES[0]), CUTOFFS[len(CUTOFFS) // 2], {"penalty": PENALTIES[0], "cutoff": CUTOFFS[len(CUTOFFS) // 2], "sentences": 0, "precision": 0.0, "recall": 0.0}
    held = np.array([xxhash.xxh32_intdigest(h) % 5 == 0 for _, _, h, _ in rows])
    known, unseen = [(r[0], r[3]) for r, x in zip(rows, held) if not x], [r for r, x in zip(rows, held) if x]
    best = None
    parts = batches(known + seeds()) if known and unseen else []
    for penalty in PENALTIES:
        if not parts:
            best = (0.0, penalty, CUTOFFS[len(CUTOFFS) // 2], 0.0, 0.0)
            break
        w = train(parts, penalty)
        p = scores(w, np.concatenate([r[3] for r in unseen]), np.cumsum([0, *(len(r[3]) for r in unseen[:-1])]))
        c, weight = np.array([r[0] for r in unseen]), np.array([r[1] for r in unseen])
        loss = float(-(weight * np.log(p[np.arange(len(c)), c] + 1e-9)).sum() / weight.sum())
        if best is None or loss < best[0]:
            best = (loss, penalty, *_best_cutoff(p, c, weight))
    _, penalty, cutoff, precision, recall = best
    report = {"penalty": penalty, "cutoff": cutoff, "sentences": len(unseen), "precision": precision, "recall": recall}
    return train(batches([(r[0], r[3]) for r in rows] + seeds()), penalty), cutoff, report


def find(docs: DataFrame, weights: np.ndarray, cutoff: float, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, residue, score) of the texts with residue: class and score of the sentence that is most probably some, if its score reaches the cutoff."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in pieces(batches, text_col, 1_000_000):
            p, of = probabilities(w, [shown(t) if t else "" for t in texts(b.column(1))])
            score = 1 - p[:, 0] if len(p) else np.empty(0)
            k = np.flatnonzero(score >= cutoff)
            k = k[np.lexsort((k, -score[k], of[k]))]
            k = k[np.concatenate([[True], of[k][1:] != of[k][:-1]])] if len(k) else k
            name = [CLASSES[i] for i in p[k, 1:].argmax(1)] if len(k) else []
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(of[k], pa.int64())), pa.array(name, pa.string()), pa.array(score[k], pa.float64())], [id_col, "residue", "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, residue string, score double")
