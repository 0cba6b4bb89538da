"""Personal information inside free text (problem 7).

Method: a skip-chain conditional random field over tokens. Each token of a line
has one of eleven labels (begin and inside of five kinds, and none). Its unary
potentials come from the classes of the tokens around it, from the last label
word on its line, and from what a pattern or the name index proposes at its
place (shape, capitals, street word, label before it); neighbours are tied by
trained transitions. Tokens that begin equal or similar surfaces anywhere in a
document share a potential: loopy messages go between the chains of its lines
until they stand still, so a number that a label explains in one place is read
alike wherever it stands alone, however often and however far. The best
labelling then gives the spans, so a span may be shorter, longer or another
than what a pattern proposed.

Unary and transition weights maximise the conditional likelihood of sentences
made by ``llm/samples.py`` (invented words, ``SAMPLES`` of them); the weight of
the skip edges is the one under which repeats of those sentences are likeliest.

Surfaces are cut from the text as it stands: patterns run over a folded form
(no accents, one case, one form of each character) with a map of positions.

Defined results: null, empty and blank texts give nothing; a surface counts
once a row and kind; whole texts are read. Names are those of the directory:
family name together with given name or its initial. A line on which nothing
is proposed has no label. Directories of any size are read (``llm/names.py``).
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Container, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.names import field
from lettermill.llm.samples import PEOPLE, repeated, samples
from lettermill.llm.text import PROTOTYPES, share_look_alikes

KINDS = ("email", "phone", "id_number", "street_address", "person_name")
#: sentences the weights are fitted on
SAMPLES = 4_000

# ---------------------------------------------------------------- folded text

_PLAIN = {"ø": "o", "đ": "d", "ł": "l", "ß": "ss", "æ": "ae", "œ": "oe", "ð": "d", "þ": "th", "ı": "i", "’": "'", "–": "-"}


class _Folds(dict):
    def __missing__(self, ch: str) -> str:
        base = PROTOTYPES[ord(ch)]
        out = ""
        for c in unicodedata.normalize("NFD", base or ""):
            if not unicodedata.combining(c):
                c = c.lower() if len(c.lower()) == 1 else c
                out += _PLAIN.get(c, c)
        self[ch] = out
        return out


_FOLD = _Folds()


def fold(text: str) -> tuple[str, list[int] | None]:
    """Folded text, and for each of its characters the position in ``text``; None where they are the same."""
    if text.isascii():
        return text.lower(), None
    parts = [_FOLD[c] for c in text]
    if all(len(p) == 1 for p in parts):
        return "".join(parts), None
    at: list[int] = []
    for i, p in enumerate(parts):
        at += [i] * len(p)
    at.append(len(text))
    return "".join(parts), at


def _cut(text: str, at: list[int] | None, a: int, b: int) -> str:
    if at is None:
        return text[a:b]
    end = at[b - 1] + 1
    while end < len(text) and unicodedata.combining(text[end]):
        end += 1
    return text[at[a] : end]


# ---------------------------------------------------------------- candidates

_DOT, _AT = r"(?:\.| ?[\[({] ?dot ?[\])}] ?| dot )", r"(?:@| ?[\[({] ?at ?[\])}] ?)"
_LOCAL, _LABEL = r"[a-z0-9_%+'\-]+", r"[a-z0-9](?:[a-z0-9\-]*[a-z0-9])?"
_EMAIL = re.compile(
    rf"(?<![\w.+\-]){_LOCAL}(?:{_DOT}{_LOCAL})*{_AT}{_LABEL}(?:{_DOT}{_LABEL})+|(?<![\w.+\-]){_LOCAL}(?:{_DOT}{_LOCAL})* at {_LABEL}(?: dot {_LABEL})+"
)
_NUMBER = re.compile(
    r"(?<![\w@])(?:"
    r"[a-z]{2} ?\d{2} ?\d{2} ?\d{2} ?[a-d]|[a-z]{1,2}\d{6,9}|\d{7,8}[a-z]"
    r"|(?:\+|\()?\d(?:[\d]|[ .\-/()]{1,2}(?=[\d(]))*\d"
    r")(?![\w@])"
)
_SHAPES: tuple[tuple[str, re.Pattern], ...] = tuple(
    (n, re.compile(p))
    for n, p in (
        ("plus", r"\+\d{1,3}(?:[ .\-/]{0,2}\(?\d{1,5}\)?){2,6}"),
        ("idd", r"00[1-9]\d(?:[ .\-/]\d{1,5}){2,5}"),
        ("area", r"\(0?\d{2,4}\)[ .\-/]?\d{3,5}(?:[ .\-]\d{2,5}){0,3}"),
        ("nanp", r"\d{3}([ .\-])\d{3}\1\d{4}"),
        ("nanp1", r"1([ .\-])\d{3}\1\d{3}\1\d{4}"),
        ("pairs", r"0\d([ .\-])\d\d\1\d\d\1\d\d\1\d\d"),
        ("trunk", r"0\d{2,4}[ /\-]\d{3,4}[ \-]?\d{3,4}"),
        ("threetwofour", r"\d{3}([ \-])\d{2}\1\d{4}|\d{9}"),
        ("taxid", r"\d{2} ?\d{3} ?\d{3} ?\d{3}"),
        ("fours", r"\d{4}([ \-]?)\d{4}\1\d{4}"),
        ("cpf", r"\d{3}\.\d{3}\.\d{3}-\d{2}"),
        ("checked", r"\d{7,8}[a-z]"),
        ("passport", r"[a-z]{1,2}\d{6,9}"),
        ("insurance", r"[a-z]{2} ?\d{2} ?\d{2} ?\d{2} ?[a-d]"),
    )
)
_STREET_EN = r"(?:street|st|road|rd|lane|ln|avenue|ave|boulevard|blvd|close|crescent|court|ct|square|sq|drive|dr|way|place|pl|terrace|parkway|pkwy|highway|hwy|gardens|grove|mews|walk)"
_W = r"[a-z][a-z'\-]*"
_ADDRESS = re.compile(
    rf"(?<![\w.,\-/])\d{{1,5}} ?[a-z]?(?: bis)?,? (?:[nsew]\.? )?(?:{_W} ){{1,3}}?{_STREET_EN}\b\.?"
    rf"|(?<![\w.,\-/])\d{{1,4}} ?[a-z]?(?: bis| ter| quater)?,? (?:rue|avenue|place|chemin|boulevard|allee|quai|impasse|route|cours|square|bd\.?|boul\.?|av\.?|pl\.|ch\.) (?:(?:des|du|de la|de l'|de|d') ?)?{_W}(?: {_W}){{0,2}}"
    rf"|(?<![\w\-])(?:(?:am|an der|an den|auf der|im|in der|zum|zur|unter den|hohe[rn]?|alte[rn]?|neue[rn]?|lange[rn]?|kleine[rn]?|grosse[rn]?|obere[rn]?|untere[rn]?) )?{_W}(?:strasse|str\.|weg|pfad|allee|gasse|platz|teich|ufer|ring|damm|hof|markt|steig|graben|stieg|tor|winkel|chaussee) \d{{1,4}} ?[a-z]?(?![\w])"
    rf"|(?<![\w\-]){_W} (?:strasse|str\.|weg|pfad|allee|gasse|platz|ufer|ring|damm|markt|steig|stieg|chaussee) \d{{1,4}} ?[a-z]?(?![\w])"
    rf"|(?<![\w\-])(?:calle|avenida|av\.|rua|plaza|praca|paseo|travessa|alameda|via|viale|piazza|corso|largo) (?:(?:de la|de los|del|della|dei|delle|de|da|do|dos|das|la) )?{_W}(?: {_W}){{0,2}},? \d{{1,4}} ?[a-z]?(?![\w])"
    rf"|(?<![\w\-])(?:unter den|hinter den|an den|auf dem|vor dem) {_W} \d{{1,3}} ?[a-z]?(?![\w])"
)
_WORDS = re.compile(r"[a-z]+(?:-[a-z]+)*")
_SMALL = frozenset(
    "a an and are as at be by came can close day days dear for from had has have he hi i if in into is it items left many more no nobody of on or our parts per she "
    "so than that the there they this to us was we were who will with you your were week weeks hours minutes pages units".split()
)
_OF = frozenset("der den dem del della dei delle de da do dos das la los".split())

_LABELS: tuple[tuple[str, re.Pattern], ...] = tuple(
    (n, re.compile(p))
    for n, p in (
        ("id", r"(?:social security(?: number| no\.?)?|ssn|passport(?: number| no\.?)?|reisepass|passeport|pasaporte|passaporte|ni number|national insurance(?: number)?|nino|citizen(?: number| id)?|steuer-?id(?:nummer)?|steuernummer|tax (?:id|number|reference)|tin|cpf|nif|dni|nie)\s*[:#.]?\s*$"),
        ("number", r"(?:article|item|order|part|serial|invoice|batch|ref(?:erence)?|case|ticket|lot|row|door|room|build|version|barcode|code|slot|page|seite|page|no|nr|num|numbers?|isbn|account|iban|claim|id)\s*(?:no|nr|number)?\s*[.:#]?\s*$"),
        ("phone", r"(?:\bt|\bm|\bf|tel|tele?fon[eo]?|telephone|phone|mobile|mob|cell|fax|call|ring|handy|mobil|portable|movil|hotline|office)\s*[.:]*\s*$"),
        ("reach", r"(?:\bat|\bunter|\bau|\bal|\bpelo|\bon|,)\s*$"),
    )
)


class Span:
    __slots__ = ("a", "b", "feats", "labels", "key")

    def __init__(self, a: int, b: int, labels: tuple[str, ...], feats: list[str], key: str) -> None:
        self.a, self.b, self.labels, self.feats, self.key = a, b, labels, feats, key


def name_entries(given: str | None, family: str | None) -> Iterator[str]:
    """What the field of a directory holds of a person: the family name, and it with the given name or its initial."""
    if given and family and given.strip() and family.strip():
        g, f = " ".join(fold(given)[0].split()), " ".join(fold(family)[0].split())
        if g and f:
            yield f"f:{f}"
            yield f"g:{f}:{g}"
            yield f"i:{f}:{g[0]}"


class _Given:
    """Given names that go with one family name."""

    def __init__(self, people: Container[str], family: str) -> None:
        self.people, self.family = people, family

    def __contains__(self, word: str) -> bool:
        return f"g:{self.family}:{word}" in self.people

    def initial(self, letter: str) -> bool:
        return f"i:{self.family}:{letter}" in self.people


class Names:
    """Finds the people of a directory; ``people`` holds its ``name_entries``."""

    def __init__(self, people: Container[str]) -> None:
        self.people = people

    def spans(self, low: str) -> Iterator[tuple[int, int, str]]:
        words = None
        for m in _WORDS.finditer(low):
            fam = m.group(0)
            if f"f:{fam}" not in self.people:
                continue
            if words is None:
                all_ = [(x.start(), x.end(), x.group(0)) for x in _WORDS.finditer(low)]
                words = ({s: i for i, (s, _, _) in enumerate(all_)}, all_)
            place, all_ = words
            k = place[m.start()]
            given = _Given(self.people, fam)
            got = self._before(low, all_, k, given) or self._after(low, all_, k, given)
            if got:
                yield *got, fam

    @staticmethod
    def _before(low: str, w: list, k: int, given: _Given) -> tuple[int, int] | None:
        i = k - 1
        # initials between; the first of the run may be the given name's own
        while i >= 0 and k - i <= 4:
            s, e, word = w[i]
            gap = low[e : w[i + 1][0]]
            one = len(word) == 1
            if gap.strip(" ") not in (("", ".") if one else ("",)) or "\n" in gap or len(gap) > 3 or not gap:
                return None
            if word in given:
                return s, w[k][1]
            if not one:
                return None
            if i == 0 or len(w[i - 1][2]) > 1 or low[w[i - 1][1] : s].strip(" .") or "\n" in low[w[i - 1][1] : s]:
                # the first initial: it stands for the given name, unless that comes before it
                if i > 0 and w[i - 1][2] in given and low[w[i - 1][1] : s].strip(" ") == "":
                    return w[i - 1][0], w[k][1]
                return (s, w[k][1]) if given.initial(word) else None
            i -= 1
        return None

    @staticmethod
    def _after(low: str, w: list, k: int, given: _Given) -> tuple[int, int] | None:
        i = k + 1
        while i < len(w) and i - k <= 3:
            s, e, word = w[i]
            gap = low[w[i - 1][1] : s]
            ok = (" ", ", ", "  ", ",") if i == k + 1 else (". ", " ", ".")
            if gap not in ok:
                return None
            if word in given:
                return w[k][0], e
            if len(word) != 1:
                return None
            dotted = low[e : e + 1] == "."
            nxt = w[i + 1] if i + 1 < len(w) else None
            if nxt and low[e : nxt[0]] in (". ", " ") and nxt[2] in given:
                return w[k][0], nxt[1]
            if i == k + 1 and given.initial(word) and dotted:
                return w[k][0], e + 1
            i += 1
        return None


def _left(low: str, a: int) -> str:
    return low[max(0, a - 40, low.rfind("\n", 0, a) + 1) : a]


def candidates(text: str, low: str, at: list[int] | None, names: Names) -> list[Span]:
    out: list[Span] = []
    taken = bytearray(len(low) + 1)
    free = lambda a, b: 1 not in taken[a:b]
    if "@" in low or " at " in low or "at]" in low or "at)" in low or "at}" in low:
        for m in _EMAIL.finditer(low):
            a, b = m.span()
            taken[a:b] = b"\1" * (b - a)
            feats = ["email", "email:at" if "@" in m.group(0) else "email:spelled"]
            if re.search(r"message-id\W*$|<mid:$", _left(low, a)):
                feats.append("email:messageid")
            out.append(Span(a, b, ("email",), feats, m.group(0)))
    digits = any(c.isdigit() for c in low)
    mixed = not text.islower() and not text.isupper()
    if digits:
        for m in _ADDRESS.finditer(low):
            a, b = m.span()
            if not free(a, b):
                continue
            got = m.group(0)
            number_first = got[0].isdigit()
            rom = number_first and re.match(r"\d+ ?[a-z]?(?: bis| ter| quater)?,? (?:rue|avenue|place|chemin|boulevard|allee|quai|impasse|route|cours|square|bd\.?|boul\.?|av\.?|pl\.|ch\.) ", got)
            real = _cut(text, at, a, b)
            feats = ["address"]
            words = re.findall(r"[^\W\d_][\w'’\-]*", real)
            if rom:
                # after the first word of the name only words with a capital belong to it
                head = rom.end() + len(re.match(r"(?:(?:des|du|de la|de l'|de|d') ?)?", got[rom.end() :]).group(0))
                tail = got[head:].split(" ")
                keep = 1
                while keep < len(tail) and _cut(text, at, a + head + len(" ".join(tail[:keep])) + 1, b)[:1].isupper() and mixed:
                    keep += 1
                b = a + head + len(" ".join(tail[:keep]))
                feats.append("address:romance")
                feats.append("address:capital" if _cut(text, at, a + head, b)[:1].isupper() or not mixed else "address:small")
            elif number_first:
                if got.endswith("."):
                    nxt = low[b : b + 2].lstrip(" ")[:1]
                    if not (got.endswith("blvd.") or (nxt and (nxt in ",;" or (nxt.isalpha() and not _cut(text, at, min(b + 1, len(low) - 1), min(b + 2, len(low)))[:1].isupper())))) or not re.search(r"(?:st|rd|ln|ave|blvd|ct|sq|dr|pl|pkwy|hwy)\.$", got):
                        b -= 1
                inner = [w for w in words if w.lower() not in ("bis",) and len(w) > 1]
                small = [w for w in inner if w.lower() in _SMALL and w.lower() != "close"] or [w for w in inner[:-1] if w.lower() in _SMALL]
                feats.append("address:function" if small else "address:names")
                feats.append("address:capital" if (all(w[:1].isupper() for w in inner) or (not mixed and not small)) else "address:small")
                nxt = low[b : b + 1]
                feats.append("address:closed" if nxt in ("", ",", ".", ";", "\n", "\r") else "address:open")
            else:
                feats.append("address:german")
                # name and kind of the street both begin with a capital
                feats.append("address:capital" if all(w[:1].isupper() or w in _OF for w in words[:3] if len(w) > 1) or not mixed else "address:small")
            taken[a:b] = b"\1" * (b - a)
            out.append(Span(a, b, ("street_address",), feats, low[a:b]))
        for m in _NUMBER.finditer(low):
            a, b = m.span()
            got = m.group(0)
            if got[0] == "(" and ")" not in got:
                a, got = a + 1, got[1:]
            elif got.count("(") != got.count(")") or not free(a, b):
                continue
            shapes = [n for n, p in _SHAPES if p.fullmatch(got)]
            n = sum(c.isdigit() for c in got)
            if n < 6:
                continue
            shapes = shapes or ["other"]
            left = _left(low, a)
            label = next((n for n, p in _LABELS if p.search(left)), "none")
            alone = not left.strip() and low[b : b + 1] in ("", "\n", "\r")
            feats = ["number", *[f"shape:{s}" for s in shapes], f"left:{label}", *[f"shape:{s}&left:{label}" for s in shapes]]
            if alone:
                feats.append("alone")
            if n > 15:
                feats.append("long")
            taken[a:b] = b"\1" * (b - a)
            out.append(Span(a, b, ("phone", "id_number"), feats, re.sub(r"\D", "", got) if got[0] not in "abcdefghijklmnopqrstuvwxyz" else got.replace(" ", "")))
    for a, b, fam in names.spans(low):
        if not free(a, b):
            continue
        taken[a:b] = b"\1" * (b - a)
        out.append(Span(a, b, ("person_name",), ["name", "name:initial" if re.match(r"[a-z]\b", low[a:b]) or re.search(r"\b[a-z]\.?$", low[a:b]) else "name:given"], fam))
    out.sort(key=lambda s: s.a)
    return out


# ---------------------------------------------------------------- tokens

LABELS = ("O", *[f"{p}-{k}" for k in KINDS for p in "BI"])
_NL = len(LABELS)
_B = {k: LABELS.index(f"B-{k}") for k in KINDS}
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\s\w]|_")
#: words that tell what stands after or around them, by what they tell
_TELL: dict[str, str] = {
    w: c
    for c, ws in {
        "ID": "ssn ni passport reisepass passeport pasaporte passaporte nino insurance security citizen steuer steuernummer tax tin cpf nif dni nie ausweis identity identification",
        "PHONE": "t m f tel telefon telefono telefone telephone phone mobile mob cell fax call ring handy mobil portable movil hotline office reach erreichen joindre fale llame contact",
        "THING": "article item order part serial invoice batch ref reference case ticket lot row door room build version barcode code slot page seite isbn ean account iban claim total sum counted",
        "NO": "no nr num number numbers nummer numero id",
        "STREET": "street st road rd lane ln avenue ave boulevard blvd close crescent court ct square sq drive dr way place pl terrace parkway pkwy highway hwy gardens grove mews walk",
        "RUE": "rue chemin allee quai impasse route cours calle avenida rua plaza praca paseo travessa alameda via viale piazza corso largo strasse str weg gasse platz",
        "UNIT": "suite apt unit floor flat etage",
        "SMALL": "a an and are as at be by for from had has have he her his i if in is it of on or our she so than that the their there they this to us was we who will with you your am im der die das den und zu unter le la les et est de des du el los las y es en o os e da do em por pelo",
        "TIME": "uhr hours days minutes weeks people units boxes kisten montag mai",
    }.items()
    for w in ws.split()
}
_MEMORY = {"ID": 1, "PHONE": 2, "THING": 3}
_MARKS = ".,:;-/()+@#<>[]'|_*&"
_CLASSES = ("PAD", *sorted(set(_TELL.values())), "WORD", "CAP", "LETTER", *[f"D{k}" for k in range(1, 9)], "STRASSE", *_MARKS, "MARK")
_CLASS = {c: i for i, c in enumerate(_CLASSES)}
_SUFFIX = re.compile(r"(?:strasse|str|weg|pfad|allee|gasse|platz|teich|ufer|ring|damm|hof|markt|steig|graben|stieg|tor|winkel|chaussee)$")
_WINDOW = 2


class _Kinds(dict):
    """Class of a token, kept (bounded)."""

    def __missing__(self, t: str) -> int:
        if t[0].isdigit():
            c = f"D{min(len(t), 8)}"
        elif t[0].isalpha():
            c = _TELL.get(t) or ("LETTER" if len(t) == 1 else "STRASSE" if len(t) > 5 and _SUFFIX.search(t) else "WORD")
        else:
            c = t if t in _MARKS else "MARK"
        if len(self) > 200_000:
            self.clear()
        got = self[t] = _CLASS[c]
        return got


_KIND = _Kinds()
_WORD_ID, _CAP_ID = _CLASS["WORD"], _CLASS["CAP"]
_MEMORY_OF = {_CLASS[c]: m for c, m in _MEMORY.items()}


class Read:
    """Lines of texts as arrays of tokens. A padding token parts the lines."""

    def __init__(self, features: dict[str, int] | None) -> None:
        self.features = features  # None: every feature met gets a number
        self.known: dict[str, int] = {} if features is None else features
        self.combos: dict[tuple, int] = {(): 0}
        self.cls, self.combo, self.place, self.memory = [], [], [], []
        self.at: list[tuple[int, int]] = []  # begin and end of each token in the folded text
        self.lines: list[tuple[int, int, int]] = []  # text, first token, end
        self.heads: list[tuple[int, tuple, int, bool]] = []  # text, surface, token, whether a label is before it
        self.gold: list[int] = []
        self._arrays: list[np.ndarray] | None = None

    def add(self, k: int, text: str, low: str, at: list[int] | None, spans: list[Span], gold: list[tuple[int, int, str]] | None = None) -> None:
        i = 0
        while i < len(spans):
            start = low.rfind("\n", 0, spans[i].a) + 1
            j = i
            end = low.find("\n", spans[i].a)
            end = len(low) if end < 0 else end
            while j < len(spans) and spans[j].a < end:
                end = max(end, spans[j].b)
                j += 1
            self._line(k, text, low, at, start, end, spans[i:j], gold)
            i = j

    def _line(self, k: int, text: str, low: str, at: list[int] | None, start: int, end: int, spans: list[Span], gold: list[tuple[int, int, str]] | None) -> None:
        first = len(self.cls)
        memory, s = 0, 0
        for m in _TOKEN.finditer(low, start, end):
            a, b = m.span()
            c = _KIND[m.group(0)]
            while s < len(spans) and spans[s].b <= a:
                s += 1
            combo = place = 0
            if s < len(spans) and spans[s].a <= a:
                span = spans[s]
                combo = self.combos.setdefault(tuple(span.feats), len(self.combos))
                place = 1 if a == span.a else 2
                if b == span.b:
                    place += 2  # the last token
                if a == span.a and span.labels[0] == "phone":
                    self.heads.append((k, ("=", span.key), len(self.cls), memory != 0))
            elif c in _MEMORY_OF:
                memory = _MEMORY_OF[c]
            if c == _WORD_ID and text[a if at is None else at[a]].isupper():
                c = _CAP_ID
            self.cls.append(c)
            self.combo.append(combo)
            self.place.append(place)
            self.memory.append(memory)
            self.at.append((a, b))
            if gold is not None:
                g = next(((x, y, kind) for x, y, kind in gold if x <= a < y), None)
                self.gold.append(0 if g is None else _B[g[2]] + (a != g[0]))
        self.lines.append((k, first, len(self.cls)))
        for _ in range(_WINDOW):
            self.cls.append(0)
            self.combo.append(0)
            self.place.append(0)
            self.memory.append(0)
            self.at.append((0, 0))
            if gold is not None:
                self.gold.append(0)

    def arrays(self) -> list[np.ndarray]:
        """Class, combination, place and memory of the tokens; asked for when all lines are read."""
        if self._arrays is None or len(self._arrays[0]) != len(self.cls):
            self._arrays = [np.array(x, np.int64) for x in (self.cls, self.combo, self.place, self.memory)]
        return self._arrays

    def rows(self) -> list[list[int]]:
        """Numbers of the features of each combination."""
        out = []
        for feats in self.combos:
            for f in feats:
                if self.features is None:
                    self.known.setdefault(f, len(self.known))
            out.append([self.known[f] for f in feats if f in self.known])
        return out


class Weights:
    """``window[offset, class]``, ``inside[feature, place]``, ``told[feature, memory]``, ``memory``, ``step[label, label]``, ``skip``."""

    def __init__(self, features: dict[str, int]) -> None:
        n = len(features)
        self.features = features
        self.window = np.zeros((2 * _WINDOW + 1, len(_CLASSES), _NL))
        self.inside = np.zeros((n, 5, _NL))
        self.told = np.zeros((n, 4, _NL))
        self.memory = np.zeros((4, _NL))
        self.step = np.zeros((_NL + 1, _NL))  # the last row begins a line
        self.skip = 0.0

    def arrays(self) -> list[np.ndarray]:
        return [self.window, self.inside, self.told, self.memory, self.step]

    def tables(self, rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Summed weights of each combination of features, by place and by memory."""
        a, b = np.zeros((len(rows), 5, _NL)), np.zeros((len(rows), 4, _NL))
        for i, r in enumerate(rows):
            if r:
                a[i], b[i] = self.inside[r].sum(0), self.told[r].sum(0)
        return a, b

    def unary(self, read: Read) -> np.ndarray:
        cls, combo, place, memory = read.arrays()
        e = self.memory[memory].copy()
        pad = np.concatenate([np.zeros(_WINDOW, np.int64), cls, np.zeros(_WINDOW, np.int64)])
        for o in range(2 * _WINDOW + 1):
            e += self.window[o][pad[o : o + len(cls)]]
        a, b = self.tables(read.rows())
        hit = np.flatnonzero(combo)
        e[hit] += a[combo[hit], place[hit]]
        heads = hit[(place[hit] == 1) | (place[hit] == 3)]
        e[heads] += b[combo[heads], memory[heads]]
        # a name is one of the directory: only what the index proposes
        named = np.array([bool(feats) and feats[0] == "name" for feats in read.combos])
        e[~named[combo], _B["person_name"] : _B["person_name"] + 2] = _NEVER
        return e


#: what may follow what: inside a kind only after its begin or inside
_ALLOWED = np.array([[not (t.startswith("I-") and f[2:] != t[2:]) for t in LABELS] for f in (*LABELS, "start")])
_NEVER = -1e3


def _blocks(lines: list[tuple[int, int]], most: int = 60_000) -> Iterator[np.ndarray]:
    """Token numbers of lines of about one length, padded with -1, in blocks of bounded size."""
    order = sorted(lines, key=lambda x: x[1] - x[0])
    i = 0
    while i < len(order):
        n = order[i][1] - order[i][0]
        j = i
        while j < len(order) and order[j][1] - order[j][0] <= n + 2 + n // 8 and (j - i + 1) * (order[j][1] - order[j][0]) <= most or j == i:
            j += 1
        width = max(b - a for a, b in order[i:j])
        idx = np.full((j - i, width), -1, np.int64)
        for r, (a, b) in enumerate(order[i:j]):
            idx[r, : b - a] = np.arange(a, b)
        yield idx
        i = j


def _forward_backward(e: np.ndarray, idx: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log partition of each line, token marginals, and summed marginals of the steps (the last row: line beginnings)."""
    rows, width = idx.shape
    live = idx >= 0
    p = np.where(live[:, :, None], e[np.maximum(idx, 0)], 0.0)
    top = p.max(2, keepdims=True)
    p = np.exp(p - top)
    t = np.exp(np.where(_ALLOWED, step, _NEVER))
    trans, start = t[:-1], t[-1]
    alpha, scale = np.empty((rows, width, _NL)), np.ones((rows, width))
    x = p[:, 0] * start
    for k in range(width):
        if k:
            x = np.where(live[:, k, None], (alpha[:, k - 1] @ trans) * p[:, k], alpha[:, k - 1])
        scale[:, k] = x.sum(1)
        alpha[:, k] = x / scale[:, k, None]
    logz = np.log(scale).sum(1) + np.where(live, top[:, :, 0], 0.0).sum(1)
    beta = np.ones((rows, _NL))
    marg = np.empty((rows, width, _NL))
    steps = np.zeros((_NL + 1, _NL))
    for k in range(width - 1, -1, -1):
        m = alpha[:, k] * beta
        marg[:, k] = m / m.sum(1, keepdims=True)
        if k:
            q = p[:, k] * beta / scale[:, k, None]
            q = np.where(live[:, k, None], q, 0.0)
            steps[:-1] += trans * (alpha[:, k - 1].T @ q)
            beta = np.where(live[:, k, None], q @ trans.T, beta)
    steps[-1] = marg[:, 0].sum(0)
    return logz, marg, steps


def _viterbi(e: np.ndarray, idx: np.ndarray, step: np.ndarray) -> np.ndarray:
    rows, width = idx.shape
    live = idx >= 0
    s = np.where(_ALLOWED, step, _NEVER)
    x = e[np.maximum(idx[:, 0], 0)] + s[-1]
    back = np.zeros((rows, width, _NL), np.int8)
    stay = np.arange(_NL, dtype=np.int8)
    for k in range(1, width):
        y = x[:, :, None] + s[None, :-1]
        arg = y.argmax(1).astype(np.int8)
        new = np.take_along_axis(y, arg[:, None, :].astype(np.int64), 1)[:, 0] + e[np.maximum(idx[:, k], 0)]
        x = np.where(live[:, k, None], new, x)
        back[:, k] = np.where(live[:, k, None], arg, stay)
    out = np.zeros((rows, width), np.int8)
    best = x.argmax(1)
    for k in range(width - 1, -1, -1):
        out[:, k] = best
        best = back[np.arange(rows), k, best]
    return out


#: messages go on until none moves by more than ``_STILL``, halved steps, ``_ROUNDS`` at most; similar surfaces are tied by this part of the weight
_STILL, _ROUNDS, _SIMILAR = 1e-3, 60, 0.25


def _groups(heads: list[tuple[int, tuple, int, bool]]) -> list[tuple[float, list[int]]]:
    """Places of equal and of similar surfaces of one text, as numbers of heads."""
    by: dict[tuple, list[int]] = defaultdict(list)
    like: dict[tuple, list[int]] = defaultdict(list)
    for n, (k, key, _, _) in enumerate(heads):
        by[k, key].append(n)
    for (k, key), ns in by.items():
        like[k, key[1][:5], len(key[1])].append(ns[0])
    return [(1.0, ns) for ns in by.values() if len(ns) > 1] + [(_SIMILAR, ns) for ns in like.values() if len(ns) > 1]


def _skip_messages(e: np.ndarray, read: Read, w: Weights) -> np.ndarray:
    """Unary potentials with what the other places of each surface say: loopy sum-product between chains.

    The places of a surface speak through one variable. Those after a label say one thing together:
    their messages are averaged, and places without a label speak only where no place has one. So a label
    in one place is not outvoted by repeats, however many.
    """
    groups = _groups(read.heads) if w.skip else []
    if not groups:
        return e
    spans = sorted({n for _, ns in groups for n in ns})
    token = np.array([read.heads[n][2] for n in spans])
    at = {n: i for i, n in enumerate(spans)}
    starts = np.array([a for _, a, _ in read.lines])
    mine = sorted({int(np.searchsorted(starts, t, "right") - 1) for t in token})
    blocks = list(_blocks([read.lines[x][1:] for x in mine]))
    base = e
    e = e.copy()
    heads = np.array([_B["phone"], _B["id_number"]])
    message = np.zeros((len(spans), _NL))
    marg = np.zeros_like(e)
    for _ in range(_ROUNDS):
        for idx in blocks:
            _, m, _ = _forward_backward(e, idx, w.step)
            live = idx >= 0
            marg[idx[live]] = m[live]
        own = np.log(np.maximum(marg[token][:, heads], 1e-12))
        rest = np.log(np.maximum(1 - marg[token][:, heads].sum(1), 1e-12))
        # cavity: what a place thinks without what it was told
        own = own - message[:, heads]
        rest = rest - message[:, 0]
        top = np.maximum(own.max(1), rest)
        p = np.exp(np.column_stack([rest, own]) - top[:, None])
        p /= p.sum(1, keepdims=True)
        new = np.zeros_like(message)
        for part, ns in groups:
            ii = np.array([at[n] for n in ns])
            told = np.array([read.heads[n][3] for n in ns])
            speak = told if told.any() else np.ones(len(ns), bool)
            total, count = p[ii[speak]].sum(0), int(speak.sum())
            gain = np.exp(w.skip * part) - 1
            for i, s in zip(ii, speak):
                n = count - int(s)
                if n:
                    q = np.log1p(gain * (total - p[i] * s) / n)
                    new[i] += q[0]
                    new[i, heads] += q[1:] - q[0]
        moved = np.abs(new - message).max()
        message = (new + message) / 2
        e[token] = base[token] + message
        if moved < _STILL:
            break
    return e


def label(read: Read, w: Weights) -> list[tuple[int, int, int, str]]:
    """``(text, begin, end, kind)`` in the folded texts, by the best labelling of every line."""
    if not read.lines:
        return []
    e = _skip_messages(w.unary(read), read, w)
    best = np.zeros(len(read.cls), np.int8)
    for idx in _blocks([x[1:] for x in read.lines]):
        live = idx >= 0
        best[idx[live]] = _viterbi(e, idx, w.step)[live]
    out = []
    for k, a, b in read.lines:
        got = best[a:b]
        i = 0
        hits = np.flatnonzero(got)
        while i < len(hits):
            x = int(hits[i])
            j = i + 1
            while j < len(hits) and hits[j] == hits[j - 1] + 1 and got[hits[j]] == got[x] + 1:
                j += 1
            out.append((k, read.at[a + x][0], read.at[a + int(hits[j - 1])][1], LABELS[got[x]][2:]))
            i = j
    return out


# ---------------------------------------------------------------- fitting


def _gold(parts: list) -> tuple[str, list[tuple[int, int, str]]]:
    text, gold = "", []
    for p in parts:
        if isinstance(p, tuple):
            gold.append((len(text), len(text) + len(p[1]), p[0]))
            p = p[1]
        text += p
    return text, gold


def _sampled(texts: list[tuple[str, list[tuple[int, int, str]]]], features: dict[str, int] | None) -> Read:
    names = Names(frozenset(e for p in PEOPLE for e in name_entries(*p)))
    read = Read(features)
    for k, (text, gold) in enumerate(texts):
        low, at = fold(text)
        if at is not None:  # a folded text of another length: its places are found again
            back = {x: i for i, x in reversed(list(enumerate(at)))}
            gold = [(back[a], back.get(b, len(low)), kind) for a, b, kind in gold]
        read.add(k, text, low, at, candidates(text, low, at, names), gold)
    return read


def _summing(keys: np.ndarray, shape: tuple[int, ...]):  # noqa: ANN202
    """Sums of rows by key; the keys are sorted once."""
    order = np.argsort(keys, kind="stable")
    begin = np.flatnonzero(np.diff(keys[order], prepend=-1))
    at = keys[order][begin]

    def run(d: np.ndarray) -> np.ndarray:
        out = np.zeros((int(np.prod(shape)), d.shape[1]))
        if len(order):
            out[at] = np.add.reduceat(d[order], begin)
        return out.reshape(*shape, d.shape[1])

    return run


@lru_cache(maxsize=1)
def weights(n: int = SAMPLES) -> Weights:
    """Weights of the largest conditional likelihood (ridge), and the best weight of the skip edges."""
    read = _sampled([_gold(p) for p in samples(n)], None)
    rows = read.rows()
    w = Weights(read.known)
    gold = np.array(read.gold)
    cls, combo, place, memory = read.arrays()
    pad = np.concatenate([np.zeros(_WINDOW, np.int64), cls, np.zeros(_WINDOW, np.int64)])
    blocks = list(_blocks([x[1:] for x in read.lines]))
    hot = np.eye(_NL)[gold]
    before = np.full(len(gold), _NL)
    seen = np.zeros(len(gold), bool)
    for _, a, b in read.lines:
        before[a + 1 : b] = gold[a : b - 1]
        seen[a:b] = True
    wanted = np.zeros((_NL + 1, _NL))
    np.add.at(wanted, (before[seen], gold[seen]), 1)
    pairs = [(i, f) for i, r in enumerate(rows) for f in r]
    pi, pf = (np.array(x) for x in zip(*pairs))
    head = np.flatnonzero((place == 1) | (place == 3))
    per_class = [_summing(pad[o : o + len(cls)], (len(_CLASSES),)) for o in range(2 * _WINDOW + 1)]
    per_place, per_told = _summing(combo * 5 + place, (len(rows), 5)), _summing(combo[head] * 4 + memory[head], (len(rows), 4))
    per_memory, per_feature = _summing(memory, (4,)), _summing(pf, (len(read.known),))
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in w.arrays()]
    for it in range(1, 121):
        e = w.unary(read)
        marg, steps = np.zeros_like(e), np.zeros((_NL + 1, _NL))
        for idx in blocks:
            _, m, st = _forward_backward(e, idx, w.step)
            live = idx >= 0
            marg[idx[live]] = m[live]
            steps += st
        d = np.where(seen[:, None], hot - marg, 0.0)
        grads = [np.zeros_like(x) for x in w.arrays()]
        for o, per in enumerate(per_class):
            grads[0][o] = per(d)
        by_place, by_memory = per_place(d), per_told(d[head])
        grads[1] = per_feature(by_place[pi].reshape(len(pi), -1)).reshape(-1, 5, _NL)
        grads[2] = per_feature(by_memory[pi].reshape(len(pi), -1)).reshape(-1, 4, _NL)
        grads[3] = per_memory(d)
        grads[4] = np.where(_ALLOWED, wanted - steps, 0.0)
        rate = 0.15 * (1 - it / 160)
        for x, g, st in zip(w.arrays(), grads, state):
            g = g - 0.1 * x
            st[0] = 0.9 * st[0] + 0.1 * g
            st[1] = 0.99 * st[1] + 0.01 * g * g
            x += rate * (st[0] / (1 - 0.9**it)) / (np.sqrt(st[1] / (1 - 0.99**it)) + 1e-6)
    # the weight of the skip edges: repeats of a labelled number are likeliest
    texts = []
    for lines in repeated(200):
        text, gold_ = "", []
        for parts in lines:
            t, g = _gold(parts)
            gold_ += [(a + len(text), b + len(text), k) for a, b, k in g]
            text += t + "\n"
        texts.append((text, gold_))
    again = _sampled(texts, w.features)
    truth = np.array(again.gold)
    unary = w.unary(again)
    best = (-np.inf, 0.0)
    token = [t for _, _, t, _ in again.heads]
    for skip in (0.0, 1.0, 2.0, 3.0, 4.0, 6.0, 8.0):
        w.skip = skip
        e = _skip_messages(unary, again, w)
        marg = np.zeros_like(e)
        for idx in _blocks([x[1:] for x in again.lines]):
            live = idx >= 0
            marg[idx[live]] = _forward_backward(e, idx, w.step)[1][live]
        fit = float(np.log(np.maximum(marg[token, truth[token]], 1e-9)).sum())
        best = max(best, (fit, skip))
    w.skip = best[1]
    return w


# ---------------------------------------------------------------- use


def find_all(texts: list[str | None], names: Names, w: Weights) -> list[list[tuple[str, int, int]]]:
    """For each text ``(kind, begin, end)`` in order of place."""
    read = Read(w.features)
    forms: dict[int, tuple[str, list[int] | None]] = {}
    for k, text in enumerate(texts):
        if not text:
            continue
        low, at = fold(text)
        spans = candidates(text, low, at, names)
        if spans:
            forms[k] = low, at
            read.add(k, text, low, at, spans)
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for k, a, b, kind in label(read, w):
        _, at = forms[k]
        begin = a if at is None else at[a]
        out[k].append((kind, begin, begin + len(_cut(texts[k], at, a, b))))
    return out


def find(text: str, names: Names) -> list[tuple[str, int, int]]:
    """``(kind, begin, end)`` in ``text``, in order of place."""
    return find_all([text], names, weights())[0]


def _replaced(text: str, found: list[tuple[str, int, int]]) -> str:
    parts, last = [], 0
    for kind, a, b in found:
        parts += [text[last:a], f"[{kind.upper()}]"]
        last = b
    return "".join(parts) + text[last:]


def redact(text: str, names: Names) -> str:
    """``text`` with typed placeholders, the rest unchanged."""
    return _replaced(text, find(text, names))


# ---------------------------------------------------------------- operators

_SLICE = 512


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, _SLICE):
            yield b.slice(lo, _SLICE)


def personal_spans(df: DataFrame, directory: DataFrame, key: str = "row_idx", text: str = "cleaned_body") -> DataFrame:
    """``(key, kind, surface)``, each different surface of a row once."""
    share_look_alikes(df.sparkSession)
    people, w = field(directory, name_entries), weights()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names(people)
        for b in _slices(batches):
            texts = b.column(1).to_pylist()
            got = {(i, kind, t[x:y]): None for i, t, found in zip(b.column(0).to_pylist(), texts, find_all(texts, names, w), strict=True) for kind, x, y in found}
            cols = list(zip(*got, strict=True)) if got else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())], names=["key", "kind", "surface"])

    rows = df.where(F.col(text).isNotNull() & (F.length(text) > 0)).select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "key long, kind string, surface string").withColumnRenamed("key", key)


def redacted(df: DataFrame, directory: DataFrame, key: str = "row_idx", text: str = "cleaned_body", out: str = "redacted_body") -> DataFrame:
    """``(key, out)`` for every row; a null text stays null."""
    share_look_alikes(df.sparkSession)
    people, w = field(directory, name_entries), weights()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names(people)
        for b in _slices(batches):
            texts = b.column(1).to_pylist()
            done = [t and _replaced(t, found) for t, found in zip(texts, find_all(texts, names, w), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(done, pa.string())], names=["key", "t"])

    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "key long, t string").select(F.col("key").alias(key), F.col("t").alias(out))
