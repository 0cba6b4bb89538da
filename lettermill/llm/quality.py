"""Problem 10: text quality statistics of a document, and lists, tables and junk told from prose.

Method: tables and lists are found from the vertical alignment of delimiters,
from the periodicity of indentation, markers and keys, and from the
autocorrelation of line lengths; junk from word, symbol and punctuation ratios. The decision
reads the statistics only, so it can be repeated from the table of them.

Defined results: null, empty and blank texts have zero counts, ratio 0.0 and
kind ``prose``. Whole texts are read, whatever their length.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Container, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.names import field
from lettermill.llm.text import share_look_alikes, skeleton

STATS = (
    "n_chars", "n_words", "n_lines", "mean_word_length", "symbol_ratio", "digit_ratio", "upper_ratio", "common_share",
    "end_punct_share", "bullet_share", "short_line_share", "column_share", "column_count", "line_autocorrelation", "indent_period",
    "repeat_share", "top_word_share", "sentence_count", "odd_token_share", "mid_punct_share", "strange_char_share", "structure_share",
    "long_token_share", "same_start_share", "prose_line_share", "period_share", "comma_end_share",
)
COUNTS = {"n_chars", "n_words", "n_lines", "column_count", "indent_period", "sentence_count"}
_WORD = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*")
_BULLET = re.compile(r"^\s*(?:[-*+•·‣◦–—o]{1,2}\s+|#|\(?\d{1,3}[.):]\s+|\(?\d{1,3}\)|\(?[A-Za-z][.)]\s+|\[[ xX]?\]\s*|[☐☑✓✔►▪■]\s*)\S")
_SENTENCE = re.compile(r"[^\W\d_]{2}[\"”»)]*[.!?]+[\"”»)]*(?=\s|$)")
_HEX = re.compile(r"^(?:[0-9a-f]{2}|[0-9A-F]{2})$")
_BASE64 = re.compile(r"[A-Za-z0-9+/=_\-]{25,}")
_MIDPUNCT = re.compile(r"[^\W\d_][,;.!?:][^\W\d_]")
_GAP = re.compile(r" {2,}|\t")
#: indentation with a marker, a number or the key of a value
_BEGIN = re.compile(r"\s*(?:[^\w\s]+|\d+[.):]?|[^\W\d_][\w \-]{0,30}:(?=\s|$))?")
_DIGITS = re.compile(r"\d+")
_KEY = re.compile(r"[^\W\d_][\w \-]*:")
_SPACE = re.compile(r"\s")
#: leftovers of a wrong decoding, arrows and drawing characters
_STRANGE = re.compile(r"[¢-©¬®¯±´-¶¸¼-¾×÷ÂÃâï€œ™\u2190-\u2BFF\uFFFD\x00-\x08\x0b\x0c\x0e-\x1f]")


def _typed(rows: list[list[str]]) -> tuple[float, bool]:
    """Share of cells that are of the usual type of their column (number, words, nothing), and whether a column is of numbers."""
    fit, cells, numbers = 0, 0, False
    for column in zip(*rows):
        kinds = Counter("" if not (c := cell.strip()) else "9" if any(map(str.isdigit, c)) else "w" for cell in column)
        kind, n = kinds.most_common(1)[0]
        fit += n
        cells += len(column)
        numbers = numbers or (kind == "9" and len(column) > 1)
    return fit / cells, numbers


def _columns(lines: list[str]) -> tuple[float, int]:
    """Vertical alignment: the share of lines that are cut into the same columns, by the share of cells that fit their column, and the columns; the best delimiter counts.

    One line has nothing to align with.
    """
    best = (0.0, 0)
    n = len(lines)
    if n < 2:
        return best
    for delim in ("|", "\t", ";", ","):
        got = [ln.count(delim) for ln in lines]
        k, m = Counter(got).most_common(1)[0]
        if k == 0:
            continue
        rows = [ln.split(delim) for ln, g in zip(lines, got) if g == k]
        fit, numbers = _typed(rows)
        if delim in ",;":
            # in prose a comma is followed by a small word: cells are short and few words long; two columns of words are a list with a remark
            cells = [len(c.split()) for r in rows for c in r]
            if sum(c <= 3 for c in cells) < 0.9 * len(cells) or not (k > 1 or numbers):
                continue
        best = max(best, (m / n * max(fit, 0.8), k + 1))
    # blanks as delimiter: columns begin at the same places
    starts: Counter = Counter()
    for ln in lines:
        starts.update({m.end() for m in _GAP.finditer(ln.rstrip()) if m.start()})  # indentation begins no column
    common = [p for p, c in starts.items() if c >= 0.6 * n and c > 1]
    if common:
        aligned = sum(any(ln[p - 2 : p].isspace() and ln[p : p + 1].strip() for p in common) for ln in lines)
        best = max(best, (aligned / n, len(common) + 1))
    return best


def _autocorrelation(lengths: list[int], alike: float = 0.05) -> float:
    """Of line lengths, at the lag up to a third of the lines where it is highest; 1.0 where all differ from the mean by about ``alike`` of it at most."""
    n = len(lengths)
    if n < 3:
        return 0.0
    x = np.array(lengths, float)
    x -= (mean := x.mean())
    var = float(x @ x)
    if var <= n * (alike * mean) ** 2:
        return 1.0
    return float(_lags(x)[1 : n // 3 + 1].max() / var)


def _lags(x: np.ndarray) -> np.ndarray:
    """Sums of the products of ``x`` with itself at every distance."""
    f = np.fft.rfft(x, 2 * len(x))
    return np.fft.irfft(f * f.conj(), 2 * len(x))[: len(x)]


def _period(lines: list[str]) -> tuple[int, float]:
    """The smallest period up to a third of the lines at which most beginnings (indentation, marker, key) repeat, and the share of lines whose own beginning repeats; (0, 0.0) without one."""
    n = len(lines)
    kinds = [_KEY.sub("key:", _DIGITS.sub("9", _BEGIN.match(ln).group(0))) for ln in lines]
    if n < 2 or not any(kinds):
        return 0, 0.0
    places: dict[str, list[int]] = {}
    for i, k in enumerate(kinds):
        places.setdefault(k, []).append(i)
    equal = np.zeros(n)
    marked = np.zeros(n)
    for kind, at in places.items():
        if len(at) ** 2 <= 4 * n:
            away = np.subtract.outer(at, at)
            got = np.bincount(away[away > 0], minlength=n).astype(float)
        else:
            x = np.zeros(n)
            x[at] = 1
            got = np.rint(_lags(x))
        equal += got
        if kind:
            marked += got
    top = max(1, n // 3)
    pairs = n - np.arange(1, top + 1)
    good = (equal[1 : top + 1] >= 0.7 * pairs) & (marked[1 : top + 1] >= 0.25 * pairs)
    if not good.any():
        return 0, 0.0
    p = int(good.argmax())
    return p + 1, float(marked[p + 1] / pairs[p])


class CommonWords(dict):
    """Word to the languages in which it is common; kept (bounded)."""

    def __init__(self, langs: Iterable[str], entries: Container[str]) -> None:
        self.langs, self.entries = tuple(langs), entries

    def __missing__(self, w: str) -> tuple[str, ...]:
        if len(self) > 200_000:
            self.clear()
        got = self[w] = tuple(x for x in self.langs if f"{x}:{w}" in self.entries)
        return got


def word_entries(lang: str | None, word: str | None) -> Iterable[str]:
    return (f"{lang}:{word.lower()}",) if lang is not None and word is not None else ()


def statistics(text: str | None, common: CommonWords) -> dict[str, float]:
    s: dict[str, float] = dict.fromkeys(STATS, 0.0)
    if text is None:
        return s
    s["n_chars"] = len(text)
    if not text.isascii():
        # forms, odd blanks and characters without shape say nothing about the kind
        text = unicodedata.normalize("NFC", skeleton(text))
    lines = [ln.rstrip("\r") for ln in text.split("\n")]
    lines = [ln for ln in lines if ln.strip()]
    if not lines:
        return s
    words = _WORD.findall(text)
    low = [w.lower() for w in words]
    tokens = text.split()
    n, nw, nt = len(lines), len(words), len(tokens)
    ns = len(text) - len(_SPACE.findall(text))
    letters = sum(map(str.isalpha, text))
    s["n_words"], s["n_lines"] = nw, n
    s["mean_word_length"] = sum(map(len, words)) / nw if nw else 0.0
    s["symbol_ratio"] = (ns - sum(map(str.isalnum, text))) / ns
    s["digit_ratio"] = sum(map(str.isdigit, text)) / ns
    s["upper_ratio"] = sum(map(str.isupper, text)) / letters if letters else 0.0
    if nw:
        # a wrong or missing lang must not hurt: the best of the languages counts
        s["common_share"] = max(Counter(chain.from_iterable(map(common.__getitem__, low))).values(), default=0) / nw
        counts = Counter(low)
        s["top_word_share"] = counts.most_common(1)[0][1] / nw
        s["repeat_share"] = 1 - len(counts) / nw
    s["end_punct_share"] = sum(ln.rstrip().endswith((".", "!", "?", ":", "…", '."', "。")) for ln in lines) / n
    s["bullet_share"] = sum(bool(_BULLET.match(ln)) for ln in lines) / n
    s["short_line_share"] = sum(len(ln.split()) <= 6 for ln in lines) / n
    s["column_share"], s["column_count"] = _columns(lines)
    items = [ln for ln in lines if not ln.rstrip().endswith(":")]  # a heading is no entry
    s["line_autocorrelation"] = max(_autocorrelation([len(ln) for ln in items]), _autocorrelation([len(ln.split()) for ln in items], 0.15))
    s["indent_period"], s["period_share"] = _period(lines)
    s["sentence_count"] = len(_SENTENCE.findall(text))
    s["odd_token_share"] = sum(len(t) if _HEX.match(t) or (_BASE64.fullmatch(t) and not t.isalpha()) else 0 for t in tokens) / ns
    s["long_token_share"] = sum(len(t) for t in tokens if len(t) >= 25 and t.isalpha()) / ns
    s["mid_punct_share"] = len(_MIDPUNCT.findall(text)) / nt
    s["strange_char_share"] = len(_STRANGE.findall(text)) / ns
    s["structure_share"] = sum(ln.lstrip()[:1] in "{[<" and ln.rstrip()[-1:] in "}]>," for ln in lines) / n
    s["prose_line_share"] = sum(len(ln) for ln in lines if len(ln.split()) >= 5 and ln.rstrip()[-1:] in ".!?…:,") / sum(map(len, lines))
    s["comma_end_share"] = sum(ln.rstrip().endswith(",") for ln in lines) / n
    first = Counter(ln.split()[0].lower() for ln in lines)
    s["same_start_share"] = first.most_common(1)[0][1] / n
    return s


def regularity(s: dict[str, float]) -> float:
    """How much the lines look like entries: repeated beginnings, repeated or equal line lengths, few words a line, few common words; some lines with a comma at the end look like a letter."""
    repeats = s["period_share"] if s["indent_period"] else 0.0
    letter = s["comma_end_share"] if s["comma_end_share"] < 0.8 else 0.0
    return 1.2 * repeats + 0.6 * max(0.0, s["line_autocorrelation"]) + 0.5 * s["short_line_share"] + 0.6 * max(0.0, 1 - s["common_share"] / 0.35) - letter


def kind(s: dict[str, float]) -> str:
    """prose, list, table or junk, from the statistics.

    Structure needs two lines; besides that no size decides.
    """
    if not s["n_lines"]:
        return "prose"
    if s["odd_token_share"] > 0.5 or s["long_token_share"] > 0.5 or s["strange_char_share"] > 0.08:
        return "junk"
    if s["structure_share"] > 0.6 and s["symbol_ratio"] > 0.2:
        return "junk"
    repeats = s["period_share"] if s["indent_period"] else 0.0
    if s["column_count"] >= 2 and s["column_share"] >= 0.6 and s["prose_line_share"] < 0.3 and (repeats < 0.8 or s["digit_ratio"] >= 0.25):
        return "table"
    if s["symbol_ratio"] > 0.5:
        return "junk"
    if s["n_words"] >= 8 and s["top_word_share"] > 0.4 and repeats < 0.6:
        return "junk"
    if s["common_share"] < 0.1 and s["mid_punct_share"] > (0.12 if s["common_share"] > 0.03 else 0.04):
        return "junk"
    if s["n_lines"] >= 2 and s["sentence_count"] <= 0.15 * s["n_lines"] and s["prose_line_share"] < 0.2 and regularity(s) >= 1.0:
        # rows without a delimiter are of numbers
        return "table" if s["digit_ratio"] >= 0.25 and repeats < 0.6 else "list"
    if s["n_words"] >= 12 and s["common_share"] < 0.02 and s["sentence_count"] == 0:
        return "junk"
    return "prose"


def text_statistics(df: DataFrame, common_words: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, <statistics>, kind)`` for every row.

    ``common_words`` is a word list by language, of any size (``llm/names.py``).
    """
    share_look_alikes(df.sparkSession)
    langs = [r[0] for r in common_words.where("lang is not null").select("lang").distinct().collect()]  # a handful of names
    entries = field(common_words, word_entries, "lang", "word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = CommonWords(langs, entries)
        for b in batches:
            got = [statistics(t, common) for t in b.column(1).to_pylist()]
            cols = [pa.array([int(s[k]) for s in got], pa.int64()) if k in COUNTS else pa.array([round(float(s[k]), 6) for s in got], pa.float64()) for k in STATS]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols, pa.array([kind(s) for s in got], pa.string())], names=["key", *STATS, "kind"])

    of = df.schema[key].dataType.simpleString()
    shape = ", ".join(f"{k} {'long' if k in COUNTS else 'double'}" for k in STATS)
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {of}, {shape}, kind string").withColumnRenamed("key", key)
