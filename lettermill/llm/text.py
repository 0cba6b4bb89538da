"""Character forms shared by the text operators: skeletons, visible line text."""

from __future__ import annotations

import html
import json
import os
import re
import string
import tempfile
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import SparkSession

# fixed values: letters of other scripts that look like a Latin letter, and that letter; ``share_look_alikes`` adds those of the public confusables data
LOOKALIKES: dict[str, str] = dict(
    zip(
        "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοϲϳАВЕКМНОРСТХЅІЈԚԜԌҮаеорсухѕіјһԁԛԝɡ",
        "ABEZHIKMNOPTYXocjABEKMHOPCTXSIJQWGYaeopcyxsijhdqwg",
        strict=True,
    )
)
#: characters without shape that are not in category Cf
SHAPELESS = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}
HYPHENS = {0x2010, 0x2011, 0xFE63, 0xFF0D}
LINE_ENDS = {0x2028, 0x2029, 0x0085}
#: compatibility forms that change only width, joining or position of a letter
_FORMS = ("<wide>", "<narrow>", "<initial>", "<medial>", "<final>", "<isolated>")


#: scripts whose letters are compared with Latin ones, and families of Latin letters in another style
_SCRIPTS = ("GREEK", "CYRILLIC", "ARMENIAN", "CHEROKEE", "COPTIC", "LISU", "MATHEMATICAL", "DOUBLE-STRUCK", "SCRIPT", "BLACK-LETTER", "PLANCK", "KELVIN", "ROMAN", "SMALL ROMAN", "LATIN LETTER SMALL CAPITAL", "LATIN SMALL LETTER ALPHA")
_FILE = "lettermill-look-alikes.json"
_shared: set[str] = set()


def look_alikes(spark: SparkSession) -> dict[str, str]:
    """Letters that have the skeleton of one ASCII letter in the confusables data of the ICU library on Spark's class path.

    Capitals take the capital where two letters share a skeleton (I and l). Letters of the Latin script
    itself, such as the dotless i, stay what they are.
    """
    checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    plain = string.ascii_uppercase + string.ascii_lowercase
    odd = [ch for ch in map(chr, range(0x80, 0x20000)) if unicodedata.category(ch)[0] in "LN" and unicodedata.name(ch, "").startswith(_SCRIPTS) and not ch.isdigit()]
    # one call: a line end is its own skeleton, so it parts the letters
    got = checker.getSkeleton("\n".join([*plain, *odd])).split("\n")
    of: dict[str, list[str]] = {}
    for ch, k in zip(plain, got):
        of.setdefault(k, []).append(ch)
    pick = lambda ch, same: same[-1] if "SMALL" in unicodedata.name(ch) else same[0]
    return {ch: pick(ch, of[k]) for ch, k in zip(odd, got[len(plain) :], strict=True) if k in of}


def share_look_alikes(spark: SparkSession) -> None:
    """Gives this process and the workers the larger table, once an application.

    Without the library letters would be compared by the short fixed table and pairs be missed, so that
    is an error; so is a worker without the table.
    """
    app = spark.sparkContext.applicationId
    if app in _shared:
        return
    try:
        more = look_alikes(spark)
    except TypeError as e:  # no such class
        raise RuntimeError("the confusables data are missing: put the ICU library (com.ibm.icu:icu4j) on Spark's class path") from e
    LOOKALIKES.update({k: v for k, v in more.items() if k not in LOOKALIKES})
    PROTOTYPES.clear()
    path = os.path.join(tempfile.mkdtemp(prefix="lettermill-"), _FILE)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(LOOKALIKES, f)
    spark.sparkContext.addFile(path)
    _shared.add(app)


class _Prototypes(dict):
    """Code point to prototype, worked out at first use of a character."""

    read = False

    def _read(self) -> None:
        """In a worker: the table that the driver sent. The driver has it already."""
        if SparkFiles._is_running_on_worker:
            try:
                with open(SparkFiles.get(_FILE), encoding="utf-8") as f:
                    LOOKALIKES.update(json.load(f))
            except OSError as e:
                raise RuntimeError("this worker has no table of look-alike letters: call share_look_alikes before the query") from e
        self.read = True

    def __missing__(self, cp: int) -> str | None:
        if not self.read:
            self._read()
        ch = chr(cp)
        out: str | None = ch
        if cp in LINE_ENDS:
            out = "\n"
        elif cp in HYPHENS:
            out = "-"
        elif cp in SHAPELESS or unicodedata.category(ch) == "Cf":
            out = None
        elif cp == 9 or unicodedata.category(ch) == "Zs":
            out = " "
        elif cp > 127:
            form = unicodedata.decomposition(ch).split(" ")
            joined = form[0] == "<compat>" and len(form) > 2 and unicodedata.category(ch)[0] == "L"
            if ch in LOOKALIKES:
                out = LOOKALIKES[ch]
            elif form[0] in _FORMS or joined:
                out = "".join(self[ord(x)] or "" for x in unicodedata.normalize("NFKD", ch))
        self[cp] = out
        return out


PROTOTYPES = _Prototypes()
_LINE_TAIL = re.compile(r"[ \r]+(?=\n)|[ \r\n]+\Z")


def skeleton(text: str) -> str:
    """Decompose, replace every character by its prototype, decompose again.

    Blanks at the end of a line and lines without text at the end of the body
    show nothing and are left out.
    """
    if text.isascii():
        if "\t" in text:
            text = text.replace("\t", " ")
    else:
        text = unicodedata.normalize("NFD", unicodedata.normalize("NFD", text).translate(PROTOTYPES))
    return _LINE_TAIL.sub("", text)


_TAG = re.compile(r"<!--.*?-->|</?[A-Za-z][^<>]*>|<![A-Za-z][^<>]*>", re.S)
#: what ``\s`` matches
_SPACE = "".join(filter(str.isspace, map(chr, range(0x3001))))
_PLAIN_SPACE = "".join(filter(str.isascii, _SPACE))
_BLANKS = rf"[{_PLAIN_SPACE}]{{2,}}|[{_PLAIN_SPACE.replace(' ', '')}]"


def strip_tags(line: str) -> str:
    """Without tags, with entities resolved. ``<name@host>`` is an address and stays."""
    if "<" in line:
        line = _TAG.sub(lambda m: m.group(0) if "@" in m.group(0) and "=" not in m.group(0) else " ", line)
    if "&" in line:
        line = html.unescape(line)
    return line


def visible_line(line: str) -> str:
    """What a reader sees of one line: no tags or leading quote marks, entities resolved, one case, single blanks, one form of each character."""
    line = strip_tags(line)
    if not line.isascii():
        line = unicodedata.normalize("NFC", unicodedata.normalize("NFD", line).translate(PROTOTYPES))
    return " ".join(line.lstrip(_SPACE + ">|").split()).casefold()


def visible_lines(lines: pa.StringArray) -> pa.StringArray:
    """``visible_line`` of each, without nulls; ASCII lines become Python strings only if they have an entity or an address among tags."""
    tagged = pc.match_substring(lines, "<")
    odd = pc.or_(pc.or_(pc.invert(pc.string_is_ascii(lines)), pc.match_substring(lines, "&")), pc.and_(tagged, pc.match_substring(lines, "@")))
    tagged = pc.and_not(tagged, odd)
    at = [np.flatnonzero(x.to_numpy(zero_copy_only=False)) for x in (odd, tagged, pc.invert(pc.or_(odd, tagged)))]
    plain = pa.concat_arrays([pc.replace_substring_regex(lines.take(pa.array(at[1])), "(?s)" + _TAG.pattern, " "), lines.take(pa.array(at[2]))])
    plain = pc.ascii_rtrim(pc.ascii_ltrim(plain, _PLAIN_SPACE + ">|"), _PLAIN_SPACE)
    plain = pc.ascii_lower(pc.replace_substring_regex(plain, _BLANKS, " "))
    both = pa.concat_arrays([pa.array(map(visible_line, lines.take(pa.array(at[0])).to_pylist()), pa.string()), plain])
    return both.take(pa.array(np.argsort(np.concatenate(at))))
