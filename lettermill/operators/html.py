"""HTML to Markdown-like text, Unicode repair and escape literals: the steps that need Python.

One Arrow function serves a batch; a text without tags skips the parser. The
parser is the standard library's; the visible text, line breaks, links and list
marks follow the usual conventions of Markdown renderers.
"""

from __future__ import annotations

import re
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: class tokens of quotes and signatures by mail program
QUOTE_CLASSES = frozenset(
    "gmail_quote gmail_quote_container gmail_ad_hoc_content gmail_ad_hoc_v2_content gmail_chip yahoo_quoted OutlookMessageHeader "
    "AppleOriginalContents moz-cite-prefix protonmail_quote quoted-text email-quoted-reply".split()
)
SIGNATURE_CLASSES = frozenset(
    "gmail_signature gmail_signature_prefix Signature OutlookSignature AppleMailSignature protonmail_signature_block signature sig email-signature email_signature".split()
)
_SKIP = frozenset(("script", "style", "head", "noscript"))
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset("p div ul ol table blockquote h1 h2 h3 h4 h5 h6 pre section article header footer address form fieldset dl dd dt center".split())
_IS_HTML = re.compile(r"<(?:html|body|div|p|br|span|table|a)\b", re.I)


class _Renderer(HTMLParser):
    def __init__(self, keep_history: bool) -> None:
        super().__init__(convert_charrefs=True)
        self.drop = SIGNATURE_CLASSES if keep_history else SIGNATURE_CLASSES | QUOTE_CLASSES
        self.quotes = not keep_history
        self.out: list[str] = []
        self.stack: list[tuple[str, bool]] = []
        self.dead = 0
        self.links: list[str] = []
        self.depth = 0
        self.lists: list[int | None] = []
        self.pre = 0
        self.cells: list[list[int]] = []  # of each open table: rows done, cells of the row

    def _gone(self, tag: str, attrs: dict[str, str | None]) -> bool:
        return tag in _SKIP or (self.quotes and tag == "blockquote") or bool(self.drop & set((attrs.get("class") or "").split()))

    def _break(self, n: int) -> None:
        have = 0
        for s in reversed(self.out):
            if s.strip("\n"):
                break
            have += len(s)
        if self.out and have < n:
            self.out.append("\n" * (n - have))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = dict(attrs)
        if tag in _VOID:
            if not self.dead:
                if tag == "br":
                    self.out.append("  \n" if self.out and self.out[-1].strip() else "\n")
                elif tag == "hr":
                    self._break(2)
                    self.out.append("* * *")
                    self._break(2)
            return
        gone = self._gone(tag, a)
        self.stack.append((tag, gone))
        if gone:
            self.dead += 1
        if self.dead:
            return
        if tag == "a":
            href = (a.get("href") or "").strip()
            self.links.append("" if href.startswith("#") else href)
            if self.links[-1]:
                self.out.append("[")
        elif tag in ("ul", "ol"):
            self._break(2 if not self.lists else 1)
            self.lists.append(1 if tag == "ol" else None)
        elif tag == "li":
            self._break(1)
            indent = "  " * len(self.lists)
            if self.lists and self.lists[-1] is not None:
                self.out.append(f"{indent}{self.lists[-1]}. ")
                self.lists[-1] += 1
            else:
                self.out.append(f"{indent}- ")
        elif tag == "tr":
            self._break(1)
            if self.cells:
                self.cells[-1][1] = 0
        elif tag in ("td", "th"):
            if self.out and not self.out[-1].endswith("\n"):
                self.out.append("| ")
            if self.cells:
                self.cells[-1][1] += 1
        elif tag == "blockquote":
            self._break(2)
            self.depth += 1
        elif tag == "div":
            self._break(1)
        elif tag in _BLOCK:
            self._break(2)
            if tag == "pre":
                self.pre += 1
            elif tag == "table":
                self.cells.append([0, 0])
            if re.fullmatch(r"h[1-6]", tag):
                self.out.append("#" * int(tag[1]) + " ")

    def handle_endtag(self, tag: str) -> None:
        at = next((i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == tag), None)
        if at is None:
            return
        while len(self.stack) > at:
            name, gone = self.stack.pop()
            if gone:
                self.dead -= 1
            elif not self.dead:
                self._close(name)

    def _close(self, tag: str) -> None:
        if tag == "a" and self.links:
            href = self.links.pop()
            if href:
                self.out.append(f"]({href})")
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
            self._break(2 if not self.lists else 1)
        elif tag == "blockquote":
            self.depth = max(0, self.depth - 1)
            self._break(2)
        elif tag == "tr":
            self._break(1)
            if self.cells:
                rows, cells = self.cells[-1]
                if rows == 0 and cells > 1:  # the first row is the heading
                    self.out.append("|".join(["---"] * cells))
                    self._break(1)
                self.cells[-1][0] += 1
        elif tag in ("div", "li"):
            self._break(1)
        elif tag in _BLOCK:
            if tag == "pre":
                self.pre = max(0, self.pre - 1)
            elif tag == "table" and self.cells:
                self.cells.pop()
            self._break(2)

    def handle_data(self, data: str) -> None:
        if self.dead:
            return
        if self.pre:
            self.out.append(data.replace("\r\n", "\n"))
            return
        text = re.sub(r"[ \t\r\n]+", " ", data)
        if not self.out or self.out[-1].endswith("\n"):
            text = text.lstrip(" ")
        if not text:
            return
        if (not self.out or self.out[-1].endswith("\n")) and re.match(r"--(?=\s*$)|--(?= )", text):
            text = "\\" + text
        if self.depth and (not self.out or self.out[-1].endswith("\n")):
            text = "> " * self.depth + text
        self.out.append(text)


def html_to_text(raw: str, keep_history: bool = True) -> str:
    r = _Renderer(keep_history)
    r.feed(re.sub(r"<!--.*?-->", "", raw, flags=re.S))
    r.close()
    return "".join(r.out)


# fixed values: single characters and their plain forms
PLAIN = {
    " ": " ", " ": " ", "​": "", "‌": "", "‍": "", "﻿": "", "’": "'", "‘": "'",
    "“": '"', "”": '"', "–": "-", "—": "--", "…": "...", "·": "-",
}
_TABLE = str.maketrans(PLAIN)
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
_ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})")


def plain_unicode(text: str) -> str:
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.translate(_TABLE))
    return _CONTROL.sub("", text)


def _decoded(m: re.Match) -> str:
    code = int(m.group(1), 16)
    return " " if 0xD800 <= code <= 0xDFFF or code < 0x20 else chr(code)


def without_escapes(text: str) -> str:
    """Literal ``\\r\\n``, ``\\r``, ``\\n`` become a blank, literal ``\\uXXXX`` its character."""
    if "\\" not in text:
        return text
    for lit in ("\\r\\n", "\\r", "\\n"):
        text = text.replace(lit, " ")
    return _ESCAPE.sub(_decoded, text)


def readable_text(t: str | None, keep_history: bool) -> str:
    """HTML rendered, characters repaired, escape literals resolved; blank and null give an empty text."""
    if t is None or not t.strip():
        return ""
    if "<" in t and _IS_HTML.search(t):
        t = html_to_text(t, keep_history)
    return without_escapes(plain_unicode(t))


def readable(text: Column, keep_history: bool) -> Column:
    """``readable_text`` of a column."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: readable_text(t, keep_history))

    return run(text)
