"""Line operators of the cleaner: ``Column -> Column`` over arrays of lines, inside the JVM.

A text is split at newlines into an array; order is the array's order, so no
shuffle or sort is needed. Runs with a memory (disclaimers, signatures, header
blocks) are patterns over one letter a line; windows around a line (inline
signatures) are read by position. Null texts stay null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lettermill import rx


def strip(c: Column, chars: str = rx.WS) -> Column:
    return F.regexp_replace(c, f"^[{chars}]+|[{chars}]+$", "")


def has(c: Column, pattern: str, cased: bool = False) -> Column:
    return c.rlike("(?d)" + pattern if cased else rx.ci(pattern))


def let(value: Column, body) -> Column:  # noqa: ANN001
    """``body(value)`` with ``value`` evaluated once a row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def join_lines(lines: Column) -> Column:
    return F.array_join(lines, "\n")


def checked(line: Column) -> Column:
    """A line without its quote marks and without emphasis around it."""
    return strip(F.regexp_replace(line, f"^[{rx.WS}>]*", ""), r">*_ \t\n\r")


def is_contact(line: Column) -> Column:
    s = F.regexp_replace(strip(line), r"^\*{1,2}|\*{1,2}$", "")
    s = strip(F.regexp_replace(s, "^_{1,2}|_{1,2}$", ""))
    return let(s, lambda t: (t != "") & (has(t, rx.CONTACT_CASED, cased=True) | has(t, rx.CONTACT)))


def is_header(line: Column) -> Column:
    return has(strip(line), rx.HEADER_LINE)


def drop_header_lines(lines: Column) -> Column:
    """Lines without the header lines."""
    return F.filter(lines, lambda x: ~is_header(x))


def is_signature_part(line: Column) -> Column:
    """Whether a line may stand in a signature: contact, name of up to four words, team, separator, bold text, ``Name | Company``."""
    name = r"^\p{Lu}[\p{L}'.\-]*(?: \p{Lu}[\p{L}'.\-]*){0,3}$"
    return let(
        strip(line),
        lambda s: (s != "")
        & (is_contact(s) | s.rlike(name) | has(s, rf"^{rx.W}{rx.A}{{0,40}}{rx.S}team$") | s.rlike(r"^[-_=*~|]{2,}$") | s.rlike(r"^\*\*[^*]+\*\*$") | s.rlike(r"^\p{Lu}[^|\n]*\|[^|\n]+$")),
    )


def cut_reply_chain(lines: Column) -> Column:
    """Everything before the first line that opens a reply chain."""
    return _before_first(lines, lambda x: has(strip(x), rx.REPLY_TRIGGERS))


def _before_first(lines: Column, test) -> Column:  # noqa: ANN001
    cut = lambda ls: let(F.array_position(F.transform(ls, test), True), lambda k: F.when(k > 0, F.slice(ls, F.lit(1), (k - 1).cast("int"))).otherwise(ls))
    return let(lines, cut)


def _flags(lines: Column, letter) -> Column:  # noqa: ANN001
    """One letter a line, as one text: runs of lines become runs of letters, which a pattern reads in one pass."""
    return F.array_join(F.transform(lines, letter), "")


def _letters(flags: Column) -> Column:
    """The letters by position."""
    return F.split(flags, "")


def _run(lines: Column, seed, go, blank=None) -> Column:  # noqa: ANN001
    """Drops seed lines and the lines after them that go on.

    Letters: ``S`` opens, ``G`` goes on, ``B`` is a blank line that goes on with nothing (after a dropped
    line it comes out empty), ``X`` is any other line. A match that begins where the last one ended
    carries the run on, so the pass is linear in the lines.
    """

    def letter(x: Column) -> Column:
        out = F.when(seed(x), "S").when(go(x), "G")
        return (out.when(blank(x), "B") if blank else out).otherwise("X")

    def kept(ls: Column) -> Column:
        gone = F.regexp_replace(_flags(ls, letter), r"S|(?!^)\G[SG]", "D")
        if blank is None:
            return let(_letters(gone), lambda f: F.filter(ls, lambda _, i: F.get(f, i) != "D"))
        emptied = let(_letters(F.regexp_replace(gone, "(?<=D)B", "E")), lambda f: F.transform(ls, lambda x, i: F.when(F.get(f, i) == "E", "").when(F.get(f, i) != "D", x)))
        return F.filter(emptied, lambda x: x.isNotNull())

    return let(lines, kept)


def drop_disclaimers(lines: Column) -> Column:
    """A trigger opens a run; the run takes lines with legal words and ends at a blank line or any other."""
    return _run(lines, lambda x: has(checked(x), rx.DISCLAIMER_TRIGGERS), lambda x: has(checked(x), rx.DISCLAIMER_VOCABULARY), lambda x: checked(x) == "")


def drop_signatures(lines: Column, keep_history: bool) -> Column:
    """A closing formula or footer opens a run of contact and blank lines; without history an inline closing cuts the rest."""
    if not keep_history:
        lines = _before_first(lines, lambda x: has(strip(x), rx.INLINE_SIGNATURE))
    return _run(lines, lambda x: let(strip(x), lambda s: has(s, rx.SALUTATIONS) | has(s, rx.FOOTERS)), lambda x: (strip(x) == "") | is_contact(x))


def drop_noise(lines: Column) -> Column:
    """Strips pipes, leftover tags and entities; drops lines of rules only."""

    def tidy(x: Column) -> Column:
        x = F.regexp_replace(x, rf"^{rx.S}*\|+{rx.S}*", "")
        x = F.regexp_replace(x, rf"{rx.S}*\|+{rx.S}*$", "")
        x = F.regexp_replace(x, r"<[a-zA-Z/!][^>@]*>", "")
        return F.regexp_replace(x, r"&[a-zA-Z]+;|&#\d+;|&#x[0-9a-fA-F]+;", " ")

    return F.filter(F.transform(lines, tidy), lambda x: ~x.rlike(rf"^[|{rx.WS}\-:=]+$"))


def header_flags(lines: Column) -> Column:
    """True for header lines and for blank lines between them (three lines to either side, filled left to right).

    A blank line can be filled by one filled before it, but only within three lines of the next header:
    three passes over the letters reach all of them.
    """
    f = _flags(lines, lambda x: F.when(is_header(x), "H").when(strip(x) == "", "b").otherwise("x"))
    for _ in range(3):
        f = F.regexp_replace(f, "(?<=[Hf].{0,2})b(?=.{0,2}H)", "f")
    return F.transform(_letters(f), lambda c: c.isin("H", "f"))


PLACEHOLDER = "﷐"  # a noncharacter: no text holds it


def replace_headers(lines: Column) -> Column:
    """Each block of header lines becomes one placeholder."""

    def tagged(ls: Column, flags: Column) -> Column:
        inner = lambda i: (i > 0) & F.get(flags, i - 1)
        return F.transform(ls, lambda x, i: F.when(F.get(flags, i), F.when(inner(i), F.lit(None).cast("string")).otherwise(PLACEHOLDER)).otherwise(x))

    return let(lines, lambda ls: let(header_flags(ls), lambda flags: F.filter(tagged(ls, flags), lambda x: x.isNotNull())))


def line_class(line: Column) -> Column:
    def of(s: Column) -> Column:
        n, last = F.length(s), F.substring(s, -1, 1)
        return (
            F.when(line == PLACEHOLDER, "PLACEHOLDER")
            .when(s == "", "EMPTY")
            .when(s.startswith("-") & (n < 30), "SIGN_OFF")
            .when(has(s, rx.SALUTATIONS), "SALUTATION")
            .when(is_contact(line), "CONTACT")
            .when(n >= 80, "OTHER")
            .when(s.rlike(r"^\p{Ll}"), "OTHER")
            .when(last.isin("!", "?") | ((last == ".") & (n >= 15)), "OTHER")
            .otherwise("NAME_TITLE")
        )

    return let(checked(line), of)


def drop_inline_signatures(lines: Column) -> Column:
    """Contact lines with the names, closings and sign-offs around them; closings followed by a name; ``-Name`` lines.

    Read by position among the lines that are not empty, so there is no walk.
    """
    up, down = ("NAME_TITLE", "SALUTATION", "CONTACT", "SIGN_OFF"), ("CONTACT", "NAME_TITLE", "SIGN_OFF")
    at = lambda f, k: F.coalesce(F.get(f, k)["c"], F.lit("NONE"))

    def first(f: Column, k: Column) -> Column:
        c = lambda d: at(f, k + d)
        above = (c(1) == "CONTACT") | (c(1).isin(*up) & ((c(2) == "CONTACT") | (c(2).isin(*up) & (c(3) == "CONTACT"))))
        below = (c(-1) == "CONTACT") | (c(-1).isin(*down) & (c(-2) == "CONTACT"))
        return (c(0) == "CONTACT") | (c(0).isin(*up) & above) | (c(0).isin(*down) & below)

    def gone(f: Column, r: Column, k: Column) -> Column:
        c = lambda d: at(f, k + d)
        stays = lambda d: ~F.coalesce(F.get(r, k + d), F.lit(False))
        closing = (c(0) == "SALUTATION") & (c(1) == "NAME_TITLE")
        name = (c(0) == "NAME_TITLE") & (((c(-1) == "SALUTATION") & stays(-1)) | ((c(-1) == "NAME_TITLE") & (c(-2) == "SALUTATION") & stays(-2)))
        return F.get(r, k) | closing | name | (c(0) == "SIGN_OFF")

    def kept(ls: Column) -> Column:
        full = F.filter(F.transform(ls, lambda x, i: F.struct(i.alias("i"), line_class(x).alias("c"))), lambda v: v["c"] != "EMPTY")
        flagged = lambda f, r: F.transform(f, lambda v, k: F.when(gone(f, r, k), v["i"]))
        out = let(full, lambda f: let(F.transform(f, lambda _, k: first(f, k)), lambda r: flagged(f, r)))
        return let(out, lambda o: F.filter(ls, lambda _, i: ~F.coalesce(F.array_contains(o, i), F.lit(False))))

    return let(lines, kept)


def strip_quotes(lines: Column) -> Column:
    """Drops placeholders; takes the leading marks off quoted lines; other indentation stays."""
    kept = F.filter(lines, lambda x: x != PLACEHOLDER)
    return F.transform(kept, lambda x: F.regexp_replace(x, f"^{rx.S}*>[{rx.WS}>]*", ""))


def collapse_blanks(text: Column) -> Column:
    """Right-strips lines, keeps at most two blank lines in a row, strips the whole."""
    tails = r"\t\x{0b}-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
    t = F.regexp_replace(text, f"[{tails}]+(\n|$)", "$1")
    return strip(F.regexp_replace(t, "\n{4,}", "\n\n\n"))
