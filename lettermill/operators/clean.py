"""The body cleaner: raw HTML or plain body to clean text, with or without the reply history.

Rows are independent: the whole pipeline is one stage without a shuffle. Only
rendering, Unicode and escapes run in Python; the rest is Catalyst expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill import rx
from lettermill.config import DEFAULT
from lettermill.operators import lines as L
from lettermill.operators.html import readable


def clean_links(text: Column) -> Column:
    t = F.regexp_replace(text, r"\[([^\]]+)\]\(mailto:[^)]+\)", "$1")
    t = F.regexp_replace(t, r"<mailto:[^>]+>", "")
    t = F.regexp_replace(t, "mailto:" + rx.ADDRESS, "")
    return F.regexp_replace(t, r"""\[([^\]]+)\]\(["'\\ ]*\)""", "$1")


def stitch_headers(text: Column) -> Column:
    """An "On ... wrote:" header broken over two lines becomes one line."""
    return F.regexp_replace(text, rf"(?imu)(^[{rx.WS}>]*On{rx.S}+[^\n]{{5,180}})\n([{rx.WS}>]*wrote{rx.S}*:)", "$1 $2")


def finish(text: Column, min_length: int = DEFAULT.min_length) -> Column:
    t = L.strip(F.regexp_replace(L.collapse_blanks(text), '^"+|"+$', ""))
    return L.let(t, lambda x: F.when(F.length(x) >= min_length, x).otherwise(""))


def clean_text(text: Column, keep_history: bool = True) -> Column:
    """The layers after rendering; ``text`` comes from ``readable``."""
    lines = L.split_lines(stitch_headers(clean_links(text)))
    if not keep_history:
        lines = L.cut_reply_chain(lines)
    lines = L.drop_noise(L.drop_signatures(L.drop_disclaimers(lines), keep_history))
    if keep_history:
        lines = L.drop_inline_signatures(L.replace_headers(lines))
    return finish(L.join_lines(L.strip_quotes(lines)))


def clean_bodies(df: DataFrame, body: str = "raw_body", keep: str | None = "body_text", truncate: str | None = "cleaned_body") -> DataFrame:
    """Adds the body with its history and the latest reply only; empty for null, blank and very short results.

    Intermediate texts are materialised between the layers by separate projections, so that an
    expression is not repeated inside the next one.
    """
    out = df
    for name, history in ((keep, True), (truncate, False)):
        if name is None:
            continue
        out = out.withColumn(name, readable(F.col(body), history))
        out = out.withColumn(name, clean_text(F.col(name), history))
    return out
