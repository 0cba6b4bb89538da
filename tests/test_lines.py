"""Line operators against the traps of the fixtures, and against plain walks."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lettermill.operators import lines as L


def apply(spark, op, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    rows = df.select("k", L.join_lines(op(L.split_lines(F.col("t")))).alias("t")).orderBy("k").collect()
    return [r["t"] for r in rows]


def test_reply_chain(spark):
    got = apply(spark, L.cut_reply_chain, ["Hello\n> quoted\nmore", "From: x\nSent: y\nbody", "a\n--\nb", "On Mon, Mar 30, 2026 at 4 PM A <a@b.co> wrote:\nx", None, ""])
    assert got == ["Hello", "From: x\nSent: y\nbody", "a", "", None, ""]


def test_disclaimers(spark):
    got = apply(spark, L.drop_disclaimers, ["Hi Arpit\n disclaimer:\nThis is confidential...\n Hi Darshil", "disclaimer:\n>\nconfidential stuff", "nothing here"])
    assert got == ["Hi Arpit\n Hi Darshil", "\nconfidential stuff", "nothing here"]


def test_signatures(spark):
    text = "Hi\nBest regards,\n+1 415 555 0100\n\nBob"
    assert apply(spark, lambda x: L.drop_signatures(x, True), [text]) == ["Hi\nBob"]
    assert apply(spark, lambda x: L.drop_signatures(x, False), ["Thanks, can you check\nrest", "Hi\nThanks,\nBob"]) == ["", "Hi\nBob"]


def test_noise(spark):
    assert apply(spark, L.drop_noise, ["| a |\n---\n\n   \n***\na&amp;b"]) == ["a\n\n***\na b"]


@pytest.mark.parametrize(
    ("line", "kind"),
    [
        ("-Gwen", "SIGN_OFF"), ("Thanks,", "SALUTATION"), ("see https://x.y", "CONTACT"), ("Hi team,", "NAME_TITLE"), ("hello there", "OTHER"),
        ("Sure, works for me.", "OTHER"), ("Ok.", "NAME_TITLE"), ("Ok!", "OTHER"), ("Let's drive there tomorrow", "CONTACT"), ("> ", "EMPTY"),
    ],
)
def test_classes(spark, line, kind):
    assert spark.createDataFrame([(line,)], "t string").select(L.line_class(F.col("t"))).first()[0] == kind


def test_header_gap(spark):
    df = spark.createDataFrame([("From: a\n\n\n\n\nTo: b",)], "t string")
    assert df.select(L.header_flags(L.split_lines(F.col("t")))).first()[0] == [True, False, True, True, True, True]


EXAMPLE = {"NAME_TITLE": "Bob Smith", "SALUTATION": "Thanks,", "CONTACT": "see https://x.y", "SIGN_OFF": "-Gwen", "EMPTY": "", "OTHER": "all in lower case", "PLACEHOLDER": L.PLACEHOLDER}


def walk(classes):
    """The inline-signature rule as a walk over the lines around each line."""
    full = [i for i, c in enumerate(classes) if c != "EMPTY"]
    gone = set()
    for k, i in enumerate(full):
        if classes[i] != "CONTACT":
            continue
        gone.add(i)
        for step, limit, ok in ((-1, 3, {"NAME_TITLE", "SALUTATION", "CONTACT", "SIGN_OFF"}), (1, 2, {"CONTACT", "NAME_TITLE", "SIGN_OFF"})):
            for n in range(1, limit + 1):
                j = k + step * n
                if not 0 <= j < len(full) or classes[full[j]] not in ok:
                    break
                gone.add(full[j])
    first = set(gone)
    for k, i in enumerate(full):
        if classes[i] == "SALUTATION" and i not in first:
            names = []
            for j in full[k + 1 : k + 3]:
                if classes[j] != "NAME_TITLE":
                    break
                names.append(j)
            if names:
                gone |= {i, *names}
        if classes[i] == "SIGN_OFF":
            gone.add(i)
    return gone


def test_inline_signatures_like_a_walk(spark):
    rng = random.Random(4)
    cases = [[rng.choice(list(EXAMPLE)) for _ in range(rng.randrange(1, 11))] for _ in range(250)]
    texts = ["\n".join(f"{EXAMPLE[c]}" for c in case) for case in cases]
    got = apply(spark, L.drop_inline_signatures, texts)
    for case, text, out in zip(cases, texts, got, strict=True):
        gone = walk(case)
        assert out == "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone), case


def test_blanks_and_quotes(spark):
    df = spark.createDataFrame([("a\n\n\n\n\nb  \n",)], "t string")
    assert df.select(L.collapse_blanks(F.col("t"))).first()[0] == "a\n\n\nb"
    assert apply(spark, L.strip_quotes, ["> > hi\n  hi"]) == ["hi\n  hi"]


def test_tables_and_preformatted_text():
    from lettermill.operators.html import html_to_text

    t = html_to_text("<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table><pre>x\n  y\nz</pre>")
    lines = [x.rstrip() for x in t.split("\n")]
    assert lines[0].startswith("a") and "---|---" in lines and lines.index("---|---") == 1 and "  y" in lines and lines[lines.index("  y") - 1] == "x"
