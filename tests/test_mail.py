"""Cleaner, metadata, similarity, threads and bulk filter on small fixtures."""

from __future__ import annotations

import itertools
import math
import re

import pytest
from pyspark.sql import functions as F

from lettermill.config import DEFAULT
from lettermill.functions.stopwords import STOP_WORDS
from lettermill.operators import bulk, clean, dedup, html, meta, similarity, threads
from lettermill.operators.components import connected_components

MAILS = [
    ("email_001", '<html><body><p>Hi team,</p><p>Please review the doc.</p><div class="gmail_signature">Bob</div></body></html>'),
    ("email_002", "Hey,\nCan we meet tomorrow?\nThanks,\nSarah\n--\nSarah Lee | sarah@x.com"),
    ("email_003", "On Mon, Mar 30, 2026 at 4:37 PM, Paul <paul@x.com> wrote:\n> Let's sync up.\n\nSure, works for me."),
    ("msg_42", "Hi Alice,\n\nPlease find the report attached.\n\nBest regards,\nBob Smith\nSenior Engineer | Acme Corp\nbob@acme.com | +1 415 555 0100\n---\nDisclaimer: this email is confidential."),
    ("blank", "  \n"),
    ("none", None),
    ("empty", ""),
]


def test_goldens(spark):
    df = spark.createDataFrame(MAILS, "eid string, raw_body string")
    got = {r["eid"]: (r["body_text"], r["cleaned_body"]) for r in clean.clean_bodies(df).collect()}
    assert got["email_001"] == ("Hi team,\n\nPlease review the doc.",) * 2
    assert got["email_002"] == ("Hey,\nCan we meet tomorrow?", "Hey,\nCan we meet tomorrow?\nSarah")
    assert got["email_003"] == ("Let's sync up.\n\nSure, works for me.", "")
    assert got["msg_42"][0] == "Hi Alice,\n\nPlease find the report attached."
    assert got["msg_42"][1].startswith("Hi Alice,\n\nPlease find the report attached.\n\nBob Smith")
    assert got["blank"] == got["none"] == got["empty"] == ("", "")


def test_unicode_and_escapes():
    assert html.plain_unicode("\u00a0\u2014\u2026\u00e9\x07") == " --...e\u0301"
    assert html.without_escapes(r"a\nb \u0041 \ud83d \u000a") == "a b A    "


def test_metadata(spark):
    raw = 'On Mon, Mar 30, 2026 at 4:37 PM, A <a@b.co> wrote:\nTo: <A HREF="mailto:x@y.com">X</a>\nSubject: <b>Hi</b> there\nwrote: <blockquote>'
    df = spark.createDataFrame([(raw,), ("From: Paul <p@x.io>",), (None,), ("Update: soon",)], "raw_body string")
    r = meta.with_metadata(df).collect()
    assert (r[0]["from_addr"], r[0]["to_addr"], r[0]["subject"], r[0]["date"], r[0]["reply_depth"]) == ("a@b.co", "x@y.com", "Hi there", "Mar 30, 2026", 2)
    assert r[0]["participants"] == ["a@b.co", "x@y.com"]
    assert (r[1]["from_addr"], r[2]["from_addr"], r[2]["participant_count"]) == ("", "", 0)
    assert r[3]["date"] == "soon"


def test_dedup(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), (None, 3, "z"), (None, 4, "w")], "eid string, row_idx int, b string")
    assert {tuple(r) for r in dedup.keep_first(df).collect()} == {("a", 1, "x"), (None, 3, "z")}
    assert tuple(dedup.dedup_stats(df).first()) == (4, 2, 2)


TEXTS = ["alpha beta gamma", "alpha beta delta", "alpha beta gamma", "", None, "gamma delta epsilon zeta eta", "gamma delta epsilon zeta", "one two", "hi the café_x 2 THE cats"]


def test_jaccard_join_is_exact(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "k int, t string")
    sets = [set(w for w in re.findall(r"\w+", (t or "").lower()) if re.fullmatch("[a-z]{3,}", w)) for t in TEXTS]
    for t in (0.35, 0.5, 0.99):
        want = {(i, j): len(a & b) / len(a | b) for (i, a), (j, b) in itertools.combinations(enumerate(sets), 2) if a and b and len(a & b) / len(a | b) >= t}
        got = {(r["i"], r["j"]): r["sim"] for r in similarity.jaccard_join(df, "k", "t", t).collect()}
        assert got == pytest.approx(want)


def test_tfidf_and_cosine(spark):
    texts = ["red apple pie", "red apple tart", "green pear pie", "blue plum tart", "the of and", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    docs = []
    for t in texts:
        w = [x for x in re.findall(r"\w{2,}", t) if x not in STOP_WORDS]
        docs.append(w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    n = len(docs)
    freq = {t: sum(t in d for d in docs) for d in docs for t in d}
    vec = []
    for d in docs:
        v = {t: d.count(t) * (math.log((1 + n) / (1 + freq[t])) + 1) for t in d}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1
        vec.append({t: x / norm for t, x in v.items()})
    got = similarity.tfidf(df, "k", "t")
    assert {(r["k"], r["term"]): r["w"] for r in got.collect()} == pytest.approx({(k, t): x for k, v in enumerate(vec) for t, x in v.items()})
    want = {(i, j): s for i, j in itertools.combinations(range(n), 2) if (s := sum(x * vec[j].get(t, 0) for t, x in vec[i].items())) >= 0.2}
    assert {(r["i"], r["j"]): r["sim"] for r in similarity.cosine_join(got, 0.2).collect()} == pytest.approx(want)


def test_components_and_split(spark):
    chain = [(i, i + 1) for i in range(20)] + [(30, 31), (31, 31), (40, 40)]
    got = dict(connected_components(spark.createDataFrame(chain, "i long, j long")).collect())
    assert got == {**dict.fromkeys(range(21), 0), 30: 30, 31: 30}
    rows = spark.createDataFrame([(0, "b", "same"), (1, "a", "same"), (2, "c", "other"), (3, "d", "alone")], "row_idx long, eid string, body_text string")
    comps = threads.clusters(rows, spark.createDataFrame([(0, 2), (1, 2)], "i long, j long"))
    assert dict(comps.collect()) == {0: 0, 2: 0, 1: -2, 3: 3}
    ids = {r["eid"]: r["thread_id"] for r in threads.thread_ids(rows, comps).collect()}
    assert ids["b"] == ids["c"] and len(set(ids.values())) == 3


def test_thread_id_digest(spark):
    rows = spark.createDataFrame([(0, "b"), (1, "a")], "row_idx long, eid string")
    comps = spark.createDataFrame([(0, 0), (1, 0)], "row_idx long, comp long")
    assert {r["thread_id"] for r in threads.thread_ids(rows, comps).collect()} == {"thread_0eab8a0a3380"}


def test_id_links(spark):
    rows = [(0, "<a@x>", "see <b@x> and id-7"), (1, "<b@x>", "nothing"), (2, "id-7", None), (3, "", "<a@x>"), (4, None, "xid-7x")]
    got = threads.id_links(spark.createDataFrame(rows, "row_idx long, eid string, raw_body string"))
    assert {tuple(r) for r in got.collect()} == {(0, 1), (0, 2), (0, 3), (2, 4)}


def test_metrics_and_choice(spark):
    comps = spark.createDataFrame([(0, 0), (1, 0), (2, 0), (3, 3)], "row_idx long, comp long")
    pairs = spark.createDataFrame([(0, 1, 0.6), (1, 2, 0.3)], "i long, j long, sim double")
    r = threads.metrics(comps, pairs, "Jaccard", 0.35).first()
    assert (r["total_threads"], r["singletons"], r["avg_cohesion"], r["emails_in_threads_pct"]) == (2, 1, 0.3, 75.0)
    assert threads.chosen_method(0.50, 0.39) == "jaccard" and threads.chosen_method(0.50, 0.45) == "tfidf"
    empty = threads.metrics(comps.limit(0), pairs.limit(0), "Jaccard", 0.35).first()
    assert (empty["total_threads"], empty["avg_cohesion"]) == (0, 0.0)


def test_bulk(spark):
    df = spark.createDataFrame([("Newsletter: do not reply",), ("AUTOMATIC REPLY",), ("hello",), (None,)], "text string")
    assert [(r["label"], r["category"]) for r in bulk.with_labels(df).collect()] == [(1, "newsletter"), (1, "ooo"), (0, "genuine"), (0, "genuine")]
    f = bulk.with_features(spark.createDataFrame([("curl url reply",)], "clean_text string")).first()
    assert (f["num_urls"], f["num_reply_markers"], f["text_length"]) == (2, 1, 14)
    g = spark.createDataFrame([(0, 0.95), (0, 0.9499), (1, 0.0)], "h int, p double").select(bulk.two_gates(F.col("h"), F.col("p"), DEFAULT.automation_threshold)).collect()
    assert [r[0] for r in g] == [1, 0, 1]


def test_training_separates(spark):
    rows = [(i, int(i % 2), "please unsubscribe from the weekly digest offer" if i % 2 else "can we meet about the budget draft") for i in range(40)]
    data = spark.createDataFrame(rows, "row_idx long, label int, clean_text string")
    model = bulk.train(data)
    p = {r["row_idx"]: r["automation_probability"] for r in bulk.score(data, model).collect()}
    assert all((p[i] > 0.5) == bool(i % 2) for i in p)
    with pytest.raises(ValueError):
        bulk.train(data.where("label = 1"))
