"""The programs end to end on small corpora."""

from __future__ import annotations

import csv
import json

import pytest
from pyspark.sql import functions as F

from lettermill import programs
from lettermill.__main__ import main
from lettermill.functions.register import register
from lettermill.operators import bulk, lines, meta, threads

HEAD = "From: ada@x.example\nTo: bo@y.example\nDate: 2024-05-03 10:00\nSubject: Lamps\n\n"
CORPUS = {
    "<m1@x>": HEAD + "alpha beta gamma delta epsilon zeta eta theta",
    "<m2@x>": HEAD + "alpha beta gamma delta epsilon zeta eta iota",
    "<m3@x>": "nothing in common with other mails but a link to <m4@x> of the archive",
    "<m4@x>": "quite another text about gardens rivers mountains",
    "<m5@x>": "",
}


def test_threads(spark, tmp_path):
    f = tmp_path / "my_corpus.json"
    f.write_text(json.dumps(CORPUS))
    assert main([str(f), "--threads", str(tmp_path / "out")]) == 0
    rows = list(csv.DictReader((tmp_path / "out" / "threads.csv").open(encoding="utf-8-sig")))
    of = {r["eid"]: r for r in rows}
    assert len(rows) == 5 and [r["thread_id"] for r in rows] == sorted(r["thread_id"] for r in rows)
    assert of["<m1@x>"]["thread_id"] == of["<m2@x>"]["thread_id"] and of["<m3@x>"]["thread_id"] == of["<m4@x>"]["thread_id"]
    assert of["<m1@x>"]["timestamp"] == "1714730400000" and of["<m1@x>"]["from_addr"] == "ada@x.example" and of["<m5@x>"]["grouping_method"] == "singleton"
    summary = json.loads((tmp_path / "out" / "summary.json").read_text())
    assert len(summary) == 3 and sum(s["email_count"] for s in summary) == 5
    report = (tmp_path / "out" / "report.md").read_text()
    assert "My Corpus" in report and "| TF-IDF" in report and "## Choice" in report and "| cleaned_body | string |" in report


def test_filter(spark, tmp_path):
    corpus = {f"e{i}": "please unsubscribe from the weekly digest offer of lamps" if i % 2 else f"can we meet about the budget draft number {i}" for i in range(40)}
    f = tmp_path / "c.json"
    f.write_text(json.dumps(corpus))
    n = programs.filter_corpus(spark, str(f), str(tmp_path / "out"))
    assert n == {"genuine": 20, "filtered": 20}
    assert len(json.loads((tmp_path / "out" / "filtered.json").read_text())) == 20
    # the saved model gives the same answer
    assert programs.filter_corpus(spark, str(f), str(tmp_path / "again"), model=str(tmp_path / "out" / "model")) == n
    assert (tmp_path / "again" / "genuine.csv").read_bytes() == (tmp_path / "out" / "genuine.csv").read_bytes()


def test_model_is_the_regression_it_says(spark, tmp_path):
    rows = [(i, int(i % 3 == 0), " ".join(w for k, w in enumerate("lamp chair table box door hall stair roof".split()) if (i * 7 + k * 3) % 5 < 2)) for i in range(60)]
    data = spark.createDataFrame(rows, "row_idx long, label int, clean_text string")
    model = bulk.train(data)
    model.save(str(tmp_path / "m"))
    again = bulk.BulkModel.load(spark, str(tmp_path / "m"))
    p, q = ({r["row_idx"]: r["automation_probability"] for r in bulk.score(data, m).collect()} for m in (model, again))
    assert p == q
    # the gradient of the balanced, ridged log loss vanishes at the intercept and at each term
    n1 = sum(y for _, y, _ in rows)
    w = {1: 60 / (2 * n1), 0: 60 / (2 * (60 - n1))}
    err = {i: w[y] * (p[i] - y) for i, y, _ in rows}
    assert abs(sum(err.values())) < 1e-2
    from lettermill.operators import similarity

    x = similarity.tfidf(data, "row_idx", "clean_text", 15_000, 0.95, 2, True).collect()
    coef = {r["term"]: r["coef"] for r in model.terms.collect()}
    grad = dict.fromkeys(coef, 0.0)
    for r in x:
        grad[r["term"]] += err[r["k"]] * r["w"]
    assert set(coef) == {r["term"] for r in x} and all(abs(grad[t] + coef[t]) < 2e-2 for t in coef)


def test_validation(spark):
    ok = spark.createDataFrame([("a", "t1"), ("b", "t1")], "eid string, thread_id string")
    threads.validate(ok)
    for bad in ([("a", "")], [("a", None)], [("a", "t"), ("a", "u")]):
        with pytest.raises(ValueError):
            threads.validate(spark.createDataFrame(bad, "eid string, thread_id string"))


def test_header_blocks(spark):
    text = "hello\n> From: Ada Quill <ADA@x.example>\n> To: Bo\n>  bo@y.example\n\nrest\nof\nthe text\nFrom: nobody\nTo: Cy <cy@z.example>"
    df = spark.createDataFrame([(1, text), (2, None), (3, "plain")], "k int, t string")
    got = {r["pos"]: (r["n_lines"], r["sender"], r["recipient"], r["depth"]) for r in meta.header_block_metadata(df, "k", "t").collect()}
    assert got == {1: (2, "ada@x.example", "", 1), 8: (2, "cy@z.example", "cy@z.example", 0)}


def test_small_functions(spark):
    df = spark.createDataFrame([("my_mail_corpus", "<ADA@x.example.> b@c.de")], "n string, t string")
    assert tuple(df.select(meta.corpus_title(F.col("n")), meta.first_address(F.col("t"))).first()) == ("My Mail Corpus", "ada@x.example.")
    x = spark.createDataFrame([(["From: a", "Bob Smith", "Design team", "---", "**Bold**", "Ada | Quill", "this is a sentence"],)], "ls array<string>")
    r = x.select(lines.drop_header_lines(F.col("ls")).alias("a"), F.transform("ls", lines.is_signature_part).alias("b")).first()
    assert r["a"][0] == "Bob Smith" and r["b"] == [False, True, True, True, True, True, False]
    register(spark)
    assert tuple(spark.sql("SELECT weak_label('AUTOMATIC REPLY'), weak_label(null), tokenize('The cats café_x the')").first()) == ("ooo", "genuine", ["the", "cats"])
