"""Readers, writers, the stream and the command line."""

from __future__ import annotations

import json

import pytest

from lettermill.__main__ import main
from lettermill.operators import bulk, dedup
from lettermill.sources import io
from lettermill.streaming import mails as stream


def test_dictionary_keeps_last(spark, tmp_path):
    f = tmp_path / "d.json"
    f.write_text('{"a":"x","b":null,"a":"y"}')
    assert {(r["eid"], r["raw_body"]) for r in io.read_corpus(spark, str(f)).collect()} == {("a", "y"), ("b", None)}


def test_list(spark, tmp_path):
    f = tmp_path / "l.json"
    f.write_text('[{"eid":"a","body":"1"},{"id":"a","raw_body":"2"},"junk",{"message_id":"m","html":"3"},{}]')
    rows = io.read_corpus(spark, str(f))
    assert rows.count() == 4
    assert {(r["eid"], r["raw_body"]) for r in dedup.keep_first(rows).collect()} == {("a", "1"), ("m", "3"), ("", "")}


def test_other_input(spark, tmp_path):
    f = tmp_path / "n.json"
    f.write_text("42")
    with pytest.raises(ValueError):
        io.read_corpus(spark, str(f))
    with pytest.raises(FileNotFoundError):
        io.read_corpus(spark, str(tmp_path / "missing.json"))


def test_lines_and_tables(spark, tmp_path):
    f = tmp_path / "m.jsonl"
    f.write_text('{"eid":"a","body":"1"}\n\n{"id":"b","raw_body":"2"}\nno object\n{"message_id":"c"}\n')
    rows = io.read_corpus(spark, str(f)).orderBy("row_idx").collect()
    assert [(r["eid"], r["raw_body"]) for r in rows] == [("a", "1"), ("b", "2"), ("c", "")] and len({r["row_idx"] for r in rows}) == 3
    spark.createDataFrame([("a", "x", 5), ("b", None, 6)], "eid string, raw_body string, extra int").write.parquet(str(tmp_path / "t.parquet"))
    assert {(r["eid"], r["raw_body"]) for r in io.read_corpus(spark, str(tmp_path / "t.parquet")).collect()} == {("a", "x"), ("b", None)}


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("<a/b@c>", 'line "one"\nline two'), ("_a_b_c_", "collides"), ("e", "")], "eid string, body_text string")
    assert io.write_single_json(df, str(tmp_path / "o.json")) == 3 and json.loads((tmp_path / "o.json").read_text())["e"] == ""
    io.write_single_csv(df, str(tmp_path / "o.csv"), ("body_text",))
    assert (tmp_path / "o.csv").read_bytes().startswith(b"\xef\xbb\xbf") and 'line ""one"" line two' in (tmp_path / "o.csv").read_text("utf-8-sig")
    io.write_markdown_files(df, str(tmp_path / "md"))
    assert len(list((tmp_path / "md").iterdir())) == 2
    io.write_text_dump(df, str(tmp_path / "dump"), "eid", "body_text")
    io.write_threads_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv")).count() == 3
    assert "**Non-empty**: 2" in io.cleaning_report(df, "x")


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text(json.dumps({"eid": "a", "raw_body": "Hello there, all.\n\nThanks,\nBob"}) + "\n")
    s = stream.clean_stream(stream.mail_stream(spark, str(tmp_path / "in")))
    stream.to_parquet(s, str(tmp_path / "out"), str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(90)
    assert spark.read.parquet(str(tmp_path / "out")).first()["body_text"] == "Hello there, all.\n\nBob"


def test_filter_on_a_stream(spark, tmp_path):
    rows = [(i, int(i % 2), "please unsubscribe from the weekly digest offer" if i % 2 else f"can we meet about the budget draft {i}") for i in range(40)]
    model = bulk.train(spark.createDataFrame(rows, "row_idx long, label int, clean_text string"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text("\n".join(json.dumps(x) for x in ({"eid": "a", "raw_body": "Please unsubscribe from this list of lamps."}, {"eid": "b", "raw_body": "Can we meet about the budget draft?"}, {"eid": "c"})))
    s = stream.filter_stream(stream.mail_stream(spark, str(tmp_path / "in")), model)
    stream.to_parquet(s, str(tmp_path / "out"), str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(90)
    got = {r["eid"]: r["is_filtered"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"a": 1, "b": 0, "c": 0}


def test_command_line(spark, tmp_path, capsys):
    f = tmp_path / "c.json"
    f.write_text(json.dumps({"a": "Hello there, all.\n\nThanks,\nBob", "b": ""}))
    assert main([str(f), "--sample", "1"]) == 0 and json.loads((tmp_path / "c_clean.json").read_text())["a"] == "Hello there, all.\n\nBob"
    assert main([str(f), "--single", "zz"]) == 1


def test_report_lists_every_mail(spark):
    df = spark.range(1_200).selectExpr("1200 - id as row_idx", "concat('m', 1200 - id) as eid", "'x' as body_text")
    lines = io.cleaning_report(df, "x").splitlines()
    at = lines.index("## Contents") + 2
    assert lines[at] == "1. m1" and lines[at + 1_199] == "1200. m1200" and sum(x.startswith("### m") for x in lines) == 1_200
    few = io.cleaning_report(df, "x", entries=5).splitlines()
    assert sum(x.startswith("### m") for x in few) == 5 and "5. m5" in few and "6. m6" not in few
