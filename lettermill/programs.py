"""The three programs end to end: cleaner, thread grouper, bulk filter."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill import schemas
from lettermill.config import DEFAULT, Config
from lettermill.operators import bulk, clean, dedup, meta, threads
from lettermill.session import Scratch
from lettermill.sources import io


def prepared(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First row of each id with both clean bodies and the metadata, written once and read by all later steps; and the first raw rows."""
    first = dedup.keep_first(raw)
    rows = meta.with_metadata(clean.clean_bodies(first))
    return Scratch(raw.sparkSession, "prepared").cut(rows.drop("raw_body")), first


def grouped(mails: DataFrame, links: DataFrame | None = None, config: Config = DEFAULT) -> tuple[DataFrame, DataFrame, str, list[DataFrame]]:
    """``(threaded, summary, method, metrics)``: both methods are run, the better one names the threads; the winner's metrics come first."""
    both = threads.evaluate(mails, links, config)
    method = threads.choose(both, config.cohesion_ratio)
    threaded = threads.with_grouping(threads.thread_ids(mails, both[method][0]), method)
    order = [method, *[m for m in both if m != method]]
    return threaded, threads.thread_summary(threaded, method), method, [both[m][1] for m in order]


def export(threaded: DataFrame) -> DataFrame:
    """The columns of the export, ordered by thread, then by row."""
    return threaded.orderBy("thread_id", "row_idx").select(*schemas.EXPORT)


def group_corpus(spark: SparkSession, corpus: str, out: str, config: Config = DEFAULT) -> str:
    """Reads a corpus, groups it and writes ``threads.csv``, ``summary.json`` and ``report.md`` to the folder ``out``; returns the chosen method."""
    raw = Scratch(spark, "corpus").cut(io.read_corpus(spark, corpus))
    mails, first = prepared(raw)
    links = Scratch(spark, "links").cut(threads.id_links(first))
    threaded, summary, method, metrics = grouped(mails, links, config)
    threaded, summary = Scratch(spark, "threaded").cut(threaded), Scratch(spark, "summary").cut(summary)
    threads.validate(threaded)
    folder = Path(out)
    folder.mkdir(parents=True, exist_ok=True)
    table = export(threaded)
    io.write_single_csv(table, str(folder / "threads.csv"), ("cleaned_body", "body_text"))
    io.write_records_json(summary.orderBy("thread_id"), str(folder / "summary.json"))
    title = Path(corpus).stem.replace("_", " ").title()
    report = io.thread_report(metrics, summary, method, dedup.dedup_stats(raw), table)
    (folder / "report.md").write_text(f"<!-- {title} -->\n{report}", encoding="utf-8")
    return method


def filter_corpus(spark: SparkSession, corpus: str, out: str, config: Config = DEFAULT, model: str | None = None) -> dict[str, int]:
    """Labels, trains (or loads ``model``), classifies every mail, and writes the labelled table, both outputs, both dumps, the model and the held-out report to ``out``."""
    folder = Path(out)
    folder.mkdir(parents=True, exist_ok=True)
    raw = io.read_corpus(spark, corpus).select(F.col("eid").alias("email_id"), F.coalesce("raw_body", F.lit("")).alias("text"), "row_idx")
    data = Scratch(spark, "filter").cut(bulk.clean_for_model(bulk.with_labels(raw)))
    io.write_single_csv(data.orderBy("row_idx").select("email_id", "text", "label", "category"), str(folder / "labeled.csv"))
    if model is None:
        split = Scratch(spark, "split").cut(bulk.stratified_split(data, "row_idx", "label", config.test_share, config.seed))
        fitted = bulk.train(split.where("not is_test"), config, fit_on=data)
        fitted.save(str(folder / "model"))
        held = bulk.score(split.where("is_test"), fitted).withColumn("predicted", (F.col("automation_probability") >= 0.5).cast("int"))
        io.write_records_json(bulk.class_report(bulk.confusion(held, "label", "predicted")).orderBy("class"), str(folder / "held_out.json"))
    fitted = bulk.BulkModel.load(spark, model or str(folder / "model"))
    done = Scratch(spark, "classified").cut(bulk.classify(data, fitted, config.automation_threshold))
    genuine, filtered = bulk.split_filtered(done.orderBy("row_idx").select("email_id", "text", "clean_text", "automation_probability", "is_filtered"))
    n = {"genuine": io.write_single_csv(genuine, str(folder / "genuine.csv"), ("text", "clean_text")), "filtered": io.write_records_json(filtered, str(folder / "filtered.json"), 4)}
    io.write_text_dump(genuine, str(folder / "genuine_texts"))
    io.write_text_dump(filtered, str(folder / "filtered_texts"))
    return n
