"""Readers and writers of message corpora and results.

Corpora come as one JSON object of id to body or a JSON array of objects (small
ones: a single document is one task), as JSON lines, or as Parquet. Results go to distributed formats; single-file forms that need one
process (a JSON dictionary, a BOM) are written from an iterator over
partitions, never from one collected list.
"""

from __future__ import annotations

import json
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill import schemas


def _first_char(spark: SparkSession, path: str) -> str:
    row = spark.read.text(path).select(F.regexp_extract("value", r"\S", 0).alias("c")).where("c <> ''").first()
    return row["c"] if row else ""


def read_dict(spark: SparkSession, path: str) -> DataFrame:
    """``{id: body}``; a repeated id keeps its last body. Bodies that are not strings are read as their JSON text, null stays null."""
    whole = spark.read.text(path, wholetext=True)
    pairs = whole.select(F.posexplode(F.map_entries(F.from_json("value", "map<string,string>"))).alias("pos", "e"))
    rows = pairs.select(F.col("e.key").alias("eid"), F.col("e.value").alias("raw_body"), F.col("pos").cast("long").alias("row_idx"))
    last = rows.groupBy("eid").agg(F.max_by(F.struct("raw_body", "row_idx"), "row_idx").alias("r"))
    return last.select("eid", "r.raw_body", "r.row_idx")


def _mails(objects: DataFrame) -> DataFrame:
    """``eid, raw_body, row_idx`` of ``(pos, o)``: the first id and the first body of each object that is not empty."""
    pick = lambda *names: F.coalesce(*[F.nullif(F.col(f"o.{n}"), F.lit("")) for n in names], F.lit(""))
    return objects.select(pick("eid", "id", "message_id").alias("eid"), pick("raw_body", "body", "html").alias("raw_body"), F.col("pos").cast("long").alias("row_idx"))


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """Objects with an id in ``eid``, ``id`` or ``message_id`` and a body in ``raw_body``, ``body`` or ``html``; other items are skipped."""
    items = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", "array<string>")).alias("pos", "item"))
    return _mails(items.where(F.substring(F.ltrim("item"), 1, 1) == "{").select("pos", F.from_json("item", schemas.LIST_ITEM).alias("o")))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_list``, one object a line (a file or a folder of files): the form for large corpora, since the engine splits it.

    ``row_idx`` grows with file and line, but not by ones.
    """
    lines = spark.read.text(path).where(F.substring(F.ltrim("value"), 1, 1) == "{")
    return _mails(lines.select(F.monotonically_increasing_id().alias("pos"), F.from_json("value", schemas.LIST_ITEM).alias("o")))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table with ``eid`` and ``raw_body``; ``row_idx`` is made where it is missing."""
    df = spark.read.parquet(path)
    return df.select("eid", "raw_body", (F.col("row_idx") if "row_idx" in df.columns else F.monotonically_increasing_id()).cast("long").alias("row_idx"))


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """``eid, raw_body, row_idx`` of a dictionary, a list, lines (``.jsonl``) or a table (``.parquet``); anything else is a ``ValueError``, a missing file a ``FileNotFoundError``."""
    if "://" not in path and not Path(path).exists():
        raise FileNotFoundError(path)
    if path.rstrip("/").endswith(".parquet"):
        return read_table(spark, path)
    if path.rstrip("/").endswith(".jsonl"):
        return read_lines(spark, path)
    first = _first_char(spark, path)
    if first == "{":
        return read_dict(spark, path)
    if first == "[":
        return read_list(spark, path)
    raise ValueError(f"expected a JSON object or array in {path}")


def squeezed(df: DataFrame, *columns: str) -> DataFrame:
    """Line breaks in ``columns`` become one blank, for spreadsheets."""
    return df.withColumns({c: F.regexp_replace(c, r"[\r\n]+", " ") for c in columns if c in df.columns})


def write_csv(df: DataFrame, path: str, squeeze: tuple[str, ...] = ()) -> None:
    out = squeezed(df, *squeeze)
    out.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_threads_csv(df: DataFrame, path: str) -> None:
    write_csv(df.select(*[c for c in schemas.EXPORT if c in df.columns]), path, ("body_text", "cleaned_body"))


def write_text_dump(df: DataFrame, path: str, key: str = "email_id", text: str = "text") -> None:
    """Each text under a ruled heading with its id."""
    rule = "=" * 80
    df.select(F.concat_ws("\n", F.lit(rule), F.concat(F.lit("EMAIL ID: "), F.col(key)), F.lit(rule), F.coalesce(F.col(text), F.lit("")), F.lit("")).alias("value")).write.mode("overwrite").text(path)


def write_single_json(df: DataFrame, path: str, key: str = "eid", text: str = "body_text") -> int:
    """One dictionary file, streamed partition by partition; returns the number of entries."""
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        f.write("{")
        for r in df.select(key, text).toLocalIterator():
            f.write((",\n  " if n else "\n  ") + json.dumps(r[0], ensure_ascii=False) + ": " + json.dumps(r[1], ensure_ascii=False))
            n += 1
        f.write("\n}" if n else "}")
    return n


def write_single_csv(df: DataFrame, path: str, squeeze: tuple[str, ...] = ()) -> int:
    """One CSV file with a byte order mark, streamed."""
    import csv

    n = 0
    out = squeezed(df, *squeeze)
    with open(path, "w", encoding="utf-8-sig", newline="") as f:
        w = csv.writer(f)
        w.writerow(out.columns)
        for r in out.toLocalIterator():
            w.writerow(["" if x is None else x for x in r])
            n += 1
    return n


def safe_name(eid: str = "eid"):  # noqa: ANN201
    """A file name from an id: eleven characters become ``_``, at most 100 are kept."""
    return F.substring(F.regexp_replace(F.col(eid), r'[<>:"/\\|?*@+]', "_"), 1, 100)


def write_records_json(df: DataFrame, path: str, indent: int = 2) -> int:
    """One JSON array of objects, streamed; returns the number of entries."""
    n = 0
    pad = " " * indent
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for r in df.toLocalIterator():
            text = json.dumps(r.asDict(recursive=True), ensure_ascii=False, indent=indent, default=str)
            f.write((",\n" if n else "\n") + "\n".join(pad + x for x in text.split("\n")))
            n += 1
        f.write("\n]" if n else "]")
    return n


def named_texts(df: DataFrame, eid: str = "eid", text: str = "body_text") -> DataFrame:
    """``(e, t, name)`` of each non-empty text, with a file name; colliding names get a digest."""
    named = df.where(F.length(text) > 0).select(F.col(eid).alias("e"), F.col(text).alias("t"), safe_name(eid).alias("name"))
    shared = named.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name", F.lit(True).alias("shared"))
    return named.join(shared, "name", "left").select("e", "t", F.when(F.col("shared"), F.concat("name", F.lit("-"), F.substring(F.sha2("e", 256), 1, 8))).otherwise(F.col("name")).alias("name"))


def write_markdown_files(df: DataFrame, folder: str, eid: str = "eid", text: str = "body_text") -> int:
    """One Markdown file for each non-empty text, on the caller's disk, streamed; returns their number."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    n = 0
    for r in named_texts(df, eid, text).toLocalIterator():
        (Path(folder) / f"{r['name']}.md").write_text(f"# Email: {r['e']}\n\n{r['t']}\n", encoding="utf-8")
        n += 1
    return n


def cleaning_report(df: DataFrame, source: str, eid: str = "eid", text: str = "body_text", now: datetime | None = None, entries: int | None = None) -> str:
    """The lines of ``report_lines`` as one text."""
    return "".join(report_lines(df, source, eid, text, now, entries))


def report_lines(df: DataFrame, source: str, eid: str = "eid", text: str = "body_text", now: datetime | None = None, entries: int | None = None):  # noqa: ANN201
    """Markdown with counts and lengths of all rows, a table of contents of all ids and all bodies, or of the first ``entries``, in the order of ``row_idx``; streamed."""
    full = F.length(text) > 0
    s = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(full).alias("full"), F.floor(F.avg(F.when(full, F.length(text)))).alias("mean"), F.min(F.when(full, F.length(text))).alias("lo"), F.max(F.when(full, F.length(text))).alias("hi")).first()
    out = ["# Cleaning report", "", f"> **Source**: `{source}`  ", f"> **Generated**: {(now or datetime.now()):%Y-%m-%d %H:%M}  ", f"> **Total**: {s['n']} | **Non-empty**: {s['full']} | **Skipped**: {s['n'] - s['full']}", ""]
    if s["full"]:
        out += ["| Metric | Value |", "|---|---|", f"| Average length | {s['mean']} |", f"| Shortest | {s['lo']} |", f"| Longest | {s['hi']} |", ""]
    out += ["## Contents", ""]
    yield "".join(x + "\n" for x in out)
    listed = (df.orderBy("row_idx") if "row_idx" in df.columns else df).select(eid, text)
    listed = listed if entries is None else listed.limit(entries)
    for i, r in enumerate(listed.select(eid, (~full).alias("blank")).toLocalIterator(), 1):
        e = r[0] or ""
        yield f"{i}. {e[:55] + ('...' if len(e) > 55 else '')}{' *(empty)*' if r['blank'] is not False else ''}\n"
    yield "\n## Emails\n"
    for r in listed.where(full).toLocalIterator():
        yield f"\n### {r[0] or ''}\n\n{r[1]}\n\n---\n"


def thread_report(metrics: list[DataFrame], summary: DataFrame, chosen: str, stats: DataFrame, exported: DataFrame | None = None, now: datetime | None = None) -> str:
    """Markdown: records, both methods side by side, the choice, grouping, thread sizes, the ten largest threads, the schema of the export and its validation."""
    d = stats.first()
    rows = [m.first().asDict() for m in metrics]
    sizes = summary.agg(F.count(F.lit(1)).alias("n"), F.avg("email_count").alias("mean"), F.max("email_count").alias("hi"), F.min("email_count").alias("lo")).first()
    split = summary.groupBy("grouping_method").agg(F.count(F.lit(1)).alias("threads"), F.sum("email_count").alias("mails")).orderBy("grouping_method").collect()
    top = summary.orderBy(F.desc("email_count"), F.asc("thread_id")).limit(10).select("thread_id", "email_count").collect()
    out = ["# Thread report", "", f"Generated {(now or datetime.now()):%Y-%m-%d %H:%M}", "", "## Records", "", f"{d['before']} read, {d['dupes']} repeated ids removed, {d['after']} grouped.", "", "## Methods", ""]
    out += ["| Metric | " + " | ".join(r["method"] for r in rows) + " |", "|---|" + "---|" * len(rows)]
    out += [f"| {k} | " + " | ".join(str(r[k]) for r in rows) + " |" for k in rows[0] if k != "method"]
    out += ["", "## Choice", "", f"`{chosen}`", "", "## Grouping", "", "| Method | Threads | Mails |", "|---|---|---|"]
    out += [f"| {r['grouping_method']} | {r['threads']} | {r['mails']} |" for r in split]
    out += ["", "## Sizes", "", f"{sizes['n']} threads; mean {sizes['mean'] or 0:.2f}, largest {sizes['hi'] or 0}, smallest {sizes['lo'] or 0}.", "", "## Largest threads", "", "| Thread | Mails |", "|---|---|"]
    out += [f"| {r['thread_id']} | {r['email_count']} |" for r in top]
    if exported is not None:
        out += ["", "## Export", "", "| Column | Type |", "|---|---|", *[f"| {f.name} | {f.dataType.simpleString()} |" for f in exported.schema], "", "Validated: every mail has one non-empty thread id, no id repeats."]
    return "\n".join(out) + "\n"
