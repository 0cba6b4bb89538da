"""Command line: the cleaner ``python -m lettermill corpus.json [-o OUT] [--truncate] [--sample N] [--single ID] [--no-md]``; ``--threads OUT`` and ``--filter OUT`` run the other two programs."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lettermill import programs
from lettermill.operators.clean import clean_bodies
from lettermill.session import ship
from lettermill.sources import io


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lettermill")
    p.add_argument("input")
    p.add_argument("-o", "--output")
    p.add_argument("--no-md", action="store_true", help="no Markdown report and files")
    p.add_argument("--truncate", action="store_true", help="latest reply only")
    p.add_argument("--sample", type=int, default=0)
    p.add_argument("--single")
    p.add_argument("--threads", metavar="OUT", help="group the mails into threads")
    p.add_argument("--filter", metavar="OUT", help="tell automated mails from genuine ones")
    p.add_argument("--model", help="a saved model for --filter")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("lettermill").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship(spark)
    if a.threads:
        print(f"threads by {programs.group_corpus(spark, a.input, a.threads)}: {a.threads}")
    if a.filter:
        print(f"{programs.filter_corpus(spark, a.input, a.filter, model=a.model)}: {a.filter}")
    if a.threads or a.filter:
        return 0
    rows = io.read_corpus(spark, a.input)
    if a.single is not None:
        rows = rows.where(F.col("eid") == a.single)  # before the cleaner: one row is cleaned
    name = "cleaned_body" if a.truncate else "body_text"
    done = clean_bodies(rows, keep=None if a.truncate else name, truncate=name if a.truncate else None).select("eid", F.col(name).alias("body_text"), "row_idx")
    if a.single is not None:
        row = done.first()
        print(row["body_text"] if row else f"unknown id: {a.single}")
        return 0 if row else 1
    out = Path(a.output) if a.output else Path(a.input).with_name(Path(a.input).stem + "_clean.json")
    print(f"{io.write_single_json(done.orderBy('row_idx'), str(out))} mails: {out}")
    if not a.no_md:
        with out.with_suffix(".md").open("w", encoding="utf-8") as f:
            f.writelines(io.report_lines(done, Path(a.input).name))
        io.write_markdown_files(done, str(out.with_name(out.stem + "_emails")))
    for r in done.orderBy("row_idx").limit(a.sample).collect() if a.sample else ():
        print(f"{r['eid'][:55]} ({len(r['body_text'])}): {r['body_text'][:500].encode('ascii', 'replace').decode()}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
