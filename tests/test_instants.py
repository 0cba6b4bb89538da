"""Dates and epoch counts to UTC milliseconds."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest

from lettermill.functions.instants import to_utc_millis


def ms(*a, micro=0):
    return int(datetime(*a, tzinfo=timezone.utc).timestamp() * 1000) + micro


BOXES = [(1, "Europe/Berlin", "dmy"), (2, "America/New_York", "mdy"), (3, "Nowhere/Land", "dmy")]
CASES = [
    ("2024-01-14 20:46:36", None, ms(2024, 1, 14, 20, 46, 36)),
    ("2024-01-14T20:46:36.9879Z", 1, ms(2024, 1, 14, 20, 46, 36, micro=987)),
    ("20240114T132704Z", 1, ms(2024, 1, 14, 13, 27, 4)),
    ("2024-012T03:42:44Z", 1, ms(2024, 1, 12, 3, 42, 44)),
    ("2024-366", None, ms(2024, 12, 31)),
    ("2023-366", None, None),
    ("2024-W02-4T16:58:10Z", 1, ms(2024, 1, 11, 16, 58, 10)),
    ("10/01/2024 12:57", 1, ms(2024, 1, 10, 11, 57)),
    ("10/01/2024 12:57", 2, ms(2024, 10, 1, 16, 57)),
    ("09.01.2024 10:52", 2, ms(2024, 1, 9, 15, 52)),
    ("8/1/24 5:53 pm", None, ms(2024, 1, 8, 17, 53)),
    ("12/1/24 12:00 AM", None, ms(2024, 1, 12)),
    ("13/13/2024", 1, None),
    ("Mon, 08 Jan 2024 07:36:21 IST", 1, ms(2024, 1, 8, 2, 6, 21)),
    ("Thu Jan 11 03:31:27 2024", 2, ms(2024, 1, 11, 8, 31, 27)),
    ("Wed Jan 10 18:00:01 UTC 2024", 2, ms(2024, 1, 10, 18, 0, 1)),
    ("13 janvier 2024 à 21h39", 1, ms(2024, 1, 13, 20, 39)),
    ("16 de enero de 2024, 00:52", None, ms(2024, 1, 16, 0, 52)),
    ("Jan 16, 2024 at 9:50 PM", None, ms(2024, 1, 16, 21, 50)),
    ("Friday, January 26, 2024 5:49:39 AM GMT+05:30", 1, ms(2024, 1, 26, 0, 19, 39)),
    ("2024-01-09 15:39:14 Asia/Kolkata", 1, ms(2024, 1, 9, 10, 9, 14)),
    ("2024-01-09 15:39:14 Asia/Nowhere", 1, None),
    ("2024-10-27 02:30:00", 1, ms(2024, 10, 27, 0, 30)),  # twice: the earlier
    ("2024-03-31 02:30:00", 1, ms(2024, 3, 31, 1, 30)),  # skipped: the offset before
    ("January 10, 2024", 1, ms(2024, 1, 9, 23)),
    ("1704903548.061", 1, ms(2024, 1, 10, 16, 19, 8, micro=61)),
    ("29 Feb 2025 08:00 +0100", 1, None),
    ("2025-04-31T09:00:00Z", 1, None),
    ("2024-01-09 24:01:00", 1, None),
    ("2024-01-09 10:00:00", 3, None),
    ("yesterday", 1, None),
    ("16:37", 1, None),
    ("Q3", 1, None),
    ("", 1, None),
    (None, 1, None),
    ("x" * 100_000, 1, None),
]


def test_dates(spark):
    mails = spark.createDataFrame([(i, d, None, m, "extra") for i, (d, m, _) in enumerate(CASES)], "row_idx long, date string, timestamp long, mailbox_id int, tz_name string")
    boxes = spark.createDataFrame(BOXES, "mailbox_id int, tz_name string, date_order string")
    got = {r["row_idx"]: r["utc_ms"] for r in to_utc_millis(mails, boxes).collect()}
    for i, (text, box, want) in enumerate(CASES):
        assert got.get(i) == want, (text and text[:40], box)


@pytest.mark.parametrize(("n", "want"), [(1704772684, 1704772684000), (1704772684432, 1704772684432), (1704772684432069, 1704772684432), (1704772684432069123, 1704772684432), (0, None), (-1, None), (9999, None), (253402300799000, None), (None, None)])
def test_counts(spark, n, want):
    mails = spark.createDataFrame([(1, None, n, None)], "row_idx long, date string, timestamp long, mailbox_id int")
    got = [r["utc_ms"] for r in to_utc_millis(mails, spark.createDataFrame(BOXES, "mailbox_id int, tz_name string, date_order string")).collect()]
    assert got == ([] if want is None else [want])


def test_empty(spark):
    mails = spark.createDataFrame([], "row_idx long, date string, timestamp long, mailbox_id int")
    assert to_utc_millis(mails, spark.createDataFrame(BOXES, "mailbox_id int, tz_name string, date_order string")).count() == 0
