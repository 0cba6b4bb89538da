"""Queries of mixed timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lettermill.functions.instants import to_utc_millis
from lettermill.session import table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return to_utc_millis(table(spark, d, "thread_grouper"), table(spark, d, "mailboxes"))


QUERIES = {"p3_found": p3_found}
SQL: dict[str, str] = {}
