"""Records by id: keep the first or the last row of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str = "eid", order: str = "row_idx", last: bool = False) -> DataFrame:
    """One row a key, the one with the smallest (or largest) ``order``; ``order`` is a unique row number, a null key is one key.

    A narrow aggregate with map-side combine finds the rows: a key that holds a third of all rows is
    reduced before the exchange and never sorted in one task. The rows are then taken by their number,
    so columns that nobody asks for are not read.
    """
    pick = (F.max if last else F.min)(order)
    first = df.groupBy(key).agg(pick.alias("__pick")).select("__pick")
    return df.join(first, F.col(order) == F.col("__pick"), "left_semi")


def dedup_stats(df: DataFrame, key: str = "eid") -> DataFrame:
    """``before, after, dupes``; a null id counts as one id."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    sums = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("before"), F.count(F.lit(1)).alias("after"))
    return sums.select("before", "after", (F.col("before") - F.col("after")).alias("dupes"))
