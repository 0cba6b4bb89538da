"""Problem 1: bodies that look the same but differ in their characters.

Method: the confusables skeleton. Each body is decomposed, every character is
replaced by its prototype from the look-alike table, and the result is
decomposed again. Bodies with equal skeletons are one group.

Only two 128-bit digests a body leave the text stage. Groups with a single
variant are dropped by a map-side combined aggregate; pairs are made between
*variants* first and only then joined with rows, so a third of all rows with
one and the same body meet no comparison among themselves.

Defined results: null bodies and bodies without visible characters are in no
group; an empty table gives no row; rows with equal strings are no pair of
each other, but each pairs with every differing variant.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.text import share_look_alikes, skeleton
from lettermill.session import Scratch


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, look, raw = [], [], []
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            s = skeleton(t)
            if s and not s.isspace():
                ids.append(i)
                look.append(blake2b(s.encode("utf-8", "surrogatepass"), digest_size=16).digest())
                raw.append(blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(look, pa.binary()), pa.array(raw, pa.binary())], names=["__id", "__look", "__raw"])


def digests(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(__id, __look, __raw)``: digests of the skeleton and of the string itself."""
    share_look_alikes(df.sparkSession)
    rows = df.where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias("__id"), F.col(text).alias("__t"))
    return rows.mapInArrow(_digests, "__id long, __look binary, __raw binary")


def one_form(df: DataFrame, text: str, out: str = "one_form") -> DataFrame:
    """Adds the body in its one consistent form (composed skeleton); null stays null."""
    import unicodedata

    share_look_alikes(df.sparkSession)

    @F.pandas_udf("string")
    def form(s: pd.Series) -> pd.Series:
        return s.map(lambda t: unicodedata.normalize("NFC", skeleton(t)), na_action="ignore")

    return df.withColumn(out, form(F.col(text)))


def same_look_groups(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, look, variant, variants)`` of each row whose look has at least two variants: its group, its own variant of it and their number.

    One row a record: what ``same_look_pairs`` expands.
    """
    d = Scratch(df.sparkSession, "same-look").cut(digests(df, key, text))
    several = d.select("__look", "__raw").distinct().groupBy("__look").agg(F.count(F.lit(1)).alias("variants")).where("variants > 1")
    return d.join(several, "__look").select(F.col("__id").alias(key), F.hex("__look").alias("look"), F.hex("__raw").alias("variant"), "variants")


def same_look_pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(row_a, row_b)`` with different strings and equal skeletons, the smaller key first."""
    # the texts are read once; the narrow table of digests is what the joins read again
    d = Scratch(df.sparkSession, "same-look").cut(digests(df, key, text))
    groups = d.groupBy("__look").agg(F.min("__raw").alias("__lo"), F.max("__raw").alias("__hi")).where("__lo <> __hi").select("__look")
    rows = d.join(groups, "__look", "left_semi")
    variants = rows.select("__look", "__raw").distinct()
    v = variants.alias("a").join(variants.alias("b"), (F.col("a.__look") == F.col("b.__look")) & (F.col("a.__raw") < F.col("b.__raw")))
    v = v.select(F.col("a.__raw").alias("__ra"), F.col("b.__raw").alias("__rb"))
    a = rows.select(F.col("__raw").alias("__ra"), F.col("__id").alias("__x"))
    b = rows.select(F.col("__raw").alias("__rb"), F.col("__id").alias("__y"))
    p = v.join(a, "__ra").join(b, "__rb")
    return p.select(F.least("__x", "__y").alias("row_a"), F.greatest("__x", "__y").alias("row_b"))
