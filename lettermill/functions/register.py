"""Functions for use in SQL text."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lettermill import rx
from lettermill.operators.html import readable_text


def register(spark: SparkSession) -> None:
    """``lm_plain_text(body)``, ``lm_latest_html(body)``: rendered bodies with and without quoted elements; ``weak_label(text)`` and ``tokenize(text)``.

    They run in Arrow batches. In DataFrame code the expressions of ``operators`` do the same inside the JVM.
    """
    def of(keep: bool):  # noqa: ANN202
        @F.pandas_udf("string")
        def run(s: pd.Series) -> pd.Series:
            return s.map(lambda t: readable_text(t, keep))

        return run

    @F.pandas_udf("string")
    def weak_label(s: pd.Series) -> pd.Series:
        return s.map(lambda t: next((c for c, ps in rx.WEAK_LABELS.items() if any(p in (t or "").lower() for p in ps)), "genuine"))

    word = re.compile(r"(?<!\w)[a-z]{3,}(?!\w)")

    @F.pandas_udf("array<string>")
    def tokenize(s: pd.Series) -> pd.Series:
        return s.map(lambda t: list(dict.fromkeys(word.findall((t or "").lower()))))

    for name, f in (("lm_plain_text", of(True)), ("lm_latest_html", of(False)), ("weak_label", weak_label), ("tokenize", tokenize)):
        spark.udf.register(name, f)
