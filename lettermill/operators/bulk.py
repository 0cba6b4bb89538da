"""Bulk filter: weak labels, features, TF-IDF logistic regression, two-gate decision, saved models."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lettermill import rx
from lettermill.config import DEFAULT, Config
from lettermill.operators.clean import clean_text
from lettermill.operators.html import readable
from lettermill.operators.lines import strip
from lettermill.operators.similarity import _terms, fit_vocabulary, term_counts, unit_weights
from lettermill.session import Scratch


def weak_category(text: Column) -> Column:
    """The first category one of whose phrases the text contains, else ``genuine``."""
    low = F.lower(F.coalesce(text, F.lit("")))
    chain = None
    for category, phrases in rx.WEAK_LABELS.items():
        hit = reduce(lambda a, b: a | b, [low.contains(p) for p in phrases])
        chain = F.when(hit, category) if chain is None else chain.when(hit, category)
    return chain.otherwise("genuine")


def with_labels(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``category`` and ``label`` (1 for automated)."""
    return df.withColumn("category", weak_category(F.col(text))).withColumn("label", (F.col("category") != "genuine").cast("int"))


def normalized(clean: Column) -> Column:
    """Lower case, marks for links and addresses, no underscores, single blanks."""
    t = F.regexp_replace(F.lower(clean), f"http{rx.NS}+", " url ")
    t = F.regexp_replace(t, f"{rx.NS}+@{rx.NS}+", " email ")
    return strip(F.regexp_replace(F.regexp_replace(t, "_+", " "), f"{rx.S}+", " "))


def clean_for_model(df: DataFrame, text: str = "text", out: str = "clean_text") -> DataFrame:
    d = df.withColumn(out, readable(F.col(text), False))
    return d.withColumn(out, normalized(clean_text(F.col(out), keep_history=False)))


FEATURES = ("contains_unsubscribe", "contains_ooo", "contains_do_not_reply", "contains_generated_by_ai", "contains_meeting_notes", "text_length", "num_urls", "num_reply_markers")


def with_features(df: DataFrame, text: str = "clean_text") -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    flag = lambda p: t.contains(p).cast("int")
    count = lambda p: F.regexp_count(t, F.lit(p)).cast("int")
    values = (flag("unsubscribe"), flag("out of office"), flag("do not reply"), flag("generated by ai"), flag("meeting notes"), F.length(t).cast("int"), count("url"), count("reply"))
    return df.withColumns(dict(zip(FEATURES, values, strict=True)))


def stratified_split(df: DataFrame, key: str, label: str, share: float = DEFAULT.test_share, seed: int = DEFAULT.seed) -> DataFrame:
    """Adds ``is_test``: of each label the ``share`` of rows with the smallest seeded hash.

    The cut is a percentile of hashes by label, so no label is ranked in one task.
    """
    h = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    d = df.withColumn("__h", h)
    cut = d.groupBy(label).agg(F.percentile_approx("__h", share, 10_000).alias("__cut"))
    return d.join(F.broadcast(cut), label).withColumn("is_test", F.col("__h") <= F.col("__cut")).drop("__h", "__cut")  # two labels


@dataclass
class BulkModel:
    """A fitted filter: ``terms (term, idf, coef)`` of a bounded vocabulary, the coefficients of ``FEATURES``, the intercept."""

    terms: DataFrame
    features: tuple[float, ...]
    intercept: float

    def save(self, path: str) -> None:
        self.terms.coalesce(1).write.mode("overwrite").parquet(f"{path}/terms")
        rest = self.terms.sparkSession.createDataFrame([(list(self.features), self.intercept)], "features array<double>, intercept double")
        rest.coalesce(1).write.mode("overwrite").json(f"{path}/rest")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BulkModel:
        rest = spark.read.schema("features array<double>, intercept double").json(f"{path}/rest").first()
        return BulkModel(spark.read.schema("term string, idf double, coef double").parquet(f"{path}/terms"), tuple(rest["features"]), rest["intercept"])


def train(df: DataFrame, config: Config = DEFAULT, key: str = "row_idx", fit_on: DataFrame | None = None) -> BulkModel:
    """Class-balanced logistic regression on the unit TF-IDF weights (sublinear counts) and features of ``clean_text``.

    The vocabulary is fitted on ``fit_on`` (default: ``df``): all rows, before the split. Vectors go to
    the learner as sparse text lines, so no row passes Python. With one label only, or no rows, there is
    nothing to separate: a ``ValueError`` says so.
    """
    n = {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}
    if len(n) < 2:
        raise ValueError("training needs rows of both labels")
    total = sum(n.values())
    spark, every = df.sparkSession, df if fit_on is None else fit_on
    scratch = Scratch(spark, "train")
    counts = scratch.cut(term_counts(every, key, "clean_text"))
    vocab = fit_vocabulary(counts, every.select(key).count(), config.bulk_vocabulary, config.max_df, config.bulk_min_df)
    # the vocabulary is bounded by its size: one window over it numbers the terms
    vocab = scratch.cut(vocab.withColumn("at", F.row_number().over(Window.orderBy("term"))))
    size = vocab.count()
    rows = with_features(df.select(F.col(key).cast("long").alias("k"), "label", "clean_text"))
    mine = unit_weights(counts.join(rows.select("k"), "k", "left_semi"), vocab, sublinear=True).join(vocab.select("term", "at"), "term")
    pair = lambda at, w: F.concat(at.cast("string"), F.lit(":"), w.cast("string"))
    sparse = mine.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("at", "w"))).alias("v"))
    words = F.coalesce(F.array_join(F.transform("v", lambda x: pair(x["at"], x["w"])), " "), F.lit(""))
    line = F.concat_ws(" ", F.col("label").cast("string"), words, *[pair(F.lit(size + 1 + i), F.col(c)) for i, c in enumerate(FEATURES)])
    path = f"{scratch.root}/vectors"
    rows.join(sparse, "k", "left").select(F.regexp_replace(line, " +", " ").alias("value")).write.text(path)
    vectors = spark.read.format("libsvm").option("numFeatures", size + len(FEATURES)).load(path)
    weighted = vectors.withColumn("w", F.when(F.col("label") == 1, total / (2.0 * n[1])).otherwise(total / (2.0 * n[0])))
    fitted = LogisticRegression(weightCol="w", maxIter=config.max_iter, regParam=1.0 / total, standardization=False).fit(weighted)
    coef = [float(x) for x in fitted.coefficients.toArray()]
    at = spark.createDataFrame(list(enumerate(coef[:size], 1)), "at int, coef double")
    terms = scratch.cut(vocab.join(at, "at").select("term", "idf", "coef"))
    scratch.keep_only(terms)
    return BulkModel(terms, tuple(coef[size:]), float(fitted.intercept))


def score(df: DataFrame, model: BulkModel) -> DataFrame:
    """Adds ``automation_probability``; the label column is not read.

    Row by row, so it runs on streams too and shuffles nothing: the terms of a row meet the model's
    vocabulary, whose size is bounded by the configuration, in an Arrow batch.
    """
    table = {r["term"]: (r["idf"], r["coef"]) for r in model.terms.collect()}
    weights, intercept = model.features, model.intercept

    def one(terms: Sequence[str], features: Sequence[float]) -> float:
        norm = total = 0.0
        for t, n in Counter(terms).items():
            if (got := table.get(t)) is not None:
                w = (1 + math.log(n)) * got[0]
                norm += w * w
                total += w * got[1]
        z = intercept + sum(a * b for a, b in zip(weights, features, strict=True)) + (total / math.sqrt(norm) if norm else 0.0)
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [one(t, f) for t, f in zip(b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(got, pa.float64())], names=[*b.schema.names[:-2], "automation_probability"])

    own = [c for c in df.columns if c != "automation_probability"]
    counted = with_features(df.withColumn("__terms", _terms(F.col("clean_text"))))
    d = counted.select(*own, "__terms", F.array(*[F.col(c).cast("double") for c in FEATURES]).alias("__features"))
    return d.mapInArrow(run, StructType([*[df.schema[c] for c in own], StructField("automation_probability", DoubleType())]))


def two_gates(heuristic: Column, probability: Column, threshold: float = DEFAULT.automation_threshold) -> Column:
    return F.when(heuristic == 1, 1).when(probability >= threshold, 1).otherwise(0)


def classify(df: DataFrame, model: BulkModel, threshold: float = DEFAULT.automation_threshold) -> DataFrame:
    """Adds ``is_filtered``: a phrase in the clean text decides, else the probability."""
    scored = score(df, model)
    gate = (weak_category(F.col("clean_text")) != "genuine").cast("int")
    return scored.withColumn("is_filtered", two_gates(gate, F.col("automation_probability"), threshold))


def split_filtered(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(genuine, filtered)`` rows."""
    return df.where("is_filtered = 0"), df.where("is_filtered = 1")


def confusion(df: DataFrame, label: str = "label", predicted: str = "is_filtered") -> DataFrame:
    return df.groupBy(F.col(label).cast("int").alias("label"), F.col(predicted).cast("int").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def class_report(conf: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support by class; 0.0 where a class was never predicted or never occurs."""
    side = lambda c: conf.groupBy(F.col(c).alias("class"))
    hit = conf.where("label = predicted").select(F.col("label").alias("class"), F.col("n").alias("hit"))
    real, said = side("label").agg(F.sum("n").alias("support")), side("predicted").agg(F.sum("n").alias("said"))
    d = real.join(said, "class", "full").join(hit, "class", "left").na.fill(0, ["support", "said", "hit"])
    p, r = F.coalesce(F.try_divide("hit", "said"), F.lit(0.0)), F.coalesce(F.try_divide("hit", "support"), F.lit(0.0))
    return d.select("class", p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"), "support")
