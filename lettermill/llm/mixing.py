"""Problem 9: mixing sources to target weights.

Method: Sainte-Lague apportionment. The size of the mix is cut into blocks of
``block_tokens`` tokens and the blocks are dealt to the sources by the highest
quotients ``share / (2 k + 1)``. A source is cut into shards by a seeded hash
(as many as its tokens ask for), and its seats are dealt to its shards by the
same rule, with the shards' tokens as weights. Within a shard the documents, in
seeded order, form blocks of equal tokens (up to one document), and blocks are
selected in a second seeded order, pass by pass, until the tokens of the
shard's seats are reached; the last block is taken if more than half of it is
still wanted, so a shard misses its quota by half a block at most.

The size is all tokens of the listed sources unless one is given. A source that
cannot fill its seats within ``max_repeats`` passes gives all it may, and the
report states what is missing (``shortfall_tokens``); the shares of the others
keep their proportions. ``largest_exact`` gives the largest size at which no
source with tokens falls short.

Defined results: sources that are listed but have nothing stay in the report
with zero; documents of sources that are not listed and of the null source are
not used; null and empty texts have no tokens and are never taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lettermill.llm.encode import VOCABULARY, token_counts
from lettermill.session import Scratch

#: tokens a shard holds about, and the most shards of a source
SHARD_TOKENS, MOST_SHARDS = 1 << 22, 4096


def dealt(parts: DataFrame, by: list[str], key: str) -> DataFrame:
    """``parts`` with ``won``: the ``seats`` of each group ``by`` dealt to its rows by weight ``w``, Sainte-Lague.

    Rounding ``w / W * seats`` to the nearest takes exactly the quotients from ``W / (2 seats)`` on; the
    few seats that are then over or missing, half as many as rows at most, go back or out by quotient
    order. Ties go to the key that sorts first.
    """
    w = Window.partitionBy(*by)
    p = parts.where("w > 0").withColumn("won", F.floor(F.col("w") / F.sum("w").over(w) * F.col("seats") + 0.5).cast("long"))
    p = p.withColumn("__d", F.col("seats") - F.sum("won").over(w))
    step = F.when(F.col("__d") > 0, F.col("won") + F.col("__x")).otherwise(F.col("won") - 1 - F.col("__x"))
    offers = p.where("__d <> 0").select(*by, key, "w", "won", "__d", F.explode(F.sequence(F.lit(0), F.abs("__d") - 1)).alias("__x")).withColumn("__k", step).where("__k >= 0")
    offers = offers.withColumn("__q", F.signum("__d") * F.col("w") / (2 * F.col("__k") + 1))
    names = offers.select(*by, key).distinct().withColumn("__n", F.row_number().over(w.orderBy(key)))
    offers = offers.join(names, [*by, key]).withColumn("__r", F.row_number().over(w.orderBy(F.desc("__q"), F.signum("__d") * F.col("__n"), "__x")))
    moved = offers.where(F.col("__r") <= F.abs("__d")).groupBy(*by, key).agg(F.sum(F.signum("__d")).cast("long").alias("__m"))
    return p.join(moved, [*by, key], "left").withColumn("won", F.col("won") + F.coalesce("__m", F.lit(0))).drop("__d", "__m")


def apportion(targets: DataFrame, blocks: int) -> DataFrame:
    """``(source, seats)`` of the sources with a positive share."""
    t = targets.select(F.lit(0).alias("all"), "source", F.col("target_share").cast("double").alias("w"), F.lit(blocks).cast("long").alias("seats"))
    return dealt(t, ["all"], "source").select("source", F.col("won").alias("seats"))


def largest_exact(plan: DataFrame) -> int:
    """The largest size at which no source with tokens falls short; ``plan`` as in the report."""
    live = F.when((F.col("available_tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0), F.col("target_share"))
    return int(plan.agg(F.min(F.col("available_tokens") * F.col("max_repeats") / live)).first()[0] or 0)


def mix(docs: DataFrame, targets: DataFrame, block_tokens: int = 512, size: int | None = None, seed: int = 11, path: str = VOCABULARY, shard_tokens: int = SHARD_TOKENS) -> tuple[DataFrame, DataFrame]:
    """``(selection, report)``.

    selection: ``doc_id, source, n_tokens, repeats``. report: one row a listed source, with seats,
    quota, tokens reached and missing, the target and the actual share.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    t = targets.select("source", F.col("target_share").cast("double").alias("target_share"), F.coalesce(F.col("max_repeats").cast("long"), F.lit(0)).alias("max_repeats"))
    mine = docs.select("doc_id", "source", "text").join(t.select("source"), "source", "left_semi")
    sized = scratch.cut(token_counts(mine, "doc_id", "text", path, keep=["source"]).where("n_tokens > 0"))
    have = sized.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"), F.count(F.lit(1)).alias("docs"))
    plan = scratch.cut(t.join(have, "source", "left").na.fill(0, ["available_tokens", "docs"]))
    if size is None:
        size = int(plan.agg(F.sum("available_tokens")).first()[0] or 0)
    blocks = max(1, round(size / block_tokens)) if size > 0 else 0
    plan = plan.join(apportion(t, blocks), "source", "left").na.fill(0, ["seats"])
    many = F.least(F.lit(MOST_SHARDS), F.ceil(F.col("available_tokens") / shard_tokens)).cast("long")
    plan = scratch.cut(plan.withColumn("shards", F.greatest(many, F.lit(1))).withColumn("quota_tokens", F.col("seats") * block_tokens))

    # shards, and the seats of each
    h = F.xxhash64("doc_id", F.lit(seed))
    s = sized.join(plan.select("source", "seats", "shards", "max_repeats"), "source").withColumn("h", h).withColumn("shard", F.pmod(F.shiftrightunsigned("h", 20), F.col("shards")))
    sums = s.groupBy("source", "shard").agg(F.sum("n_tokens").alias("w"), F.first("seats").alias("seats"), F.first("max_repeats").alias("max_repeats"))
    shards = dealt(sums, ["source"], "shard").select("source", "shard", F.col("w").alias("shard_total"), "max_repeats", (F.col("won") * block_tokens).alias("want"))
    # documents of a shard in seeded order form blocks of equal tokens
    inside = Window.partitionBy("source", "shard").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    s = s.select("doc_id", "source", "n_tokens", "shard", "h").join(shards, ["source", "shard"])
    middle = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)) + F.col("n_tokens") / 2
    n_blocks = F.greatest(F.lit(1), F.round(F.col("shard_total") / block_tokens))
    s = s.withColumn("block", F.floor(middle * n_blocks / F.col("shard_total")).cast("long"))
    # blocks in seeded order, pass by pass
    b = s.groupBy("source", "shard", "block").agg(F.sum("n_tokens").alias("t"), F.first("shard_total").alias("all"), F.first("want").alias("want"), F.first("max_repeats").alias("max_repeats"))
    order = Window.partitionBy("source", "shard").orderBy(F.xxhash64("source", "shard", "block", F.lit(seed)), "block").rowsBetween(Window.unboundedPreceding, -1)
    passes = F.floor((F.col("want") - F.coalesce(F.sum("t").over(order), F.lit(0)) - F.col("t") / 2) / F.col("all")) + 1
    b = b.withColumn("repeats", F.least(F.greatest(passes, F.lit(0)), F.col("max_repeats")).cast("long"))
    taken = b.where("repeats > 0").select("source", "shard", "block", "repeats")
    selection = scratch.cut(s.join(taken, ["source", "shard", "block"]).select("doc_id", "source", "n_tokens", "repeats"))

    got = selection.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("mixed_tokens"), F.max("repeats").alias("most_repeats"))
    r = plan.join(got, "source", "left").na.fill(0, ["mixed_tokens", "most_repeats"])
    all_got = F.sum("mixed_tokens").over(Window.partitionBy())  # one row a listed source
    report = r.select(
        "source",
        F.round("target_share", 6).alias("target_share"),
        "max_repeats",
        "docs",
        "available_tokens",
        F.col("seats").alias("blocks"),
        "quota_tokens",
        "mixed_tokens",
        F.greatest(F.lit(0), F.col("quota_tokens") - F.col("available_tokens") * F.col("max_repeats")).alias("shortfall_tokens"),
        "most_repeats",
        F.when(all_got > 0, F.round(F.col("mixed_tokens") / all_got, 6)).otherwise(0.0).alias("actual_share"),
    )
    return selection, report
