"""Problem 6: pairwise matches to groups.

Method: low-diameter decomposition. At each level every vertex draws a start
shift from an exponential law (by hash of vertex, level and seed, so a retried
task draws the same); clusters grow from the vertices, each vertex joining the
cluster that reaches it first, until no vertex changes (a cluster's radius is
at most the largest shift, about ``ln(n) / beta``); clusters contract to
super-vertices, and the level repeats on the distinct edges between clusters.
The assignments of all levels are composed.

A vertex that hears an earlier start takes that start's centre, so every
super-vertex with an edge either absorbs a neighbour or is absorbed with
constant probability, and the edges shrink geometrically from level to level.
Messages to a hot vertex are reduced map-side before the exchange; its edges meet
its state in a join whose skewed partitions the engine splits at run time; no
group is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.session import Scratch


def _shift(v: Column, level: int, seed: int, beta: float) -> Column:
    """Exp(beta) from 52 hashed bits."""
    u = (F.shiftrightunsigned(F.xxhash64(v, F.lit(level), F.lit(seed)), 12).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / F.lit(beta)


def _level(edges: DataFrame, level: int, seed: int, beta: float, scratch: Scratch) -> DataFrame:
    """``(v, c)``: vertex and the centre of its cluster; ``edges`` hold both directions."""
    # the first round needs no join: each end of an edge knows the other's shift
    own = F.struct((-_shift(F.col("v"), level, seed, beta)).alias("t"), F.col("v").alias("c"))
    state = edges.groupBy("v").agg(F.min(F.struct((1 - _shift(F.col("w"), level, seed, beta)).alias("t"), F.col("w").alias("c"))).alias("n"))
    state = scratch.cut(state.select("v", F.least(own, F.col("n")).alias("s"), (F.col("n") < own).alias("moved")))
    while True:
        # only vertices that moved have news
        news = state.where("moved").select(F.col("v").alias("w"), "s")
        told = edges.join(news, "w").groupBy("v").agg(F.min(F.struct((F.col("s.t") + 1).alias("t"), F.col("s.c").alias("c"))).alias("n"))
        new = scratch.cut(state.join(told, "v", "left").select("v", F.least("s", "n").alias("s"), F.coalesce(F.col("n") < F.col("s"), F.lit(False)).alias("moved")))
        scratch.drop(state)
        state = new
        if state.where("moved").isEmpty():
            return state.select("v", F.col("s.c").alias("c"))


def components(edges: DataFrame, seed: int = 7, beta: float = 0.4, name: str = "groups") -> DataFrame:
    """``(v, group)`` for every vertex of ``edges (v, w)`` (long ids, any direction, repeats and loops allowed).

    ``group`` is the id of one vertex of the component. Vertices with loops only are left out.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark, name)
    e = edges.where("v <> w").select(F.least("v", "w").alias("v"), F.greatest("v", "w").alias("w")).distinct()
    e = scratch.cut(e.select(F.explode(F.array(F.struct("v", "w"), F.struct(F.col("w").alias("v"), F.col("v").alias("w")))).alias("e")).select("e.v", "e.w"))
    found: DataFrame | None = None
    level = 0
    while not e.isEmpty():
        at = _level(e, level, seed, beta, scratch)
        if found is None:
            found = scratch.cut(at.select("v", F.col("c").alias("group")))
        else:
            found = scratch.cut(found.join(at.select(F.col("v").alias("group"), "c"), "group", "left").select("v", F.coalesce("c", "group").alias("group")))
        new = e.join(at, "v").select("w", F.col("c").alias("cv")).join(at.select(F.col("v").alias("w"), F.col("c").alias("cw")), "w")
        e = scratch.cut(new.where("cv <> cw").select(F.col("cv").alias("v"), F.col("cw").alias("w")).distinct())
        scratch.keep_only(found, e)
        level += 1
    return e.select("v", F.col("w").alias("group")) if found is None else found


def mail_groups(mails: DataFrame, pairs: DataFrame, low: float = 0.35, high: float = 0.99, forced: str = "message_id") -> DataFrame:
    """``(eid, group_eid)`` for each eid in a group of at least two eids; ``group_eid`` is the smallest of the group.

    Rows with one eid are one record. Rows link by an equal non-empty ``thread_id``, or by a pair of
    ``pairs`` that is ``forced`` or has ``low <= sim < high``; pairs with null or NaN ``sim``, with
    null ends, with themselves or with rows that do not exist link nothing. Null eids are left out.
    """
    scratch = Scratch(mails.sparkSession, "mail-groups")
    rows = mails.where("eid is not null").select(F.col("eid").alias("e"), F.col("row_idx").cast("long").alias("r"), F.nullif(F.col("thread_id"), F.lit("")).alias("t"))
    # the smallest row number stands for an eid
    ids = rows.groupBy("e").agg(F.min("r").alias("v"))
    known = scratch.cut(rows.join(ids, "e").select("e", "v", "r", "t"))
    # every row of a thread to the thread's smallest vertex: a star, so a hot thread makes no pairs
    hubs = known.where("t is not null").groupBy("t").agg(F.min("v").alias("w"))
    stars = known.where("t is not null").join(hubs, "t").select("v", "w")
    near = (F.col("sim") >= low) & (F.col("sim") < high) & ~F.isnan("sim")
    p = pairs.where("i is not null and j is not null and i <> j").where((F.col("match_method") == forced) | near)
    p = p.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).distinct()
    a = known.select(F.col("r").alias("i"), "v")
    b = known.select(F.col("r").alias("j"), F.col("v").alias("w"))
    links = p.join(a, "i").join(b, "j").select("v", "w")
    got = components(stars.union(links))
    named = known.select("v", "e").distinct().join(got, "v")
    least = named.groupBy("group").agg(F.min("e").alias("g"))
    out = scratch.cut(named.join(least, "group").select(F.col("e").alias("eid"), F.col("g").alias("group_eid")))
    scratch.keep_only(out)
    return out
