"""Threads: id links, clusters, duplicate split, thread ids, summaries, metrics and the choice of a method."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from threading import Event

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.config import DEFAULT, Config
from lettermill.operators import blocks
from lettermill.operators.components import connected_components

#: ids of the shape ``<local@host>``: a text that contains one shows it to this pattern whole
_SHAPE = r"<[^<>\s]+@[^<>\s]+>"
#: other ids are found by a piece of so many characters
_PIECE = 8


def id_links(df: DataFrame, key: str = "row_idx", eid: str = "eid", body: str = "raw_body") -> DataFrame:
    """``(i, j)``, ``i < j``: rows of which one's body contains the other's id. Empty and null ids link nothing.

    Ids of the usual shape are cut from the bodies and joined by equality. An id of any other shape
    (rare) is met by its rarest piece of ``_PIECE`` characters (all of it, if shorter), joined by
    equality with the pieces of the bodies that some id has, and then looked for in the body.
    """
    rows = df.select(F.col(key).cast("long").alias("k"), F.col(eid).alias("e"), F.col(body).alias("b"))
    ids = rows.where("e is not null and e <> ''").select(F.col("k").alias("j"), "e")
    usual = F.col("e").rlike(rf"\A{_SHAPE}\z")
    seen = rows.where("b is not null").select(F.col("k").alias("i"), F.explode(F.array_distinct(F.regexp_extract_all("b", F.lit(_SHAPE), F.lit(0)))).alias("e"))
    links = seen.join(ids.where(usual), "e").select("i", "j")
    # every length of piece that an id has: one for long ids, one for each shorter length
    odd = ids.where(~usual).withColumn("n", F.least(F.length("e"), F.lit(_PIECE)))
    lengths = [r["n"] for r in odd.select("n").distinct().collect()]  # at most _PIECE numbers
    spans = rows.where("b is not null").select(F.col("k").alias("i"), F.col("b"))
    for n in lengths:
        grams = lambda text, n=n: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda p: F.substr(text, p, F.lit(n))))  # noqa: E731, B023
        own = odd.where(F.col("n") == n).select("j", "e", F.explode(grams(F.col("e"))).alias("g"))
        often = own.groupBy("g").agg(F.count(F.lit(1)).alias("c"))
        rarest = own.join(often, "g").groupBy("j", "e").agg(F.min(F.struct("c", "g")).alias("m")).select("j", "e", F.col("m.g").alias("g"))
        said = spans.where(F.length("b") >= n).select("i", F.explode(grams(F.col("b"))).alias("g"))
        met = said.join(rarest.select("g").distinct(), "g", "left_semi").join(rarest, "g").select("i", "j", "e").distinct()
        links = links.union(met.join(spans, "i").where(F.col("b").contains(F.col("e"))).select("i", "j"))
    return links.where("i <> j").select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).distinct()


def clusters(rows: DataFrame, edges: DataFrame, key: str = "row_idx", body: str = "body_text") -> DataFrame:
    """``(key, comp)`` for every row: components of ``edges``; in each cluster only the first row of a body stays, the others stand alone."""
    comp = connected_components(edges.select("i", "j"))
    r = rows.select(F.col(key).cast("long").alias("v"), F.md5(F.coalesce(F.col(body), F.lit(""))).alias("h")).join(comp, "v", "left")
    r = r.withColumn("comp", F.coalesce("comp", "v"))
    # the first row of a body in a cluster, by a map-side combined aggregate
    first = r.groupBy("comp", "h").agg(F.min("v").alias("first"))
    r = r.join(first, ["comp", "h"])
    return r.select(F.col("v").alias(key), F.when(F.col("v") == F.col("first"), F.col("comp")).otherwise(-1 - F.col("v")).alias("comp"))


def thread_ids(rows: DataFrame, comps: DataFrame, key: str = "row_idx", eid: str = "eid") -> DataFrame:
    """Adds ``thread_id``: the digest of the cluster's sorted ids."""
    named = rows.join(comps, key)
    ids = named.groupBy("comp").agg(F.array_join(F.array_sort(F.collect_list(F.coalesce(F.col(eid), F.lit("")))), "|").alias("all"))
    tid = F.concat(F.lit("thread_"), F.substring(F.sha2(F.col("all"), 256), 1, 12))
    return named.join(ids.select("comp", tid.alias("thread_id")), "comp").drop("comp")


def grouping_method(size: Column, method: str) -> Column:
    return F.when(size > 1, F.lit(f"body_{method}")).otherwise(F.lit("singleton"))


def with_grouping(threaded: DataFrame, method: str) -> DataFrame:
    size = F.count(F.lit(1)).over(Window.partitionBy("thread_id"))
    return threaded.withColumn("grouping_method", grouping_method(size, method))


def thread_summary(threaded: DataFrame, method: str, people: str = "participants") -> DataFrame:
    """One row a thread: sorted ids and participants, first and last timestamp, size, method.

    Participants are made distinct before they are collected: a thread's row holds each once, not once a mail.
    """
    who = threaded.select("thread_id", F.explode(people).alias("p")).distinct().groupBy("thread_id").agg(F.array_sort(F.collect_list("p")).alias("participant_list"))
    s = threaded.groupBy("thread_id").agg(
        F.array_sort(F.collect_list("eid")).alias("constituent_eids"),
        F.min("timestamp").alias("earliest"),
        F.max("timestamp").alias("latest"),
        F.count(F.lit(1)).alias("email_count"),
    )
    return s.join(who, "thread_id", "left").select(
        "thread_id", "constituent_eids", F.coalesce("participant_list", F.array().cast("array<string>")).alias("participant_list"),
        F.struct("earliest", "latest").alias("timestamp_range"), "email_count", grouping_method(F.col("email_count"), method).alias("grouping_method"),
    )


def size_stats(summary: DataFrame) -> DataFrame:
    """``threads, multi, largest, smallest, mean_size``."""
    n = F.col("email_count")
    return summary.agg(F.count(F.lit(1)).alias("threads"), F.count_if(n > 1).alias("multi"), F.max(n).alias("largest"), F.min(n).alias("smallest"), F.bround(F.avg(n), 2).alias("mean_size"))


def cohesion(comps: DataFrame, pairs: DataFrame, key: str = "row_idx") -> DataFrame:
    """``(comp, cohesion)``: the mean similarity of all pairs in a cluster of two or more.

    Only non-zero similarities are joined; the pairs that share nothing count by the size of the
    cluster. ``pairs`` must hold every pair with a similarity above zero that lies in one cluster.
    """
    a, b = comps.select(F.col(key).alias("i"), F.col("comp").alias("ca")), comps.select(F.col(key).alias("j"), F.col("comp").alias("cb"))
    return mean_of(comps, pairs.join(a, "i").join(b, "j").where("ca = cb").select(F.col("ca").alias("comp"), F.col("sim").alias("s")))


def mean_of(comps: DataFrame, sums: DataFrame) -> DataFrame:
    """``(comp, cohesion)`` from sums ``(comp, s)`` of similarities, one or more a cluster."""
    size = comps.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    inside = sums.groupBy("comp").agg(F.sum("s").alias("s"))
    return size.join(inside, "comp", "left").select("comp", (F.coalesce("s", F.lit(0.0)) / (F.col("n") * (F.col("n") - 1) / 2)).alias("cohesion"))


def pairs_inside(rows: DataFrame, comps: DataFrame, tokens: str, key: str = "row_idx") -> DataFrame:
    """``(i, j, sim)`` Jaccard of the pairs of one cluster that share a token.

    Token by token within a cluster: no row carries a token set, and pairs that share nothing, which
    ``cohesion`` counts by the cluster's size, are never made.
    """
    many = comps.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("comp")
    r = rows.select(key, tokens).join(comps, key).join(many, "comp", "left_semi")
    sizes = r.select(F.col(key).alias("k"), F.size(tokens).alias("size"))
    t = r.select("comp", F.col(key).alias("k"), F.explode(tokens).alias("w"))
    met = t.select("comp", "w", F.col("k").alias("i")).join(t.select("comp", "w", F.col("k").alias("j")), ["comp", "w"]).where("i < j").groupBy("i", "j").agg(F.count(F.lit(1)).alias("c"))
    met = met.join(sizes.select(F.col("k").alias("i"), F.col("size").alias("si")), "i").join(sizes.select(F.col("k").alias("j"), F.col("size").alias("sj")), "j")
    return met.select("i", "j", (F.col("c") / (F.col("si") + F.col("sj") - F.col("c"))).alias("sim"))


#: rows of a cluster that a task meets with as many others
_PART = 8_192


def _parts(rows: DataFrame, comps: DataFrame, pairs: bool, key: str) -> DataFrame:
    """``rows (k, ..)`` of clusters of two or more, with ``comp``, ``own`` and ``part``, a part in one partition and in order.

    A cluster of over ``_PART`` rows has more parts: every two of its blocks (``pairs``), or each block.
    """
    size = comps.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("comp", F.ceil(F.col("n") / _PART).cast("int").alias("b"))
    r = rows.join(comps.join(size, "comp").withColumnRenamed(key, "k"), "k").withColumn("own", F.pmod(F.xxhash64(F.lit("part"), "k"), F.col("b")).cast("int"))
    if pairs:
        r = r.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("b") - 1)))
        lo, hi = F.least("own", "other"), F.greatest("own", "other")
        r = r.withColumn("part", (hi * (hi + 1) / 2 + lo).cast("int")).drop("other")
    else:
        r = r.withColumn("part", F.col("own"))
    return r.repartition("comp", "part").sortWithinPartitions("comp", "part", "own")


def _each_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole parts."""
    held, n, wait = [], 0, 4_096
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n < wait:
            continue
        t = pa.Table.from_batches(held)
        at = _starts(t)
        if len(at) > 1:
            yield t.slice(0, int(at[-1]))
            t = t.slice(int(at[-1]))
        held, n = t.to_batches(), t.num_rows
        wait = max(4_096, 2 * n)
    if n:
        yield pa.Table.from_batches(held)


def _starts(t: pa.Table) -> np.ndarray:
    comp, part = t.column("comp").to_numpy(), t.column("part").to_numpy()
    return np.concatenate(([0], np.flatnonzero((comp[1:] != comp[:-1]) | (part[1:] != part[:-1])) + 1))


def jaccard_sums(sets: DataFrame, comps: DataFrame, key: str = "row_idx") -> DataFrame:
    """``(comp, s)``: sums of the Jaccard similarities of all pairs of a cluster; ``sets (k, h)`` have hashes of tokens. No pair leaves its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _each_part(batches):
            h, off = blocks.lists(t.column("h"))
            comp, own, start = t.column("comp").to_numpy(), t.column("own").to_numpy(), _starts(t)
            sums = []
            for lo, hi in zip(start, [*start[1:], t.num_rows], strict=True):
                o = off[lo : hi + 1] - off[lo]
                first = int(np.searchsorted(own[lo:hi], own[hi - 1]))
                part = int(t.column("part")[int(lo)].as_py())
                last = int(own[hi - 1])
                if part == last * (last + 3) // 2:
                    first = 0  # a block with itself
                elif not first:
                    first = hi - lo  # the other block is empty
                sums.append(blocks.jaccard_sum(h[off[lo] : off[hi]], o, first, part == last * (last + 3) // 2))
            yield pa.RecordBatch.from_arrays([pa.array(comp[start]), pa.array(np.array(sums, np.float64))], names=["comp", "s"])

    return _parts(sets, comps, True, key).select("comp", "part", "own", "h").mapInArrow(run, "comp long, s double")


def cosine_sums(terms: DataFrame, idf: np.ndarray, comps: DataFrame, key: str = "row_idx") -> DataFrame:
    """``(comp, s)``: sums of the cosines of all pairs of a cluster; arguments of ``similarity.term_rows``.

    The cosines of all ordered pairs, each row with itself too, add up to the square of the sum of the
    unit rows, so no pair is made.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _each_part(batches):
            (tok, off), (tf, _) = blocks.lists(t.column("t")), blocks.lists(t.column("tf"))
            row = np.repeat(np.arange(t.num_rows), np.diff(off))
            w = tf * idf[tok]
            w /= np.sqrt(np.bincount(row, w * w, t.num_rows))[row]
            part = np.repeat(np.arange(len(start := _starts(t))), np.diff([*start, t.num_rows]))
            # one sum a part and term
            cell, at = np.unique(part[row] * len(idf) + tok, return_inverse=True)
            total = np.bincount(at, w, len(cell))
            own = np.bincount(at, w * w, len(cell))
            comp = t.column("comp").to_numpy()[start][cell // len(idf)]
            b = t.column("b").to_numpy()[start][cell // len(idf)]
            whole = b == 1
            c, n = np.unique(comp[whole], return_inverse=True)
            s = np.bincount(n, (total * total - own)[whole], len(c)) / 2
            yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(np.full(len(c), -1, np.int32)), pa.array(s), pa.array(np.zeros(len(c)))], names=["comp", "t", "a", "b"])
            o = ~whole
            yield pa.RecordBatch.from_arrays([pa.array(comp[o]), pa.array((cell % len(idf))[o].astype(np.int32)), pa.array(total[o]), pa.array(own[o])], names=["comp", "t", "a", "b"])

    sums = _parts(terms, comps, False, key).select("comp", "part", "b", "t", "tf").mapInArrow(run, "comp long, t int, a double, b double")
    sums = sums.groupBy("comp", "t").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return sums.select("comp", F.when(F.col("t") < 0, F.col("a")).otherwise((F.col("a") * F.col("a") - F.col("b")) / 2).alias("s"))


def metrics(comps: DataFrame, pairs: DataFrame, method: str, threshold: float, key: str = "row_idx") -> DataFrame:
    """One row: sizes, shares and mean cohesion of a clustering; rounded half to even. No rows give zeros."""
    return metrics_of(comps, cohesion(comps, pairs, key), method, threshold)


def metrics_of(comps: DataFrame, means: DataFrame, method: str, threshold: float) -> DataFrame:
    sizes = comps.groupBy("comp").agg(F.count(F.lit(1)).alias("n"))
    many = F.col("n") > 1
    s = sizes.agg(
        F.count(F.lit(1)).alias("total_threads"),
        F.count_if(many).alias("multi_email_threads"),
        F.count_if(~many).alias("singletons"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("emails"),
        F.coalesce(F.max("n"), F.lit(0)).alias("max_thread_size"),
        F.coalesce(F.sum(F.when(many, F.col("n"))), F.lit(0)).alias("emails_in_threads"),
    )
    c = means.agg(F.coalesce(F.avg("cohesion"), F.lit(0.0)).alias("c"))
    share = lambda x: F.bround(F.coalesce(F.try_divide(F.col(x) * 100, F.col("emails")), F.lit(0.0)), 1)
    one = s.withColumn("one", F.lit(1)).join(c.withColumn("one", F.lit(1)), "one")  # two one-row tables
    return one.select(
        F.lit(method).alias("method"), F.lit(threshold).alias("threshold"), "total_threads", "multi_email_threads", "singletons", share("singletons").alias("singleton_pct"),
        F.bround(F.coalesce(F.try_divide("emails", "total_threads"), F.lit(0.0)), 2).alias("avg_thread_size"), "max_thread_size", F.bround("c", 4).alias("avg_cohesion"),
        "emails_in_threads", share("emails_in_threads").alias("emails_in_threads_pct"),
    )


def chosen_method(jaccard_cohesion: float, tfidf_cohesion: float, ratio: float = DEFAULT.cohesion_ratio) -> str:
    return "jaccard" if tfidf_cohesion < jaccard_cohesion * ratio else "tfidf"


def evaluate(rows: DataFrame, links: DataFrame | None = None, config: Config = DEFAULT, key: str = "row_idx", text: str = "body_text") -> dict[str, tuple[DataFrame, DataFrame]]:
    """``{method: (clusters, metrics)}`` of both methods over ``rows``; ``links (i, j)`` merge whatever the method says."""
    from lettermill.operators import similarity
    from lettermill.session import Scratch

    spark = rows.sparkSession
    scratch = Scratch(spark, "evaluate")
    rows = scratch.cut(rows.select(key, text))

    linked = Event()

    def run(method: str, threshold: float) -> tuple[DataFrame, DataFrame]:
        scratch = Scratch(spark, method)
        if method == "tfidf":
            terms, idf = similarity.term_rows(rows, key, text, scratch, config.thread_vocabulary, config.max_df)
            scratch.settle()
            edges = similarity.cosine_links(terms, idf, threshold, config.near_identical)
        else:
            sets = scratch.cut(similarity.hashed_sets(rows, key, text))
            classes, common = similarity.classes_of(sets, scratch)
            scratch.settle()
            edges = similarity.jaccard_links(classes, common, threshold, config.near_identical)
        edges = scratch.cut(edges if links is None else edges.union(links))
        if method == "jaccard":
            scratch.drop(classes)
        scratch.settle()
        if method == "tfidf":
            linked.set()
        comps = scratch.cut(clusters(rows, edges, key, text))
        scratch.settle()
        linked.wait()  # the sets of whole clusters take as much disk as the cosine links' blocks
        sums = cosine_sums(terms, idf, comps, key) if method == "tfidf" else jaccard_sums(sets, comps, key)
        return comps, scratch.cut(metrics_of(comps, mean_of(comps, sums), "TF-IDF" if method == "tfidf" else "Jaccard", threshold))

    # neither needs the other: the small jobs of one run beside the long tasks of the other
    with ThreadPoolExecutor(2) as pool:
        both = {m: pool.submit(inheritable_thread_target(spark)(run), m, t) for m, t in (("tfidf", config.tfidf_threshold), ("jaccard", config.jaccard_threshold))}
        both["tfidf"].add_done_callback(lambda _: linked.set())
        return {m: f.result() for m, f in both.items()}


def choose(evaluated: dict[str, tuple[DataFrame, DataFrame]], ratio: float = DEFAULT.cohesion_ratio) -> str:
    """The method with the better rounded cohesion; two one-row tables are read."""
    c = {k: m.first()["avg_cohesion"] for k, (_, m) in evaluated.items()}
    return chosen_method(c["jaccard"], c["tfidf"], ratio)


def validate(threaded: DataFrame) -> None:
    """A null or empty thread id, or an id on two rows, is a ``ValueError``."""
    bad = threaded.agg(F.count_if(F.coalesce("thread_id", F.lit("")) == "").alias("blank")).first()["blank"]
    if bad:
        raise ValueError(f"{bad} rows have no thread id")
    if not threaded.groupBy("eid").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise ValueError("ids repeat")
