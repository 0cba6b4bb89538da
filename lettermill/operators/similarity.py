"""Token sets, exact Jaccard join, TF-IDF and exact cosine join.

No pairwise matrix exists: candidates meet on shared tokens or terms, and only
on those that can make a difference. Rows with one token set are one class
until the very end.
"""

from __future__ import annotations


from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.config import DEFAULT
from lettermill.functions.stopwords import STOP_WORDS
from lettermill.operators import blocks
from lettermill.operators.lines import let
from lettermill.session import Scratch


def tokens(text: Column) -> Column:
    """Distinct runs of word characters that are wholly three or more of a-z, in lower case."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    return F.array_distinct(F.filter(words, lambda w: w.rlike("^[a-z]{3,}$")))


def jaccard(a: Column, b: Column) -> Column:
    inter = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - inter
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(inter / union)


#: tokens that have a row of bits of their own, and rows that the others share; thresholds from ``STEEP`` on are joined by prefixes
COMMON, SHARED, STEEP = 8_192, 4_096, 0.8
#: sums of squared weights that bound the number of shared terms, and rows that are bounded together
LEVELS, TOGETHER = 9, 64


def jaccard_join(df: DataFrame, key: str, text: str, threshold: float = DEFAULT.jaccard_threshold, below: float | None = None) -> DataFrame:
    """``(i, j, sim)``, ``i < j``, for all pairs with Jaccard similarity of at least ``threshold`` (and under ``below``).

    Rows with one set are one class. Classes are joined by prefixes at high thresholds, and in pairs of
    blocks (``operators/blocks.py``) at low ones, where prefixes would keep most pairs; both are exact.
    """
    if threshold >= STEEP:
        pairs = _prefix_join(df, key, text, threshold)
        return pairs if below is None else pairs.where(F.col("sim") < below)
    scratch = Scratch(df.sparkSession, "jaccard")
    classes, common = set_classes(df, key, text, scratch)
    across = blocks.pair_up(classes, classes.count()).mapInArrow(_near_sets(threshold, below, common), "i long, j long, sim double")
    if below is not None and below <= 1.0:
        return across
    m = classes.where(F.size("ks") > 1).select("c", F.explode("ks").alias("k"))
    same = m.select("c", F.col("k").alias("i")).join(m.select("c", F.col("k").alias("j")), "c").where("i < j").select("i", "j", F.lit(1.0).alias("sim"))
    return across.union(same)


def set_classes(df: DataFrame, key: str, text: str, scratch: Scratch) -> tuple[DataFrame, int]:
    """``(c, often, seldom, ks)`` of each token set with its rows, and how many tokens have numbers.

    ``often`` holds the numbers of the most frequent tokens, ``seldom`` the hashes of the others.
    """
    return classes_of(scratch.cut(hashed_sets(df, key, text)), scratch)


def hashed_sets(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(k, h)``: sorted hashes of the tokens of each row that has some."""
    return df.select(F.col(key).cast("long").alias("k"), F.array_sort(F.transform(tokens(F.col(text)), lambda w: F.xxhash64(w))).alias("h")).where(F.size("h") > 0)


def classes_of(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """``set_classes`` of hashed sets."""
    freq = rows.select(F.explode("h").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    known = np.array(sorted(r["w"] for r in freq.orderBy(F.desc("df"), "w").limit(COMMON).collect()), np.int64)  # of bounded length

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, off = blocks.lists(pa.chunked_array([b.column(2)]))
            at = np.minimum(np.searchsorted(known, h), max(0, len(known) - 1))
            hit = known[at] == h
            to = lambda kept: np.concatenate(([0], np.cumsum(kept)))[off].astype(np.int32)
            often = pa.ListArray.from_arrays(pa.array(to(hit)), pa.array(at[hit].astype(np.int16)))
            seldom = pa.ListArray.from_arrays(pa.array(to(~hit)), pa.array(h[~hit]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), often, seldom], names=["k", "c", "often", "seldom"])

    packed = rows.select("k", F.xxhash64("h").alias("c"), "h").mapInArrow(numbered, "k long, c long, often array<short>, seldom array<long>")
    classes = packed.groupBy("c").agg(F.first("often").alias("often"), F.first("seldom").alias("seldom"), F.array_sort(F.collect_list("k")).alias("ks"))
    return scratch.cut(classes), len(known)


class _Sets:
    """Sets of one block in order of size, with the shared rows of seldom tokens behind the common ones."""

    def __init__(self, t: pa.Table, common: int) -> None:
        (o, oo), (s, so) = blocks.lists(t.column("often")), blocks.lists(t.column("seldom"))
        size = np.diff(oo) + np.diff(so)
        order = np.argsort(size, kind="stable")
        self.n = size[order]
        o, oo = blocks.reordered(o.astype(np.int64), oo, order)
        self.seldom, self.at = blocks.reordered(s, so, order)
        row = np.concatenate((np.repeat(np.arange(len(order)), np.diff(oo)), np.repeat(np.arange(len(order)), np.diff(self.at))))
        tok = np.concatenate((o, self.bucket(common)))
        self.tok, self.off = tok[np.argsort(row, kind="stable")], np.concatenate(([0], np.cumsum(self.n)))
        if "ks" in t.column_names:
            self.ks, self.kat = blocks.reordered(*blocks.lists(t.column("ks")), order)
        self.order = order

    def bucket(self, common: int) -> np.ndarray:
        return common + (self.seldom & (SHARED - 1))


def exact_counts(a: _Sets, b: _Sets, cols: blocks.Bits, common: int) -> Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """Takes from a count what only shares a row of bits with a seldom token."""
    ids = np.unique(b.seldom)
    own = np.sort(np.repeat(np.arange(len(b.n)), np.diff(b.at)) * (len(ids) + 1) + np.searchsorted(ids, b.seldom))

    def run(i: np.ndarray, j: np.ndarray, count: np.ndarray) -> np.ndarray:
        size = np.diff(a.at)[i]
        pair = np.repeat(np.arange(len(i)), size)
        h = a.seldom[blocks.spans(a.at[:-1][i], size)]
        hit = cols.has(common + (h & (SHARED - 1)), j[pair])
        pair, h = pair[hit], h[hit]
        if not len(pair):
            return count
        at = np.minimum(np.searchsorted(ids, h), len(ids) - 1)
        want = j[pair] * (len(ids) + 1) + at
        true = (ids[at] == h) & (own[np.minimum(np.searchsorted(own, want), len(own) - 1)] == want)
        return count - np.bincount(pair[~true], minlength=len(i))

    return run


def _near_sets(threshold: float, below: float | None, common: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, j, sim, a, b in near_sets(batches, threshold, below, common):
            x, y = np.diff(a.kat)[i], np.diff(b.kat)[j]
            if (x > 1).any() or (y > 1).any():
                many = x * y
                nth = blocks.spans(np.zeros(len(i), np.int64), many)
                wide = np.repeat(y, many)
                left, right = a.ks[np.repeat(a.kat[i], many) + nth // wide], b.ks[np.repeat(b.kat[j], many) + nth % wide]
                sim = np.repeat(sim, many)
            else:
                left, right = a.ks[a.kat[i]], b.ks[b.kat[j]]
            for at in range(0, len(left), 1 << 18):
                p, q = left[at : at + (1 << 18)], right[at : at + (1 << 18)]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q)), pa.array(sim[at : at + (1 << 18)])], names=["i", "j", "sim"])

    return run


def _words_needed(a: _Sets, b: _Sets, threshold: float) -> Callable[[int], tuple[int, int, np.ndarray]]:
    def need(n: int) -> tuple[int, int, np.ndarray]:
        lo, hi = np.searchsorted(b.n, threshold * n - 1e-9), np.searchsorted(b.n, n / threshold + 1e-9, "right")
        return int(lo), int(hi), np.maximum(1, np.ceil(threshold / (1 + threshold) * (n + b.n[lo:hi]) - 1e-9).astype(np.int64))

    return need


def near_sets(batches: Iterator[pa.RecordBatch], threshold: float, below: float | None, common: int) -> Iterator[tuple]:
    """``(i, j, sim, a, b)``: positions in the two blocks' sets of the pairs that reach the threshold, in parts of bounded size."""
    two = blocks.halves(batches)
    if two is None:
        return
    same = two[0] is two[1]
    a = _Sets(two[0], common)
    b = a if same else _Sets(two[1], common)
    cols = blocks.Bits(b.tok, b.off, common + SHARED)
    exact = exact_counts(a, b, cols, common)

    held: list[tuple] = []

    def out() -> tuple:
        i, j, count = map(np.concatenate, zip(*held, strict=True))
        held.clear()
        count = exact(i, j, count)
        sim = count / (a.n[i] + b.n[j] - count)
        ok = sim >= threshold
        if below is not None:
            ok &= sim < below
        return i[ok], j[ok], sim[ok], a, b

    n = 0
    for got in blocks.meeting(a.tok, a.off, a.n, cols, _words_needed(a, b, threshold), same):
        held.append(got)
        n += len(got[0])
        if n >= 200_000:
            yield out()
            n = 0
    if held:
        yield out()


def _prefix_join(df: DataFrame, key: str, text: str, threshold: float) -> DataFrame:
    """All pairs of at least ``threshold``.

    Exact prefix filter: two sets that reach the threshold share one of the rarest
    ``n - ceil(t n) + 1`` tokens of each, and their sizes are within ``t``. Classes of equal sets are
    joined once; rows meet within the class and across linked classes only.
    """
    scratch = Scratch(df.sparkSession, "jaccard")
    rows = df.select(F.col(key).cast("long").alias("k"), F.array_sort(tokens(F.col(text))).alias("s")).where(F.size("s") > 0)
    rows = scratch.cut(rows.withColumn("c", F.xxhash64("s")))
    classes = rows.groupBy("c").agg(F.first("s").alias("s"))
    freq = classes.select(F.explode("s").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    # tokens become numbers in order of rarity, so that a set sorts rarest first
    rank = freq.select("w", F.struct("df", F.xxhash64("w").alias("h")).alias("r"))
    sets = classes.select("c", F.explode("s").alias("w")).join(rank, "w").groupBy("c").agg(F.array_sort(F.collect_list("r")).alias("r"))
    sets = scratch.cut(sets.select("c", F.transform("r", lambda x: x["h"]).alias("s"), F.size("r").alias("n")))
    keep = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1
    prefix = sets.select("c", "n", F.explode(F.slice("s", F.lit(1), keep.cast("int"))).alias("w"))
    a = prefix.select(F.col("c").alias("a"), F.col("n").alias("na"), "w")
    b = prefix.select(F.col("c").alias("b"), F.col("n").alias("nb"), "w")
    near = (F.col("na") >= threshold * F.col("nb") - 1e-9) & (F.col("nb") >= threshold * F.col("na") - 1e-9)
    met = a.join(b, "w").where(F.col("a") < F.col("b")).where(near).select("a", "b").distinct()
    left = sets.select(F.col("c").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("c").alias("b"), F.col("s").alias("sb"))
    sim = met.join(left, "a").join(right, "b").select("a", "b", jaccard(F.col("sa"), F.col("sb")).alias("sim")).where(F.col("sim") >= threshold)
    sim = scratch.cut(sim)
    x, y = rows.select(F.col("c").alias("a"), F.col("k").alias("x")), rows.select(F.col("c").alias("b"), F.col("k").alias("y"))
    across = sim.join(x, "a").join(y, "b").select(F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "sim")
    copies = rows.groupBy("c").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("c")
    m = rows.select("c", "k").join(copies, "c", "left_semi")
    same = m.select("c", F.col("k").alias("i")).join(m.select("c", F.col("k").alias("j")), "c").where("i < j").select("i", "j", F.lit(1.0).alias("sim"))
    return across.union(same)


def edges_between(pairs: DataFrame, threshold: float = DEFAULT.jaccard_threshold, near_identical: float = DEFAULT.near_identical) -> DataFrame:
    """Pairs that link: at least ``threshold``, below ``near_identical``."""
    return pairs.where((F.col("sim") >= threshold) & (F.col("sim") < near_identical))


def _kept(text: Column) -> Column:
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(*STOP_WORDS))


def _with_pairs(kept: Column) -> Column:
    def joined(k: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.size(k) - 2), lambda i: F.concat(F.get(k, i), F.lit(" "), F.get(k, i + 1)))
        return F.when(F.size(k) > 1, F.concat(k, pairs)).otherwise(k)

    return let(kept, joined)


def _terms(text: Column) -> Column:
    return _with_pairs(_kept(text))


def term_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(k, term, tf)``: words and word pairs of each row."""
    rows = df.select(F.col(key).cast("long").alias("k"), F.explode(_terms(F.col(text))).alias("term"))
    return rows.groupBy("k", "term").agg(F.count(F.lit(1)).alias("tf"))


def fit_vocabulary(counts: DataFrame, n: int, vocabulary: int, max_df: float, min_df: int) -> DataFrame:
    """``(term, df, idf)`` of the ``vocabulary`` most frequent terms (ties: by term) that are in at most ``max_df`` of the ``n`` rows and in ``min_df`` rows."""
    return top_terms(counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")), n, vocabulary, max_df, min_df)


def top_terms(freq: DataFrame, n: int, vocabulary: int, max_df: float, min_df: int) -> DataFrame:
    top = freq.where((F.col("df") <= max_df * n) & (F.col("df") >= min_df)).orderBy(F.desc("total"), F.asc("term")).limit(vocabulary)
    return top.select("term", "df", (F.log((1.0 + n) / (1 + F.col("df"))) + 1).alias("idf"))


def unit_weights(counts: DataFrame, vocabulary: DataFrame, sublinear: bool) -> DataFrame:
    """``(k, term, w)``: weights of the terms of ``vocabulary``, rows of unit length."""
    tf = 1 + F.log("tf") if sublinear else F.col("tf").cast("double")
    raw = counts.join(vocabulary.select("term", "idf"), "term").select("k", "term", (tf * F.col("idf")).alias("w"))
    norm = raw.groupBy("k").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norm, "k").select("k", "term", (F.col("w") / F.col("norm")).alias("w"))


def tfidf(df: DataFrame, key: str, text: str, vocabulary: int = DEFAULT.thread_vocabulary, max_df: float = DEFAULT.max_df, min_df: int = 1, sublinear: bool = False) -> DataFrame:
    """``(k, term, w)``: weights of words and word pairs, rows of unit length.

    Terms in over ``max_df`` of the rows or under ``min_df`` rows are left out, then the ``vocabulary``
    most frequent stay (ties: by term). An empty vocabulary gives no rows.
    """
    counts = Scratch(df.sparkSession, "tfidf").cut(term_counts(df, key, text))
    return unit_weights(counts, fit_vocabulary(counts, df.select(key).count(), vocabulary, max_df, min_df), sublinear)


def term_rows(df: DataFrame, key: str, text: str, scratch: Scratch, vocabulary: int = DEFAULT.thread_vocabulary, max_df: float = DEFAULT.max_df) -> tuple[DataFrame, np.ndarray]:
    """``(k, t, tf)``: numbers and counts of the terms of ``tfidf``'s vocabulary, a row a text, and the terms' idf.

    The weights of ``tfidf`` follow from them (``_Weighted``). Terms outside the vocabulary never leave
    their text but as sums.
    """
    rows = scratch.cut(df.select(F.col(key).cast("long").alias("k"), _kept(F.col(text)).alias("words")))

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        once: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            terms = list(total)
            cols = [pa.array(terms, pa.string()), pa.array([once[t] for t in terms], pa.int64()), pa.array(list(total.values()), pa.int64())]
            total.clear()
            once.clear()
            return pa.RecordBatch.from_arrays(cols, names=["term", "one", "tf"])

        for b in batches:
            for words in b.column(0).to_pylist():
                words += [f"{x} {y}" for x, y in zip(words, words[1:])]  # noqa: B905, RUF007
                total.update(words)
                once.update(set(words))
                if len(total) > 200_000:
                    yield out()
        yield out()

    freq = rows.select("words").mapInArrow(seen, "term string, one long, tf long").groupBy("term").agg(F.sum("one").alias("df"), F.sum("tf").alias("total"))
    n = rows.count()
    top = top_terms(freq, n, vocabulary, max_df, 1).collect()  # of bounded length
    number = {r["term"]: k for k, r in enumerate(top)}

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, terms, often = [0], [], []
            for words in b.column(1).to_pylist():
                got: dict[int, int] = {}
                last = None
                for w in words:
                    for t in (w,) if last is None else (w, f"{last} {w}"):
                        if (k := number.get(t)) is not None:
                            got[k] = got.get(k, 0) + 1
                    last = w
                terms += got
                often += got.values()
                size.append(len(terms))
            off = pa.array(size, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(off, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(off, pa.array(often, pa.int32()))], names=["k", "t", "tf"])

    out = scratch.cut(rows.mapInArrow(counts, "k long, t array<int>, tf array<int>").where(F.size("t") > 0))
    scratch.drop(rows)
    return out, np.array([r["idf"] for r in top], np.float64)


def cosine_texts(terms: DataFrame, idf: np.ndarray, threshold: float = DEFAULT.tfidf_threshold, below: float | None = None) -> DataFrame:
    """``(i, j, sim)``, ``i < j``: pairs of texts with cosine of at least ``threshold`` (and under ``below``); arguments of ``term_rows``. In pairs of blocks, exact."""
    run = _pairs_out(lambda batches: near_weights(batches, idf, threshold, below))
    return blocks.pair_up(terms, terms.count()).mapInArrow(run, "i long, j long, sim double")


class _Weighted:
    """Unit rows of one block; neighbours have their weight in about as many terms."""

    def __init__(self, t: pa.Table, idf: np.ndarray, threshold: float) -> None:
        (tok, off), (tf, _) = blocks.lists(t.column("t")), blocks.lists(t.column("tf"))
        tok = tok.astype(np.int64)
        w = tf * idf[tok]
        size = np.diff(off)
        row = np.repeat(np.arange(len(size)), size)
        w /= np.sqrt(np.bincount(row, w * w, len(size)))[row]
        # how many of a row's largest squared weights reach a sum, for each sum of a scale from the threshold's square to 1
        down = np.lexsort((-w, row))
        sums = np.cumsum((w * w)[down])
        sums -= np.concatenate(([0.0], sums))[off[:-1]][row]
        low = max(threshold * threshold, 1e-6)
        self.scale = low ** (1 - np.arange(LEVELS) / (LEVELS - 1))
        reach = np.stack([np.bincount(row, sums < x - 1e-9, len(size)).astype(np.int64) + 1 for x in self.scale])
        order = np.lexsort((reach[0], reach[-2], reach[LEVELS // 2]))
        self.reach, self.k = reach[:, order], t.column("k").to_numpy()[order]
        self.kind = np.arange(len(size)) // TOGETHER
        self.tok, self.off = blocks.reordered(tok, off, order)
        self.w, _ = blocks.reordered(w, off, order)


def _weighted(two: tuple[pa.Table, pa.Table], idf: np.ndarray, threshold: float) -> tuple[_Weighted, _Weighted, bool]:
    same = two[0] is two[1]
    a = _Weighted(two[0], idf, threshold)
    return a, a if same else _Weighted(two[1], idf, threshold), same


def _terms_needed(a: _Weighted, b: _Weighted) -> Callable[[int], tuple[int, int, np.ndarray]]:
    def need(kind: int) -> tuple[int, int, np.ndarray]:
        own = a.reach[:, kind * TOGETHER : (kind + 1) * TOGETHER].min(axis=1)
        least = np.full(len(b.k), max(1, own[0]))
        for x, other in zip(own[1:-1], b.reach[-2:0:-1], strict=True):
            np.maximum(least, np.minimum(x, other), out=least)
        return 0, len(b.k), np.maximum(least, b.reach[0])

    return need


def _dot(a: _Weighted, b: _Weighted, wide: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of rows in order of ``i``; ``wide`` holds zeros, one a term."""
    sim = np.empty(len(i))
    cut = [0, *(np.flatnonzero(np.diff(i)) + 1), len(i)]
    size = b.off[j + 1] - b.off[j]
    end = np.cumsum(size)
    at = blocks.spans(b.off[j], size)
    tok, w = b.tok.take(at), b.w.take(at)
    start = end - size
    for lo, hi in zip(cut[:-1], cut[1:], strict=True):
        own = slice(a.off[i[lo]], a.off[i[lo] + 1])
        wide[a.tok[own]] = a.w[own]
        w[start[lo] : end[hi - 1]] *= wide.take(tok[start[lo] : end[hi - 1]])
        wide[a.tok[own]] = 0
    if len(i):
        np.add.reduceat(w, start, out=sim)
    return sim


def near_weights(batches: Iterator[pa.RecordBatch], idf: np.ndarray, threshold: float, below: float | None) -> Iterator[tuple]:
    """``(i, j, sim, a, b)``: positions in the two blocks' rows of the pairs that reach the threshold.

    A cosine is at most the root of the product of the squared weights that either row has in shared
    terms (Cauchy and Schwarz). With fewer shared terms than one row needs to hold ``s`` of its squared
    weight, and than the other needs for ``threshold ** 2 / s``, no pair reaches the threshold: this
    bounds the number of shared terms from below, for each ``s`` of a scale, and they are counted first.
    """
    two = blocks.halves(batches)
    if two is None:
        return
    a, b, same = _weighted(two, idf, threshold)
    cols, need, wide = blocks.Bits(b.tok, b.off, len(idf)), _terms_needed(a, b), np.zeros(len(idf))
    for i, j, _ in blocks.meeting(a.tok, a.off, a.kind, cols, need, same, counts=False):
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        sim = _dot(a, b, wide, i, j)
        ok = sim >= threshold
        if below is not None:
            ok &= sim < below
        if ok.any():
            yield i[ok], j[ok], sim[ok], a, b


def _pairs_out(near):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, j, sim, a, b in near(batches):
            p, q = a.k[i], b.k[j]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q)), pa.array(sim)], names=["i", "j", "sim"])

    return run


def cosine_links(terms: DataFrame, idf: np.ndarray, threshold: float, below: float) -> DataFrame:
    """``(i, j)``: links that connect what the pairs of ``cosine_texts`` connect. A task sends on its components, never its pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = blocks.halves(batches)
        if two is None:
            return
        a, b, same = _weighted(two, idf, threshold)
        wide, joined = np.zeros(len(idf)), blocks.Joined(len(a.k), len(b.k), same)

        def linked(i: np.ndarray, j: np.ndarray, _: np.ndarray) -> np.ndarray:
            order = np.argsort(i, kind="stable")
            sim = np.empty(len(i))
            sim[order] = _dot(a, b, wide, i[order], j[order])
            return (sim >= threshold) & (sim < below)

        met = blocks.meeting(a.tok, a.off, a.kind, blocks.Bits(b.tok, b.off, len(idf)), _terms_needed(a, b), same, joined.skip, counts=False)
        blocks.connected(met, joined, linked)
        key = a.k if same else np.concatenate((a.k, b.k))
        x, y = joined.stars()
        yield pa.RecordBatch.from_arrays([pa.array(key[x]), pa.array(key[y])], names=["i", "j"])

    return blocks.pair_up(terms, terms.count()).mapInArrow(run, "i long, j long").where("i <> j")


def jaccard_links(classes: DataFrame, common: int, threshold: float, below: float) -> DataFrame:
    """``(i, j)``: links that connect what the pairs of ``jaccard_join`` connect; arguments of ``set_classes``. Rows of one set are no pair (their similarity is not below), but what links their set links them all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = blocks.halves(batches)
        if two is None:
            return
        same = two[0] is two[1]
        a = _Sets(two[0], common)
        b = a if same else _Sets(two[1], common)
        cols, joined = blocks.Bits(b.tok, b.off, common + SHARED), blocks.Joined(len(a.n), len(b.n), same)
        exact = exact_counts(a, b, cols, common)

        def linked(i: np.ndarray, j: np.ndarray, count: np.ndarray) -> np.ndarray:
            count = exact(i, j, count)
            sim = count / (a.n[i] + b.n[j] - count)
            return (sim >= threshold) & (sim < below)

        blocks.connected(blocks.meeting(a.tok, a.off, a.n, cols, _words_needed(a, b, threshold), same, joined.skip), joined, linked)
        x, y = joined.stars()
        ks, kat = a.ks, a.kat
        if not same:
            ks, kat = np.concatenate((a.ks, b.ks)), np.concatenate((a.kat, b.kat[1:] + a.kat[-1]))
        size = kat[y + 1] - kat[y]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ks[kat[x]], size)), pa.array(ks[blocks.spans(kat[y], size)])], names=["i", "j"])

    return blocks.pair_up(classes, classes.count()).mapInArrow(run, "i long, j long").where("i <> j")


def cosine_join(weights: DataFrame, threshold: float = DEFAULT.tfidf_threshold) -> DataFrame:
    """``(i, j, sim)``, ``i < j``: pairs of unit rows with cosine of at least ``threshold``.

    Exact prefix filter on weights: with terms in one global order (rarest first), the squared weights
    of a row's suffix of norm below the threshold can be left out of the index: two rows whose cosine
    reaches it share a term before those suffixes. Candidates are then scored in full.
    """
    scratch = Scratch(weights.sparkSession, "cosine")
    w = scratch.cut(weights)
    freq = w.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    order = Window.partitionBy("k").orderBy(F.desc("df"), F.desc("term")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = w.join(freq, "term").withColumn("rest", F.sum(F.col("w") * F.col("w")).over(order))
    prefix = scratch.cut(ranked.where(F.col("rest") >= threshold * threshold - 1e-9).select("k", "term"))
    met = prefix.select(F.col("k").alias("i"), "term").join(prefix.select(F.col("k").alias("j"), "term"), "term").where("i < j").select("i", "j").distinct()
    packed = F.array_sort(F.collect_list(F.struct(F.xxhash64("term").alias("t"), "w")))
    vec = scratch.cut(w.groupBy("k").agg(packed.alias("v")).select("k", F.col("v.t").alias("t"), F.col("v.w").alias("w")))
    both = met.join(vec.select(F.col("k").alias("i"), F.col("t").alias("ti"), F.col("w").alias("wi")), "i").join(vec.select(F.col("k").alias("j"), F.col("t").alias("tj"), F.col("w").alias("wj")), "j")
    return both.select("i", "j", "ti", "wi", "tj", "wj").mapInArrow(_dots, "i long, j long, sim double").where(F.col("sim") >= threshold)


def _dots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Dot products of sorted sparse rows; one search a pair on views of the batch's arrays."""
    for b in batches:
        flat = [(c.flatten().to_numpy(), c.offsets.to_numpy()) for c in b.columns[2:]]
        (ti, oi), (wi, _), (tj, oj), (wj, _) = flat
        oi, oj = oi - oi[0], oj - oj[0]
        sim = np.empty(b.num_rows)
        for r in range(b.num_rows):
            a, x = ti[oi[r] : oi[r + 1]], wi[oi[r] : oi[r + 1]]
            c, y = tj[oj[r] : oj[r + 1]], wj[oj[r] : oj[r + 1]]
            at = np.minimum(np.searchsorted(c, a), len(c) - 1)
            hit = c[at] == a
            sim[r] = float(x[hit] @ y[at[hit]])
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sim)], names=["i", "j", "sim"])
