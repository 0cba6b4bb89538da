"""Problem 2: near-duplicate records with small edits.

Method: deletion-variant signatures. A record's word set is reduced to a
signature of ``SEGMENTS * WIDTH`` min-hash symbols, cut into so few segments
that two similar records have a segment that differs in at most one symbol.
Every segment is indexed once for each of its symbols with that symbol replaced
by a wildcard; equality of an index entry is a candidate, and candidates are
verified with the exact word sets.

How it is laid out:

* Records with one word set are one class; the work below is on classes, and
  the classes are expanded to records at the end only.
* A segment with one difference has a half without any, so a segment is sent
  twice, keyed by either half, and the wildcard variants of the other half are
  made after the exchange, not before it. Rows arrive sorted by half (the sort
  spills), and one half's rows at a time are matched as arrays.
* With a row travels a 192-bit one-bit min-hash sketch: pairs whose sketches
  agree too little to have the wanted similarity (``SLACK`` standard deviations)
  and pairs whose sizes rule it out are dropped inside the task.
* Survivors are made distinct and joined with the word sets by equality. The
  verdict is exact but for equal 32-bit hashes of different words in one pair
  (about one pair in a million).

At similarity 0.7, the threshold, a pair has no agreeing segment with
probability 0.0008, at 0.75 with 0.00005, and below 1e-6 from 0.8 on; the sketch
drops another 0.00001 at 0.7. There is no exact way beside it: a segment of the
word sets themselves that is exact at 0.7 holds five words or so, and about 1 %
of random pairs would become candidates.

Defined results: null and blank texts and texts with fewer than ``least`` words
are in no pair; null ids are left out; an empty table gives no pair.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.session import Scratch

SEGMENTS, WIDTH, SKETCH, SLACK = 13, 6, 192, 4.3
#: runs of word characters that are wholly a-z, three letters or more
WORDS = re.compile(r"(?<!\w)[a-z]{3,}(?!\w)", re.ASCII)
_WIDE = re.compile(r"(?<!\w)[a-z]{3,}(?!\w)")
_GROUP, _BLOCK = 4096, 2_000_000


def _word_hash(w: str) -> int:
    import xxhash

    return xxhash.xxh32_intdigest(w)


class _Hashes(dict):
    def __missing__(self, w: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[w] = _word_hash(w)
        return h


_HASH = _Hashes()


def word_set(text: str) -> set[str]:
    text = text.lower()
    return set((WORDS if text.isascii() else _WIDE).findall(text))


def _sets(least: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            ids, cls, words = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                s = word_set(t)
                if len(s) >= least:
                    a = np.unique(np.fromiter((_HASH[w] for w in s), np.uint32, len(s)))
                    ids.append(i)
                    cls.append(xxhash.xxh3_64_intdigest(a.tobytes()) - (1 << 63))
                    words.append(a.view(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(cls, pa.int64()), pa.array(words, pa.list_(pa.int32()))], names=["id", "cls", "words"])

    return run


def _law(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    g = np.random.Generator(np.random.PCG64(seed))
    return g.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), g.integers(0, 1 << 63, n, dtype=np.uint64)


def _mins(flat: np.ndarray, at: np.ndarray, law: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Min-hash symbols, one row a record."""
    x = flat.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    h = np.empty((len(at), len(law[0])), np.uint32)
    for k, (a, b) in enumerate(zip(*law, strict=True)):  # a column at a time stays in cache
        h[:, k] = np.minimum.reduceat(((x * a + b) >> np.uint64(32)).astype(np.uint32), at)
    return h


def signatures(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols ``(n, SEGMENTS, WIDTH)`` and sketch bits ``(n, SKETCH / 64)``."""
    size = np.fromiter((len(w) for w in words), np.int64, len(words))
    at = np.concatenate(([0], np.cumsum(size)[:-1]))
    flat = np.concatenate(words).view(np.uint32)
    sym = _mins(flat, at, _law(1, SEGMENTS * WIDTH)).reshape(-1, SEGMENTS, WIDTH)
    bits = (_mins(flat, at, _law(2, SKETCH)) >> np.uint32(7)) & np.uint32(1)
    sketch = np.packbits(bits.astype(np.uint8), axis=1).view(np.uint64)
    return sym, sketch


def _fold(x: np.ndarray) -> np.ndarray:
    """One 64-bit key of the last axis."""
    k = np.zeros(x.shape[:-1], np.uint64)
    for i in range(x.shape[-1]):
        k = (k ^ x[..., i].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        k ^= k >> np.uint64(32)
    return k


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each class and segment two rows: the key of a half, and the other half's three symbols in 63 bits."""
    half = WIDTH // 2
    for b in batches:
        for lo in range(0, b.num_rows, 512):
            s = b.slice(lo, 512)
            words = [np.asarray(w, np.int32) for w in s.column(1).to_pylist()]
            sym, sketch = signatures(words)
            n = len(words)
            keys, rest = [], []
            for side in (0, 1):
                mine, other = (sym[:, :, :half], sym[:, :, half:]) if side == 0 else (sym[:, :, half:], sym[:, :, :half])
                where = (np.arange(SEGMENTS, dtype=np.uint32) * 2 + side)[None, :, None].repeat(n, 0)
                keys.append(_fold(np.concatenate([where, mine], axis=2)))
                o = other.astype(np.uint64) & np.uint64(0x1FFFFF)
                rest.append(o[..., 0] << np.uint64(42) | o[..., 1] << np.uint64(21) | o[..., 2])
            reps = 2 * SEGMENTS
            cls = np.tile(s.column(0).to_numpy(), reps)
            order = lambda parts: np.concatenate([p.T.reshape(-1) for p in parts])
            cols = [pa.array(order(keys).view(np.int64)), pa.array(order(rest).astype(np.int64)), pa.array(cls), pa.array(np.tile(np.fromiter(map(len, words), np.int32, n), reps))]
            cols += [pa.array(np.tile(sketch[:, k].view(np.int64), reps)) for k in range(sketch.shape[1])]
            yield pa.RecordBatch.from_arrays(cols, names=["half", "rest", "cls", "n", *[f"s{k}" for k in range(sketch.shape[1])]])


def _pairs_of_runs(start: np.ndarray, length: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of positions inside runs, in blocks of bounded size; long runs are taken row by row."""
    small = length <= _GROUP
    for ln in np.unique(length[small]):
        x, y = np.triu_indices(int(ln), 1)
        st = start[small & (length == ln)]
        step = max(1, _BLOCK // len(x))
        for i in range(0, len(st), step):
            s = st[i : i + step, None]
            yield (s + x).reshape(-1), (s + y).reshape(-1)
    for s, ln in zip(start[~small], length[~small], strict=True):
        for i in range(int(ln) - 1):
            j = np.arange(s + i + 1, s + ln)
            yield np.full(len(j), s + i), j


#: pairs a task holds before it hands them on
_HELD = 500_000


def _match(rows: list[np.ndarray], threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidates among the rows of some halves, in parts of bounded size: variants of the other half are made here."""
    half, rest, cls, n = rows[:4]
    sketch = np.stack([c.view(np.uint64) for c in rows[4:]], axis=1)
    p = (1 + threshold) / 2
    agree = SKETCH * p - SLACK * (SKETCH * p * (1 - p)) ** 0.5
    found: list[np.ndarray] = []
    held = 0
    key = _fold(half[:, None].view(np.uint64))

    def out() -> tuple[np.ndarray, np.ndarray]:
        u = np.unique(np.concatenate(found), axis=0)
        found.clear()
        return u[:, 0], u[:, 1]

    for wild in range(WIDTH // 2):
        mask = np.int64(~(0x1FFFFF << (21 * wild)))
        v = (key ^ (rest & mask).view(np.uint64) * np.uint64(0xA24BAED4963EE407)) * np.uint64(0x9FB21C651E98DF25)
        order = np.argsort(v, kind="stable")
        sv = v[order]
        cut = np.flatnonzero(np.concatenate(([True], sv[1:] != sv[:-1])))
        length = np.diff(np.append(cut, len(sv)))
        many = length > 1
        for x, y in _pairs_of_runs(cut[many], length[many]):
            a, b = order[x], order[y]
            na, nb = n[a], n[b]
            ok = np.minimum(na, nb) >= threshold * np.maximum(na, nb)
            a, b = a[ok], b[ok]
            differ = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1, dtype=np.int32)
            ok = SKETCH - differ >= agree
            a, b = cls[a[ok]], cls[b[ok]]
            ok = a != b
            if ok.any():
                found.append(np.stack([np.minimum(a[ok], b[ok]), np.maximum(a[ok], b[ok])], axis=1))
                held += int(ok.sum())
                if held >= _HELD:
                    yield out()
                    held = 0
    if found:
        yield out()


def _candidates(threshold: float):  # noqa: ANN202
    """Reads rows sorted by half; holds the rows of whole halves, about 64k at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for a, b in _match(rows, threshold):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        held: list[list[np.ndarray]] = []
        count = 0
        for b in batches:
            cols = [c.to_numpy() for c in b.columns]
            held.append(cols)
            count += len(cols[0])
            if count < 65_536:
                continue
            rows = [np.concatenate(c) for c in zip(*held, strict=True)]
            last = rows[0][-1]
            done = int(np.searchsorted(rows[0], last, "left"))  # the last half may go on
            if done:
                yield from out([c[:done] for c in rows])
            held, count = [[c[done:] for c in rows]], len(rows[0]) - done
        if count:
            yield from out([np.concatenate(c) for c in zip(*held, strict=True)])

    return run


def similar_classes(df: DataFrame, key: str, text: str, threshold: float = 0.7, least: int = 20) -> tuple[DataFrame, DataFrame]:
    """``(members, links)``: ``(id, cls)`` of each record, and ``(a, b)`` of each two similar classes."""
    scratch = Scratch(df.sparkSession, "similar")
    texts = df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("string").alias("id"), F.col(text).alias("t"))
    rows = scratch.cut(texts.mapInArrow(_sets(least), "id string, cls long, words array<int>"))
    members = scratch.cut(rows.select("id", "cls").distinct())
    sets = scratch.cut(rows.groupBy("cls").agg(F.first("words").alias("words")))
    scratch_sketch = ", ".join(f"s{k} long" for k in range(SKETCH // 64))
    index = sets.mapInArrow(_index, f"half long, rest long, cls long, n int, {scratch_sketch}")
    near = index.repartition("half").sortWithinPartitions("half").mapInArrow(_candidates(threshold), "a long, b long").distinct()
    left = sets.select(F.col("cls").alias("a"), F.col("words").alias("wa"))
    right = sets.select(F.col("cls").alias("b"), F.col("words").alias("wb"))
    both = near.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("wa", "wb"))
    links = scratch.cut(both.where(common >= F.lit(threshold) * (F.size("wa") + F.size("wb") - common) - 1e-9).select("a", "b"))
    scratch.keep_only(members, links)
    return members, links


def similar_pairs(df: DataFrame, key: str, text: str, threshold: float = 0.7, least: int = 20) -> DataFrame:
    """``(eid_a, eid_b)``, the smaller first: records of one class and of two similar classes."""
    members, links = similar_classes(df, key, text, threshold, least)
    a, b = members.select(F.col("cls").alias("a"), F.col("id").alias("x")), members.select(F.col("cls").alias("b"), F.col("id").alias("y"))
    across = links.join(a, "a").join(b, "b").where("x <> y")
    shared = members.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("cls")
    m = members.join(shared, "cls", "left_semi")
    same = m.select(F.col("cls"), F.col("id").alias("x")).join(m.select("cls", F.col("id").alias("y")), "cls").where("x < y")
    return across.select(F.least("x", "y").alias("eid_a"), F.greatest("x", "y").alias("eid_b")).union(same.select("x", "y")).distinct()
