"""Exact joins of sets in pairs of blocks.

At a low threshold an inverted index keeps most pairs, and every kept pair carries two rows through
exchanges. Here the rows are dealt into blocks and each task gets two of them: what moves is the rows,
once a block, never a pair. Inside a task a token is a row of bits over the columns (the other block's
rows), and the tokens that a row shares with all columns are counted at once by carry-save adders, 64
columns a word. Counts are compared with the least count a pair needs in the same form; only pairs that
reach it are ever written out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: rows of a block, blocks at least (for tasks enough), words of columns that are counted at a time
BLOCK, LEAST, AT_ONCE = 60_000, 5, 4_096
#: cells up to which a cluster's shared tokens are counted by a product
DENSE = 1 << 22


def pair_up(items: DataFrame, rows: int, block: int = BLOCK, least: int = LEAST) -> DataFrame:
    """``items`` with ``__own``, the number of a row's block, and ``__pair``: one partition for every two blocks (and each with itself)."""
    b = max(1 if rows < 2_000 else least, -(-rows // block))
    own = F.pmod(F.xxhash64(F.lit("block"), F.col(items.columns[0])), F.lit(b)).cast("int")
    both = items.withColumn("__own", own).withColumn("__other", F.explode(F.sequence(F.lit(0), F.lit(b - 1))))
    lo, hi = F.least("__own", "__other"), F.greatest("__own", "__other")
    both = both.withColumn("__pair", (hi * (hi + 1) / 2 + lo).cast("int")).drop("__other")
    return both.repartitionById(b * (b + 1) // 2, "__pair")


def halves(batches: Iterator[pa.RecordBatch]) -> tuple[pa.Table, pa.Table] | None:
    """The rows of a partition's two blocks; one table twice for a block with itself. No rows give nothing."""
    held = list(batches)
    if not sum(b.num_rows for b in held):
        return None
    t = pa.Table.from_batches(held)
    own = t.column("__own").to_numpy()
    first = own.min()
    pair = int(t.column("__pair")[0].as_py())
    # a pair's number says whether it is a block with itself
    hi = int(((8 * pair + 1) ** 0.5 - 1) / 2)
    while (hi + 1) * (hi + 2) // 2 <= pair:
        hi += 1
    while hi * (hi + 1) // 2 > pair:
        hi -= 1
    lo = pair - hi * (hi + 1) // 2
    t = t.drop_columns(["__own", "__pair"])
    if lo == hi:
        return t, t
    if first != lo or own.max() != hi:  # one block of the two is empty
        return None
    return t.filter(pa.array(own == lo)), t.filter(pa.array(own == hi))


def lists(c: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    c = c.combine_chunks()
    c = pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c
    off = c.offsets.to_numpy()
    return c.flatten().to_numpy(), off - off[0]


def reordered(flat: np.ndarray, off: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists in another order."""
    size = np.diff(off)[order]
    to = np.concatenate(([0], np.cumsum(size)))
    return flat[spans(off[:-1][order], size)], to


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of runs, one after the other."""
    to = np.cumsum(size)
    return np.arange(int(to[-1]) if len(to) else 0) + np.repeat(start - (to - size), size)


class Bits:
    """A bit a column for each token, with a row of zeros at ``tokens``."""

    def __init__(self, flat: np.ndarray, off: np.ndarray, tokens: int) -> None:
        n = len(off) - 1
        self.n, self.words, self.none = n, -(-n // 64), tokens
        self.bits = np.zeros((tokens + 1, self.words), np.uint64)
        col = np.repeat(np.arange(n), np.diff(off))
        np.bitwise_or.at(self.bits.reshape(-1), flat.astype(np.int64) * self.words + col // 64, np.uint64(1) << (col % 64).astype(np.uint64))

    def has(self, token: np.ndarray, col: np.ndarray) -> np.ndarray:
        return (self.bits[token, col // 64] >> (col % 64).astype(np.uint64) & np.uint64(1)).astype(bool)


def counted(x: np.ndarray) -> list[np.ndarray]:
    """Planes of the binary count of set bits over the first axis, lowest first. ``x`` is written over."""
    out = []
    room = np.empty((len(x) // 3, *x.shape[1:]), x.dtype)
    while len(x):
        carry = []
        while len(x) > 2:
            k = len(x) // 3
            a, b, c, u = x[:k], x[k : 2 * k], x[2 * k : 3 * k], room[:k]
            np.bitwise_xor(a, b, out=u)
            np.bitwise_and(a, b, out=a)
            np.bitwise_and(u, c, out=b)
            np.bitwise_or(a, b, out=a)
            np.bitwise_xor(u, c, out=c)
            carry.append(a)
            x = x[2 * k :]
        if len(x) == 2:
            carry.append(x[:1] & x[1:])
            out.append(x[0] ^ x[1])
        else:
            out.append(x[0])
        x = np.concatenate(carry) if carry else x[:0]
    return out


def planes_of(v: np.ndarray, words: int) -> np.ndarray:
    """Binary planes of a number a column."""
    deep = max(1, int(v.max()).bit_length()) if len(v) else 1
    full = np.zeros((deep, words * 64), np.uint8)
    for p in range(deep):
        full[p, : len(v)] = v >> p & 1
    return np.packbits(full, axis=1, bitorder="little").view(np.uint64)


def at_least(count: list[np.ndarray], need: np.ndarray) -> np.ndarray:
    """Bits of the columns whose count is at least ``need``."""
    ge = np.full(count[0].shape, ~np.uint64(0))
    zero = np.uint64(0)
    for p in range(max(len(count), len(need))):
        c = count[p] if p < len(count) else zero
        t = need[p] if p < len(need) else zero
        ge = (c & ~t) | (ge & ~(c ^ t))
    return ge


def meeting(flat: np.ndarray, off: np.ndarray, kind: np.ndarray, cols: Bits, need: Callable[[int], tuple[int, int, np.ndarray]], same: bool, skip: Callable[[np.ndarray, slice], np.ndarray] | None = None, counts: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(rows, columns, count)`` of the pairs that share as many tokens as they need.

    Rows are in order of ``kind``; ``need(kind)`` gives the first and last column that come into
    question and the least count with each of them (one or more). ``same``: rows and columns are one
    block, and the pairs above the diagonal are wanted. ``skip(rows, words)`` has bits of columns that a
    row need not meet. Without ``counts`` they are given as 0.
    """
    n = len(off) - 1
    edges = np.flatnonzero(np.diff(kind)) + 1
    for lo, hi in zip([0, *edges], [*edges, n], strict=True):
        if lo == hi:
            continue
        c0, c1, least = need(int(kind[lo]))
        w0, w1 = c0 // 64, -(-c1 // 64)
        if c1 <= c0:
            continue
        planes = planes_of(np.concatenate((np.zeros(c0 - w0 * 64, np.int64), least)), w1 - w0)
        size = np.diff(off[lo : hi + 1])
        order = lo + np.argsort(size, kind="stable")
        step = max(1, AT_ONCE // (w1 - w0))
        for i in range(0, len(order), step):
            rows = order[i : i + step]
            z0 = max(w0, int(rows.min()) // 64) if same else w0
            m = off[rows + 1] - off[rows]
            deep = int(m.max())
            if z0 >= w1 or not deep:
                continue
            tok = np.full((deep, len(rows)), cols.none, np.int64)
            for g, r in enumerate(rows):
                tok[: m[g], g] = flat[off[r] : off[r + 1]]
            count = counted(cols.bits[:, z0:w1][tok])
            ge = at_least(count, planes[:, z0 - w0 :])
            if skip is not None:
                ge &= ~skip(rows, slice(z0, w1))
            g, w = np.nonzero(ge)
            if not len(g):
                continue
            at, bit = np.nonzero(np.unpackbits(ge[g, w].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            g, w = g[at], w[at]
            col = (z0 + w) * 64 + bit
            row = rows[g]
            ok = (col >= c0) & (col < c1)
            if same:
                ok &= row < col
            g, w, bit = g[ok], w[ok], bit[ok].astype(np.uint64)
            if not len(g):
                continue
            k = np.zeros(len(g), np.int64)
            for p, plane in enumerate(count if counts else ()):
                k |= (plane[g, w] >> bit & np.uint64(1)).astype(np.int64) << p
            yield row[ok], col[ok], k


class Joined:
    """What pairs of rows ``0 .. a`` and columns ``a .. a + b`` have connected so far; one block's rows are its columns (``same``)."""

    #: columns from which a component has a row of bits
    MANY = 256

    def __init__(self, a: int, b: int, same: bool) -> None:
        self.shift = 0 if same else a
        self.n, self.words = b, -(-b // 64)
        self.label = np.arange(a if same else a + b)
        self.members: dict[int, list[int]] = {}
        self.bits: dict[int, tuple[int, np.ndarray]] = {}
        self.none = np.zeros(self.words, np.uint64)

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return self.label[i] != self.label[j + self.shift]

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        for x, y in zip(i.tolist(), (j + self.shift).tolist(), strict=True):
            p, q = int(self.label[x]), int(self.label[y])
            if p == q:
                continue
            few, most = self.members.pop(p, [p]), self.members.pop(q, [q])
            if len(few) > len(most):
                few, most, q = most, few, p
            self.label[few] = q
            most += few
            self.members[q] = most

    def skip(self, rows: np.ndarray, words: slice) -> np.ndarray:
        out = []
        for x in self.label[rows].tolist():
            size = len(self.members.get(x, ()))
            if size < self.MANY:
                out.append(self.none[words])
                continue
            if x not in self.bits or size > 1.05 * self.bits[x][0]:
                of = np.zeros(self.words * 64, bool)
                of[: self.n] = self.label[self.shift :] == x
                self.bits[x] = size, np.packbits(of, bitorder="little").view(np.uint64)
            out.append(self.bits[x][1][words])
        return np.stack(out)

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        """Every member of a component with one of them."""
        got = [np.array(m) for m in self.members.values()]
        if not got:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.repeat([m.min() for m in got], list(map(len, got))), np.concatenate(got)


def connected(met: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], joined: Joined, linked: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> None:
    """Joins the pairs that ``linked`` confirms; those that are connected by then are not asked about. Few are asked first, as they often connect the others."""
    for i, j, count in met:
        step = 64
        while True:
            open_ = joined.apart(i, j)
            i, j, count = i[open_], j[open_], count[open_]
            if not len(i):
                break
            p, q = i[:step], j[:step]
            ok = linked(p, q, count[:step])
            joined.join(p[ok], q[ok])
            i, j, count = i[step:], j[step:], count[step:]
            step *= 4


def jaccard_sum(h: np.ndarray, off: np.ndarray, first: int, same: bool) -> float:
    """Sum of the Jaccard similarities of all pairs of lists (``same``), or of those under ``first`` with the others. Empty lists are similar to none."""
    n = np.diff(off)
    token, tok, often = np.unique(h, return_inverse=True, return_counts=True)
    keep = often[tok] > 1  # a token of one list is shared by no pair
    row = np.repeat(np.arange(len(n)), n)[keep]
    number = np.cumsum(often > 1) - 1
    tok, tokens = number[tok[keep]], int((often > 1).sum())
    at = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(n)))))
    rows, c0 = (np.arange(len(n)), 0) if same else (np.arange(first), first)
    if not tokens or not len(rows) or c0 == len(n):
        return 0.0
    if len(n) * tokens <= DENSE:
        has = np.zeros((len(n), tokens), np.float32)
        has[row, tok] = 1
        count = (has[rows] @ has[c0:].T).astype(np.float64)
        sim = count / np.maximum(1, n[rows, None] + n[None, c0:] - count)
        return float(np.triu(sim, 1).sum() if same else sim.sum())
    cols = Bits(tok[at[c0] :], at[c0:] - at[c0], tokens)
    m = np.diff(at)
    rows = rows[np.argsort(m[rows], kind="stable")]
    step, total = max(1, AT_ONCE // cols.words), 0.0
    size, place = n[c0:].astype(np.float64), np.arange(c0, len(n))
    for i in range(0, len(rows), step):
        r = rows[i : i + step]
        deep = int(m[r].max())
        if not deep:
            continue
        got = np.full((deep, len(r)), tokens, np.int64)
        for g, x in enumerate(r):
            got[: m[x], g] = tok[at[x] : at[x + 1]]
        count = np.zeros((len(r), len(size)))
        for p, plane in enumerate(counted(cols.bits[got])):
            count += np.unpackbits(plane.view(np.uint8), axis=1, bitorder="little")[:, : len(size)] * float(1 << p)
        sim = count / (n[r, None] + size - count + (count == 0))
        total += float((sim * (place > r[:, None])).sum() if same else sim.sum())
    return total
