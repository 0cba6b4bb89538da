"""Problem 8: encoding of a whole corpus with a public byte-level BPE.

Method: the contiguous rank array. A word is held as its part boundaries and,
beside each, the rank of the pair that begins there. The smallest rank is
looked for by scanning, its boundary deleted, and the ranks of the two
neighbours refreshed, until no pair has a rank. Scanning is quadratic, so words
over ``LONG`` bytes take the same merges from a heap over linked parts; both
merge the leftmost of the smallest ranks, so the ids are the same.

Words repeat, so each worker keeps the ids of words it has met (bounded).
Strings of special tokens in a text are ordinary text. A null and an empty text
give an empty list.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: where the public vocabularies lie unless the caller names another file
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the public pattern that cuts text into words for this vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG = 96
_NONE = 1 << 60
_KEPT, _KEPT_BYTES = 400_000, 64


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word over a contiguous array of boundaries and ranks."""
    get = ranks.get
    bounds = list(range(len(word) + 1))
    rank = [get(word[i : i + 2], _NONE) for i in range(len(word) - 1)]
    while rank:
        least = min(rank)
        if least == _NONE:
            break
        i = rank.index(least)
        del bounds[i + 1]
        del rank[i]
        if i < len(rank):
            rank[i] = get(word[bounds[i] : bounds[i + 2]], _NONE)
        if i:
            rank[i - 1] = get(word[bounds[i - 1] : bounds[i + 1]], _NONE)
    return [ranks[word[a:b]] for a, b in zip(bounds, bounds[1:])]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a long word: a heap of (rank, start) over linked parts, stale entries skipped."""
    n = len(word)
    end = list(range(1, n + 1))
    prev = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] == n or end[end[i]] != stop:
            continue
        j = end[i]
        alive[j] = False
        end[i] = stop
        if stop < n:
            prev[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := prev[i]) >= 0 and (r := ranks.get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    def __init__(self, path: str = VOCABULARY, pattern: str = PATTERN) -> None:
        import regex

        self.ranks = load_ranks(path)
        self.words = regex.compile(pattern).findall
        self.kept: dict[str, list[int]] = {}

    def word(self, w: str) -> list[int]:
        raw = w.encode("utf-8", "replace")
        if (whole := self.ranks.get(raw)) is not None:
            ids = [whole]
        else:
            ids = merge_short(raw, self.ranks) if len(raw) <= LONG else merge_long(raw, self.ranks)
        if len(raw) <= _KEPT_BYTES:
            if len(self.kept) >= _KEPT:
                self.kept.clear()
            self.kept[w] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        kept = self.kept
        for w in self.words(text):
            out += kept.get(w) or self.word(w)
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def shipped(spark: SparkSession, path: str) -> Callable[[], Encoder]:
    """Sends the vocabulary file to the workers, which need no folder in common; what it returns is called there."""
    spark.sparkContext.addFile(path)
    name = os.path.basename(path)
    return lambda: encoder(SparkFiles.get(name))


def token_ids(df: DataFrame, key: str, text: str, path: str = VOCABULARY) -> DataFrame:
    """``(key, ids)`` for every row; the key is kept as it is."""
    here = shipped(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = here()
        for b in batches:
            for at in range(0, b.num_rows, 256):  # bounds the lists held at once
                s = b.slice(at, 256)
                ids = pa.array([enc.encode(t) for t in s.column(1).to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([s.column(0), ids], names=["key", "ids"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def token_counts(df: DataFrame, key: str, text: str, path: str = VOCABULARY, out: str = "n_tokens", keep: Sequence[str] = ()) -> DataFrame:
    """``(key, *keep, n_tokens)``; only the count leaves the Python worker."""
    here = shipped(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = here()
        for b in batches:
            n = pa.array([len(enc.encode(t)) for t in b.column(b.num_columns - 1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], n], names=[*b.schema.names[:-1], "n"])

    taken = [F.col(c).alias(f"k{i}") for i, c in enumerate((key, *keep))]
    shape = ", ".join(f"k{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate((key, *keep)))
    got = df.select(*taken, F.col(text).alias("text")).mapInArrow(run, f"{shape}, n long")
    return got.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate((key, *keep))], F.col("n").alias(out))
