"""The names of a directory as a bit field of one fixed size, for membership tests in Python workers.

A directory can grow without bound; the field cannot: ``BITS`` bits (16 MB, a
few kB compressed for a short list), made in the engine in chunks of 512 bytes.
Each entry sets ``PROBES`` bits, so with n entries a string that is no entry is
taken for one with probability ``(PROBES * n / BITS) ** PROBES`` at most: 1e-18
for a thousand entries, 1e-6 for a million. No directory is cut or refused.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.text import share_look_alikes

BITS, PROBES, CHUNK = 1 << 27, 4, 1 << 12
_KEPT = 200_000


def _places(entry: str) -> list[int]:
    import xxhash

    h = xxhash.xxh3_128_intdigest(entry.encode("utf-8", "surrogatepass"))
    return [(h >> (32 * k)) % BITS for k in range(PROBES)]


class Field:
    """``entry in field``; answers are kept (bounded)."""

    def __init__(self, packed: bytes) -> None:
        self.packed = packed
        self.bits: bytes | None = None
        self.kept: dict[str, bool] = {}

    def __getstate__(self) -> dict:
        return {"packed": self.packed, "bits": None, "kept": {}}

    def __contains__(self, entry: str) -> bool:
        got = self.kept.get(entry)
        if got is None:
            if self.bits is None:
                self.bits = zlib.decompress(self.packed)
            if len(self.kept) >= _KEPT:
                self.kept.clear()
            got = self.kept[entry] = all(self.bits[p >> 3] >> (p & 7) & 1 for p in _places(entry))
        return got


def field(directory: DataFrame, entries: Callable[[str | None, str | None], Iterable[str]], given: str = "given_name", family: str = "family_name") -> Field:
    """The field of ``entries(given, family)`` of every row."""
    share_look_alikes(directory.sparkSession)  # entries may read visible text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = sorted({p for g, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for e in entries(g, f) for p in _places(e)})
            yield pa.RecordBatch.from_arrays([pa.array([p // CHUNK for p in at], pa.int32()), pa.array([p % CHUNK for p in at], pa.int32())], names=["chunk", "bit"])

    # at most BITS / CHUNK rows of at most CHUNK bits, whatever the directory
    chunks = directory.select(given, family).mapInArrow(run, "chunk int, bit int").groupBy("chunk").agg(F.collect_set("bit").alias("at"))
    bits = bytearray(BITS >> 3)
    for r in chunks.toLocalIterator():
        for p in r["at"]:
            p += r["chunk"] * CHUNK
            bits[p >> 3] |= 1 << (p & 7)
    return Field(zlib.compress(bytes(bits), 1))
