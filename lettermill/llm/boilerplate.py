"""Problem 4: lines repeated across one source's documents.

Method: numbers, dates and names of a line are masked, and two masked lines of
one source are linked if they share ``similarity`` of their words (Jaccard).
Every such link is found (an exact join by prefixes), and a cluster is all that
links connect, directly or over others; its most frequent masked line names it.
Clusters that occur in many documents of their source are removed
(``repeated_clusters``). ``repeated_lines`` is the case of lines whose own text
is that frequent: it takes the lines of such clusters and an exact document
frequency of each line follows, which no line outside them can reach.

How it is laid out: one pass over the texts writes a narrow table of hashes.
Everything that follows works on the distinct masked lines of a source, combined
map-side; masked lines meet at the words of their prefixes, where a task decides
their pairs and sends on what they connect, never the pairs. Clusters whose
occurrences, an upper bound of their documents, do not reach the limit go no
further. A hot source is split by its lines; sizes of sources come from a
two-step distinct count.

Defined results: rows with a null source are left out; null, empty and blank
bodies have no lines but count as documents of their source; a null id counts
as no document; a document's repeated line is each time a case. Lines are
elements split at ``\\n`` and numbered from 0.
"""

from __future__ import annotations

import re
from collections.abc import Container, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.names import Field, field
from lettermill.llm.text import share_look_alikes, visible_line, visible_lines
from lettermill.operators import blocks
from lettermill.operators.components import connected_components
from lettermill.session import Scratch

SIMILARITY = 0.8
#: words with a rank by frequency; words up to which a line travels with its prefix; pairs that a task decides at a time
_RANKED, _WIDE, _AT_ONCE = 32_768, 64, 1_000_000
_KEPT = 200_000
#: bytes of text that are worked on at a time, unless one text has more
_AT_A_TIME = 1 << 23
#: hashes of masked lines have so many bits, so that a frequency fits above them
_FORM_BITS = 56
_DATE = re.compile(r"\b(?:\d{1,4}[./-]\d{1,2}(?:[./-]\d{1,4})?|(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?)\b")
_NUMBER = re.compile(r"\d[\d.,:]*")
_WORD = re.compile(r"\w+")
#: of each byte: whether it is a letter or digit, part of a word; no byte of other than ASCII text is
_ALNUM = np.array([chr(c).isalnum() and c < 128 for c in range(256)])
_IN_WORD = _ALNUM | (np.arange(256) == ord("_"))


def mask(seen: str, names: Container[str] = frozenset()) -> list[str]:
    """Words of one visible line (in one case), with dates, numbers and known names replaced by marks.

    It reads the visible text, not the raw line: lines that look alike fall into one cluster.
    """
    words = _WORD.findall(_NUMBER.sub("0", _DATE.sub("0", seen)) if any(map(str.isdigit, seen)) or _DATE.search(seen) else seen)
    return ["n'" if w in names else w for w in words]


class _Words(dict):
    """32-bit hash of a word, with the mark of a name where it is one; kept (bounded)."""

    def __init__(self, names: Container[str]) -> None:
        import xxhash

        self.names, self.h = names, xxhash.xxh32_intdigest

    def __missing__(self, w: str) -> int:
        if len(self) >= _KEPT:
            self.clear()
        got = self[w] = self.h("n'" if w in self.names else w)
        return got


def _bytes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and where each text begins, and the end."""
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data if data is not None else b"", np.uint8)[off[0] : off[-1]], (off - off[0]).astype(np.int64)


class _Prints:
    """Of many lines: hash of the visible text and the distinct word hashes of the masked text."""

    def __init__(self, least: int, names: Container[str]) -> None:
        import xxhash

        self.least, self.words = least, _Words(names)
        self.h64 = xxhash.xxh3_64_intdigest

    def __call__(self, lines: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(which, line, sets, off)``: for each line the place of its visible text, or -1 if that is too short; hash and words of each such text."""
        got = visible_lines(lines).dictionary_encode()
        seen = got.dictionary
        data, off = _bytes(seen)
        alnum = np.concatenate(([0], np.cumsum(_ALNUM[data], dtype=np.int32)))[off]
        alnum = alnum[1:] - alnum[:-1]
        plain = pc.string_is_ascii(seen).to_numpy(zero_copy_only=False)
        enough = alnum >= self.least
        odd = np.flatnonzero(~plain & (np.diff(off) >= self.least))
        texts = seen.take(pa.array(odd)).to_pylist()
        enough[odd] |= np.fromiter((len(x) >= self.least and sum(map(str.isalnum, x)) >= self.least for x in texts), bool, len(texts))
        to = np.where(enough, np.cumsum(enough) - 1, -1)
        view, at = memoryview(data), np.flatnonzero(enough)
        line = np.fromiter((self.h64(view[i:j]) for i, j in zip(off[:-1][at].tolist(), off[1:][at].tolist(), strict=True)), np.uint64, len(at))
        plain &= enough & (alnum > 0)
        row, code = self._masked(seen.take(pa.array(np.flatnonzero(plain))))
        held = [np.flatnonzero(plain)[row] << 32 | code]
        for i in np.flatnonzero(enough & ~plain).tolist():
            text = seen[i].as_py()
            held.append(np.array([i << 32 | self.words[w] for w in mask(text) or [text]]))
        sets = np.sort(np.concatenate(held))
        sets = sets[np.concatenate(([True], sets[1:] != sets[:-1]))[: len(sets)]]
        size = np.bincount(to[sets >> 32], minlength=len(at))
        return to[got.indices.to_numpy()], (line - np.uint64(1 << 63)).view(np.int64), (sets & 0xFFFFFFFF).astype(np.uint32), np.concatenate(([0], np.cumsum(size)))

    def _masked(self, seen: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """``(row, code)`` of the words of masked ASCII texts; as ``mask`` has them."""
        data, off = _bytes(pc.replace_substring_regex(pc.replace_substring_regex(seen, _DATE.pattern, "0"), _NUMBER.pattern, "0"))
        inside = _IN_WORD[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        first[off[:-1]] = inside[off[:-1]]  # no text is empty
        at = np.append(np.cumsum(inside, dtype=np.int32)[first] - 1, inside.sum()).astype(np.int32)
        words = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data[inside])).dictionary_encode()
        code = np.fromiter((self.words[w] for w in words.dictionary.to_pylist()), np.int64, len(words.dictionary))
        return np.searchsorted(off, np.flatnonzero(first), "right") - 1, code[words.indices.to_numpy()]


def _whole(sets: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Hash of each set."""
    x = sets.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    whole = np.add.reduceat(x * (x >> np.uint64(7) | np.uint64(1)), off[:-1]) * np.uint64(0x9FB21C651E98DF25)
    return (whole >> np.uint64(64 - _FORM_BITS)).view(np.int64)


def _parts(b: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """The rows in parts of bounded text."""
    upto = np.cumsum(pc.binary_length(b.column(text)).to_numpy())
    lo = 0
    while lo < b.num_rows:
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + _AT_A_TIME, "right")))
        yield b.slice(lo, hi - lo)
        lo = hi


def name_words(given: str | None, family: str | None) -> Iterable[str]:
    """Words of a person's name as they stand in a visible line."""
    return (w for x in (given, family) if x for w in _WORD.findall(visible_line(x)))


def directory_names(directory: DataFrame) -> Field:
    """Name words to mask; of fixed size, whatever the directory."""
    return field(directory, name_words)


def line_prints(df: DataFrame, key: str, source: str, text: str, doc: str, least: int = 20, names: Container[str] = frozenset()) -> DataFrame:
    """``(row, src, doc, line_no, line, form, words)`` for each line with at least ``least`` letters or digits.

    ``words`` stands beside a masked form where a task meets it first in a source only (or again, when it has met many).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, told = _Prints(least, names), set()
        for b in (part for whole in batches for part in _parts(whole, 3)):
            if len(told) >= _KEPT:
                told.clear()
            lines = pc.split_pattern(b.column(3).cast(pa.string()), "\n")
            size = pc.list_value_length(lines).to_numpy()
            lines = lines.flatten()
            # joined letters may stand for two
            take = pc.or_(pc.greater_equal(pc.binary_length(lines), least), pc.invert(pc.string_is_ascii(lines))).to_numpy(zero_copy_only=False)
            text = lines.filter(pa.array(take)).dictionary_encode()
            which, line, sets, off = prints(text.dictionary)
            which = which[text.indices.to_numpy()]
            row, no = np.repeat(np.arange(len(size)), size)[take], blocks.spans(np.zeros(len(size), np.int64), size)[take]
            row, no, which = (x[which >= 0] for x in (row, no, which))
            form = _whole(sets, off)[which] if len(which) else np.zeros(0, np.int64)
            src = b.column(1).to_numpy()[row]
            # where a source and a form meet first
            order = np.lexsort((form, src))
            new = np.ones(len(row), bool)
            new[1:] = (np.diff(src[order]) != 0) | (np.diff(form[order]) != 0)
            first = np.zeros(len(row), bool)
            at = order[new]
            first[at] = [x not in told for x in zip(src[at].tolist(), form[at].tolist(), strict=True)]
            told.update(zip(src[at].tolist(), form[at].tolist(), strict=True))
            words = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(sets.view(np.int32))).take(pa.array(which, mask=~first))
            idx = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(idx), pa.array(src), b.column(2).take(idx), pa.array(no.astype(np.int32)), pa.array(line[which]), pa.array(form), words],
                names=["row", "src", "doc", "line_no", "line", "form", "words"],
            )

    share_look_alikes(df.sparkSession)
    rows = df.where(F.col(source).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(key).cast("long").alias("row"), F.xxhash64(F.col(source).cast("string")).alias("src"), F.when(F.col(doc).isNotNull(), F.xxhash64(doc)).alias("doc"), F.col(text).alias("t"))
    return rows.mapInArrow(run, "row long, src long, doc long, line_no int, line long, form long, words array<int>")


def needed(df: DataFrame, source: str, doc: str, least_docs: int, share: float) -> DataFrame:
    """``(src, need)``: hash of a source and the documents a line must occur in there."""
    docs = df.where(F.col(source).isNotNull() & F.col(doc).isNotNull()).select(F.xxhash64(F.col(source).cast("string")).alias("src"), F.xxhash64(doc).alias("doc")).distinct()
    sizes = docs.groupBy("src").agg(F.count(F.lit(1)).alias("docs"))
    return sizes.select("src", F.greatest(F.lit(float(least_docs)), F.lit(share) * F.col("docs") - 1e-9).alias("need"))


def _bit(codes: np.ndarray) -> np.ndarray:
    """One of 128 bits for each 32-bit word."""
    return ((codes.astype(np.int64) & 0xFFFFFFFF).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(57)


def _sketches(row: np.ndarray, bit: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows of two longs with the bits of their words."""
    out = np.zeros((n, 2), np.uint64)
    np.bitwise_or.at(out.reshape(-1), row * 2 + (bit // np.uint64(64)).astype(np.int64), np.uint64(1) << (bit % np.uint64(64)))
    return out


def _shared(flat: np.ndarray, off: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many values the lists ``i`` and ``j`` share; values are under 2 ** 32 and lists hold each once."""
    if not len(flat):
        return np.zeros(len(i), np.int64)
    flat = flat.astype(np.uint64)
    held = np.sort((np.repeat(np.arange(len(off) - 1, dtype=np.uint64), np.diff(off)) << np.uint64(32)) | flat)
    size = (off[1:] - off[:-1])[i]
    want = (np.repeat(j.astype(np.uint64), size) << np.uint64(32)) | flat[blocks.spans(off[i], size)]
    hit = held[np.minimum(np.searchsorted(held, want), len(held) - 1)] == want
    return np.bincount(np.repeat(np.arange(len(i)), size)[hit], minlength=len(i))


def _prefixes(similarity: float, ranked: np.ndarray):  # noqa: ANN202
    """``(src, t, pos, m, v, often, seldom)`` for each word of a set's prefix: rarest words first, as many as two sets that are similar enough must share one of.

    ``m`` is the set's size, ``pos`` the word's place; ``often`` holds the ranks of its words that have
    one, ``seldom`` the other words. Sets of more than ``_WIDE`` words travel with their sketch instead.
    """
    known = np.sort(ranked)
    rank = np.empty(len(ranked), np.int64)
    rank[np.searchsorted(known, ranked)] = np.arange(len(ranked), 0, -1)  # the most frequent comes first and goes last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, off = blocks.lists(pa.chunked_array([b.column(2)]))
            m = np.diff(off)
            row = np.repeat(np.arange(len(m)), m)
            own, hit = words.astype(np.int64) - (1 << 32), np.zeros(len(words), bool)
            if len(known):
                at = np.minimum(np.searchsorted(known, words), len(known) - 1)
                hit = known[at] == words
                own = np.where(hit, rank[at], own)
            order = np.lexsort((own, row))
            pos = np.arange(len(words)) - np.repeat(off[:-1], m)
            take = pos < (m - np.ceil(similarity * m - 1e-9).astype(np.int64) + 1)[row]
            r = row[take]
            idx = pa.array(r)
            wide = m > _WIDE
            narrow = ~wide[row]
            at = np.concatenate(([0], np.cumsum(hit & narrow)))[off].astype(np.int32)
            often = pa.ListArray.from_arrays(pa.array(at), pa.array((own[hit & narrow] - 1).astype(np.int16)))
            rest, size = words[~hit & narrow], np.bincount(row[~hit & narrow], minlength=len(m))
            if wide.any():
                sketch = _sketches(row, _bit(words), len(m)).view(np.int32).reshape(len(m), 4)[wide].reshape(-1)
                rest = np.insert(rest, np.repeat(np.cumsum(size)[wide], 4), sketch)
                size[wide] = 4
            seldom = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), pa.array(rest))
            yield pa.RecordBatch.from_arrays(
                [b.column(1).take(idx), pa.array(words[order][take]), pa.array(pos[take].astype(np.int32)), pa.array(m[r].astype(np.int32)), b.column(0).take(idx), often.take(idx), seldom.take(idx)],
                names=["src", "t", "pos", "m", "v", "often", "seldom"],
            )

    return run


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in order of ``(src, t)``, cut between these only."""
    held, n, wait = [], 0, 20_000
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n < wait:
            continue
        t = pa.Table.from_batches(held)
        src, word = t.column("src").to_numpy(), t.column("t").to_numpy()
        last = int(np.flatnonzero((src != src[-1]) | (word != word[-1]))[-1:].sum() + 1) if src[0] != src[-1] or word[0] != word[-1] else 0
        if last:
            yield t.slice(0, last)
        held = t.slice(last).to_batches()
        n -= last
        wait = max(20_000, 2 * n)
    if n:
        yield pa.Table.from_batches(held)


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the links ``a, b`` connect, each node with the smallest of its component."""
    node, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(node))
    while True:
        new = label.copy()
        np.minimum.at(new, label[x], label[y])
        np.minimum.at(new, label[y], label[x])
        while not np.array_equal(new[new], new):
            new = new[new]
        new = new[label]
        if np.array_equal(new, label):
            break
        label = new
    other = label != np.arange(len(node))
    return node[other], node[label[other]]


def _meet(similarity: float):  # noqa: ANN202
    """``(i, j, sure)``: what similar sets of a bucket connect; pairs of wide sets that come into question are not sure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_buckets(batches):
            src, word, v = (t.column(c).to_numpy() for c in ("src", "t", "v"))
            once = np.ones(len(v), bool)
            once[1:] = (src[1:] != src[:-1]) | (word[1:] != word[:-1]) | (v[1:] != v[:-1])
            t, src, word, v = t.filter(pa.array(once)), src[once], word[once], v[once]
            m, pos = t.column("m").to_numpy().astype(np.int64), t.column("pos").to_numpy()
            (of, oo), (se, so) = blocks.lists(t.column("often")), blocks.lists(t.column("seldom"))
            of, se, row = of.astype(np.int64), se.view(np.uint32).astype(np.int64), np.arange(len(v))
            sketch = _sketches(np.concatenate((np.repeat(row, np.diff(oo)), np.repeat(row, np.diff(so)))), np.concatenate((_bit(of + 1), _bit(se))), len(v))
            wide = m > _WIDE
            if wide.any():
                sketch[wide] = se[blocks.spans(so[:-1][wide], np.full(int(wide.sum()), 4))].astype(np.uint32).view(np.uint64).reshape(-1, 2)
            bucket = np.concatenate(([0], np.cumsum((src[1:] != src[:-1]) | (word[1:] != word[:-1]))))
            far = 2 * int(m.max()) + 2
            to = np.searchsorted(bucket * far + m, bucket * far + np.minimum((m / similarity + 1e-9).astype(np.int64), far - 1), "right")
            many = to - np.arange(len(v)) - 1
            upto = np.cumsum(many)
            lo = 0
            while lo < len(v):
                hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + _AT_ONCE, "right")))
                i, j = np.repeat(np.arange(lo, hi), many[lo:hi]), blocks.spans(np.arange(lo, hi) + 1, many[lo:hi])
                lo = hi
                both = m[i] + m[j]
                need = np.ceil(similarity / (1 + similarity) * both - 1e-9).astype(np.int64)
                ok = np.minimum(m[i] - pos[i], m[j] - pos[j]) >= need
                apart = np.bitwise_count(sketch[i] ^ sketch[j]).astype(np.int64).sum(axis=1)
                ok &= (apart <= both - 2 * need) | (wide[i] != wide[j])  # these have sketches of two kinds
                i, j, both = i[ok], j[ok], both[ok]
                later = wide[i] | wide[j]
                if later.any():
                    yield pa.RecordBatch.from_arrays([pa.array(v[i[later]]), pa.array(v[j[later]]), pa.array(np.zeros(int(later.sum()), bool))], names=["i", "j", "sure"])
                    i, j, both = i[~later], j[~later], both[~later]
                if not len(i):
                    continue
                common = _shared(of, oo, i, j) + _shared(se, so, i, j)
                ok = common >= similarity * (both - common) - 1e-9
                if ok.any():
                    a, b = _stars(v[i[ok]], v[j[ok]])
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.ones(len(a), bool))], names=["i", "j", "sure"])

    return run


def _links(lines: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """``(i, j)``: links that connect what the pairs of similar masked lines of a source connect; exact.

    Prefix filter: two sets that are similar enough share one of the rarest ``m - ceil(similarity m) + 1``
    words of each, in any one order of words. Sizes, places and sketches bound the shared words of a
    pair from above; the rest is compared in full.
    """
    sets = lines.where("words is not null").select(F.xxhash64("src", "form").alias("v"), "src", "words")
    often = sets.select(F.explode("words").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "w").limit(_RANKED)
    ranked = np.array([r["w"] for r in often.collect()], np.int32)  # of bounded length
    met = sets.select("v", "src", "words").mapInArrow(_prefixes(similarity, ranked), "src long, t int, pos int, m int, v long, often array<short>, seldom array<int>")
    met = met.repartition("src", "t").sortWithinPartitions("src", "t", "m", "v").mapInArrow(_meet(similarity), "i long, j long, sure boolean")
    met = scratch.cut(met.distinct())
    links, open_ = met.where("sure").select("i", "j"), met.where("not sure").select("i", "j")
    if open_.isEmpty():
        return links
    asked = open_.select(F.col("i").alias("v")).union(open_.select("j")).distinct()
    words = scratch.cut(sets.select("v", "words").join(asked, "v", "left_semi").dropDuplicates(["v"]))
    both = open_.join(words.select(F.col("v").alias("i"), F.col("words").alias("a")), "i").join(words.select(F.col("v").alias("j"), F.col("words").alias("b")), "j")
    common = F.size(F.array_intersect("a", "b"))
    return links.union(both.where(common >= similarity * (F.size("a") + F.size("b") - common) - 1e-9).select("i", "j"))


def _clusters(lines: DataFrame, need: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """``(src, form, cluster)`` of the masked lines in clusters whose occurrences reach the limit.

    A form's rank is its frequency (in powers of two) above its own bits, one long, so that the form
    that names a cluster comes from a hashed maximum.
    """
    comps = connected_components(_links(lines, similarity, scratch))
    forms = lines.groupBy("src", "form").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.xxhash64("src", "form"))
    forms = scratch.cut(forms.join(comps, "v", "left").select("src", "form", "n", F.coalesce("comp", "v").alias("comp")))
    rank = F.shiftleft(F.floor(F.log2("n")), _FORM_BITS) + F.col("form")
    heavy = forms.groupBy("src", "comp").agg(F.sum("n").alias("all"), F.max(rank).bitwiseAND(F.lit((1 << _FORM_BITS) - 1)).alias("cluster"))
    heavy = heavy.join(need, "src").where(F.col("all") >= F.col("need")).select("src", "comp", "cluster")
    return scratch.cut(forms.join(heavy, ["src", "comp"]).select("src", "form", "cluster"))


def repeated_clusters(
    df: DataFrame, key: str = "row_idx", source: str = "site", text: str = "raw_body", doc: str = "eid", least_docs: int = 10, share: float = 0.1, least: int = 20, names: Container[str] = frozenset(), similarity: float = SIMILARITY
) -> tuple[DataFrame, DataFrame]:
    """``(found, need)``: ``(row, line_no, src, doc, line, cluster)`` of the lines in clusters that at least ``least_docs`` documents and ``share`` of all documents of their source hold, and the limit of each source."""
    scratch = Scratch(df.sparkSession, "repeated-lines")
    lines = scratch.cut(line_prints(df, key, source, text, doc, least, names))
    need = scratch.cut(needed(df, source, doc, least_docs, share))
    forms = _clusters(lines, need, similarity, scratch)
    inside = scratch.cut(lines.select("row", "line_no", "src", "doc", "line", "form").join(forms, ["src", "form"]).drop("form"))
    heavy = inside.where("doc is not null").select("src", "cluster", "doc").distinct().groupBy("src", "cluster").agg(F.count(F.lit(1)).alias("n"))
    heavy = heavy.join(need, "src").where("n >= need").select("src", "cluster")
    found = scratch.cut(inside.join(heavy, ["src", "cluster"], "left_semi"))
    scratch.keep_only(found, need)
    return found, need


def repeated_lines(df: DataFrame, key: str = "row_idx", source: str = "site", text: str = "raw_body", doc: str = "eid", least_docs: int = 10, share: float = 0.1, least: int = 20, names: Container[str] = frozenset()) -> DataFrame:
    """``(key, line_no)`` of each occurrence of a line whose own text at least ``least_docs`` documents and ``share`` of all documents of its source hold."""
    inside, need = repeated_clusters(df, key, source, text, doc, least_docs, share, least, names)
    exact = inside.where("doc is not null").select("src", "line", "doc").distinct().groupBy("src", "line").agg(F.count(F.lit(1)).alias("n"))
    exact = exact.join(need, "src").where("n >= need").select("src", "line")
    return inside.join(exact, ["src", "line"], "left_semi").select(F.col("row").alias(key), "line_no")


def without_repeated_lines(df: DataFrame, found: DataFrame, key: str = "row_idx", text: str = "raw_body", out: str = "kept_body") -> DataFrame:
    """``df`` with ``out``: the text without the lines in ``found (key, line_no)``. A null text stays null."""
    drop = found.groupBy(key).agg(F.collect_set("line_no").alias("__drop"))
    kept = F.filter(F.split(F.col(text), "\n", -1), lambda _, i: ~F.array_contains(F.col("__drop"), i))
    return df.join(drop, key, "left").withColumn(out, F.when(F.col("__drop").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))).drop("__drop")
