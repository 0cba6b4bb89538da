"""Joins in pairs of blocks: equal to brute force, and no pair goes through an exchange."""

from __future__ import annotations

import random
import re

import pytest

from lettermill.operators import blocks, similarity


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_blocks(monkeypatch):
    """Several blocks, also with few rows; few tokens have rows of bits of their own."""
    pair_up = blocks.pair_up
    monkeypatch.setattr(blocks, "pair_up", lambda items, rows: pair_up(items, max(rows, 2_000), 10_000, 3))
    monkeypatch.setattr(similarity, "COMMON", 16)
    monkeypatch.setattr(blocks, "AT_ONCE", 4)


def texts(n: int, seed: int) -> list[tuple[int, str | None]]:
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(3)) if r.random() < 0.3 else r.choice(["one", "two", "three", "four", "five", "six", "seven"])
    rows: list[tuple[int, str | None]] = [(k, " ".join(word() for _ in range(r.choice([0, 1, 3, 8, 20, 90])))) for k in range(n)]
    for k in range(0, n, 7):  # copies and near copies
        rows[k] = (k, (rows[k // 2][1] or "") + (" extra" if k % 2 else ""))
    return [*rows, (n, None), (n + 1, ""), (n + 2, "12 ab")]


def test_jaccard_in_blocks(spark, small_blocks):
    rows = texts(230, 3)
    df = spark.createDataFrame(rows, "k long, t string")
    sets = {k: {w for w in re.findall(r"\w+", (t or "").lower()) if re.fullmatch("[a-z]{3,}", w)} for k, t in rows}
    want = {(i, j): len(a & b) / len(a | b) for i, a in sets.items() for j, b in sets.items() if i < j and a and b and len(a & b) / len(a | b) >= 0.35}
    got = {(r.i, r.j): r.sim for r in similarity.jaccard_join(df, "k", "t", 0.35).collect()}
    assert got == want and any(s == 1 for s in want.values())
    some = similarity.jaccard_join(df, "k", "t", 0.35, below=0.99)
    assert {(r.i, r.j): r.sim for r in some.collect()} == {p: s for p, s in want.items() if s < 0.99}
    # pairs never meet in the engine: vectors beside pairs took the disk
    assert "Join" not in plan(some)


def test_blocks_count_exactly():
    import numpy as np

    r = np.random.default_rng(1)
    for deep in (1, 2, 3, 7, 64, 301):
        x = r.integers(0, 1 << 63, (deep, 2, 3), dtype=np.uint64)
        bits = np.unpackbits(x.view(np.uint8), axis=-1, bitorder="little").sum(axis=0)
        planes = blocks.counted(x)
        assert (sum(np.unpackbits(p.view(np.uint8), axis=-1, bitorder="little").astype(int) << k for k, p in enumerate(planes)) == bits).all()
        need = r.integers(1, deep + 3, 192)
        got = np.unpackbits(blocks.at_least(planes, blocks.planes_of(need, 3)).view(np.uint8), axis=-1, bitorder="little")
        assert (got == (bits >= need)).all()


def test_no_rows_and_one_row(spark):
    for rows in ([], [(1, "one two three")], [(1, None), (2, "")]):
        df = spark.createDataFrame(rows, "k long, t string")
        assert similarity.jaccard_join(df, "k", "t", 0.35).isEmpty()


def test_cosine_in_blocks(spark, small_blocks):
    """As the weights of ``tfidf``, pair by pair."""
    from lettermill.session import Scratch

    df = spark.createDataFrame(texts(230, 5), "k long, t string")
    for vocabulary in (40, 5_000):
        rows: dict[int, dict[str, float]] = {}
        for r in similarity.tfidf(df, "k", "t", vocabulary).collect():
            rows.setdefault(r.k, {})[r.term] = r.w
        sims = {(i, j): sum(w * b.get(t, 0.0) for t, w in a.items()) for i, a in rows.items() for j, b in rows.items() if i < j}
        want = {p: s for p, s in sims.items() if s >= 0.59}
        found = similarity.cosine_texts(*similarity.term_rows(df, "k", "t", Scratch(spark, "t"), vocabulary), 0.59)
        got = {(r.i, r.j): r.sim for r in found.collect()}
        assert got.keys() == want.keys() and want and all(abs(got[p] - s) < 1e-9 for p, s in want.items())
        assert "Join" not in plan(found)
    empty = spark.createDataFrame([(1, None), (2, "")], "k long, t string")
    assert similarity.cosine_texts(*similarity.term_rows(empty, "k", "t", Scratch(spark, "t"))).isEmpty()


def test_cosine_pairs_make_no_pair_in_the_engine(spark, tmp_path):
    """The registered query: before, every candidate carried two vectors through an exchange."""
    import __spark_entry__ as e

    rows = [(k, f"m{k // 2}", t) for k, t in texts(60, 9)]
    spark.createDataFrame(rows, "row_idx long, eid string, body_text string").write.parquet(str(tmp_path / "thread_grouper.parquet"))
    assert "Join" not in plan(e.queries()["cosine_pairs"](spark, str(tmp_path)))


def components(pairs) -> dict[int, int]:
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i, j in pairs:
        parent[max(find(i), find(j))] = min(find(i), find(j))
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("many", [4, 256])
def test_links_connect_what_pairs_connect(spark, small_blocks, monkeypatch, many):
    """Before, every pair left its task and was grouped again."""
    from lettermill.session import Scratch

    monkeypatch.setattr(blocks.Joined, "MANY", many)
    scratch = Scratch(spark, "t")
    df = spark.createDataFrame(texts(230, 11), "k long, t string")
    links = similarity.jaccard_links(*similarity.set_classes(df, "k", "t", scratch), 0.35, 0.99)
    want = components((r.i, r.j) for r in similarity.jaccard_join(df, "k", "t", 0.35, below=0.99).collect())
    assert components((r.i, r.j) for r in links.collect()) == want and "Join" not in plan(links)
    terms = similarity.term_rows(df, "k", "t", scratch)
    links = similarity.cosine_links(*terms, 0.59, 0.99)
    want = components((r.i, r.j) for r in similarity.cosine_texts(*terms, 0.59, 0.99).collect())
    assert components((r.i, r.j) for r in links.collect()) == want and "Join" not in plan(links)


@pytest.mark.parametrize(("part", "dense"), [(8_192, True), (16, True), (16, False)])
def test_sums_of_clusters(spark, monkeypatch, part, dense):
    """All pairs of a cluster, those that share nothing too; no pair is a row."""
    from lettermill.operators import threads
    from lettermill.session import Scratch

    monkeypatch.setattr(threads, "_PART", part)
    if not dense:
        monkeypatch.setattr(blocks, "DENSE", 0)
    rows = texts(120, 13)
    comp = {k: k % 7 if k < 100 else k for k, _ in rows}
    df = spark.createDataFrame(rows, "k long, t string")
    comps = spark.createDataFrame(list(comp.items()), "row_idx long, comp long")
    inside = [(i, j) for i in comp for j in comp if i < j and comp[i] == comp[j]]
    for jaccard in (True, False):
        if jaccard:
            vec = {r.k: set(r.h) for r in similarity.hashed_sets(df, "k", "t").collect()}
            sim = lambda i, j: len(vec[i] & vec[j]) / len(vec[i] | vec[j]) if i in vec and j in vec else 0.0  # noqa: B023, E731
            sums = threads.jaccard_sums(similarity.hashed_sets(df, "k", "t"), comps)
        else:
            vec = {}
            for r in similarity.tfidf(df, "k", "t").collect():
                vec.setdefault(r.k, {})[r.term] = r.w
            sim = lambda i, j: sum(w * vec.get(j, {}).get(t, 0.0) for t, w in vec.get(i, {}).items())  # noqa: B023, E731
            sums = threads.cosine_sums(*similarity.term_rows(df, "k", "t", Scratch(spark, "t")), comps)
        want: dict[int, float] = {}
        for i, j in inside:
            want[comp[i]] = want.get(comp[i], 0.0) + sim(i, j)
        got: dict[int, float] = {}
        for r in sums.collect():
            got[r.comp] = got.get(r.comp, 0.0) + r.s
        assert got == pytest.approx(want)


def test_evaluate_makes_no_pairs(spark, monkeypatch):
    """The way of ``thread_flagship``: before, candidates of the cosine join and pairs of clusters were rows."""
    from lettermill.operators import threads

    def none(*_):
        raise AssertionError("pairs are made")

    for module, name in ((similarity, "cosine_join"), (similarity, "jaccard_join"), (threads, "pairs_inside"), (threads, "cohesion")):
        monkeypatch.setattr(module, name, none)
    both = threads.evaluate(spark.createDataFrame(texts(40, 17), "row_idx long, body_text string"))
    assert threads.choose(both) in ("jaccard", "tfidf") and both["jaccard"][1].first()["total_threads"] > 1


def test_evaluate_runs_both_methods_at_once(spark, monkeypatch):
    """The time of ``thread_flagship``: before, the Jaccard links began when all of the other method had ended."""
    import threading

    from lettermill.operators import threads

    both = threading.Barrier(2, timeout=90)
    for name in ("cosine_links", "jaccard_links"):

        def met(*args, f=getattr(similarity, name)):
            both.wait()
            return f(*args)

        monkeypatch.setattr(similarity, name, met)
    df = spark.createDataFrame(texts(40, 19), "row_idx long, body_text string")
    got = threads.evaluate(df)
    assert list(got) == ["tfidf", "jaccard"]
    for comps, row in got.values():
        assert comps.count() == 43 and row.first()["emails_in_threads"] > 1
