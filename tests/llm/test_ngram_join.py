import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.llm import graph
from paperloom.llm import ngram_join as J
from paperloom.llm.graph import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def gram_set(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(zip(*(w[k:] for k in range(n)))) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, n, percent):
    """{doc_id: [(size, component)]} by all pairs."""
    rows = [(i, gram_set(t, n)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(rows):
        for j, b in rows[:k]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i is not None, i or 0), len(s), None if i is None else find(i)) for i, s in rows)


def got(df):
    return sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["n_shingles"], r["component_id"]) for r in df.collect())


def corpus(seed, n_docs=150):
    """Texts, near copies at all distances, chains of near copies, shared passages, exact copies, short texts."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(60))
    shared = [word() for _ in range(30)]
    texts = []
    for i in range(n_docs):
        kind = rng.random()
        if texts and kind < 0.45:
            w = rng.choice(texts).split()
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 9])):
                if w:
                    w[rng.randrange(len(w))] = word()
        elif kind < 0.55:
            w = [word() for _ in range(rng.randrange(4))]
        else:
            w = [word() for _ in range(rng.randrange(20, 120))] + shared
        texts.append(" ".join(x.upper() if rng.random() < 0.1 else x for x in w))
    return list(enumerate(texts))


def test_join_equals_all_pairs(spark):
    for seed, n, percent in ((1, 3, 90), (2, 5, 80), (3, 2, 70)):
        rows = corpus(seed)
        assert got(J.join(spark, spark.createDataFrame(rows, "doc_id long, text string"), n, percent)) == brute(rows, n, percent), (seed, n, percent)


def test_long_lists_are_dealt_to_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "LIST", 7)
    monkeypatch.setattr(J, "COMMON", 5)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1 :] + ([f"y{i}", f"z{i}"] if i % 3 else []))) for i in range(60) for k in [i % 60]]
    assert got(J.join(spark, spark.createDataFrame(rows, "doc_id long, text string"), 3, 90)) == brute(rows, 3, 90)


def test_rough_rows(spark, rough):
    rows = [(r["doc_id"], r["text"]) for r in rough.collect()]
    assert got(J.join(spark, rough)) == brute(rows, 3, 90)
    kept = J.one_of_each(spark, rough)
    assert kept.columns == rough.columns
    # 7 and 8 are near copies of 6; rows with empty texts stay.
    assert sorted(r["doc_id"] or 0 for r in kept.select("doc_id").collect()) == [0, 0, 1, 2, 3, 4, 5, 6, 9, 10, 12, 13]


def test_empty_table(spark, empty):
    assert J.join(spark, empty).count() == 0 and J.one_of_each(spark, empty).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=300), st.sets(st.integers(0, 2**64 - 1), max_size=300))
def test_bitmaps_never_overstate(a, b):
    import numpy as np

    x, y = (np.array(sorted(s), dtype=np.uint64) for s in (a, b))
    if len(x) and len(y):
        for percent in (60, 80, 90):
            p, q = J.parities(x, percent), J.parities(y, percent)
            assert J.apart(int.from_bytes(p, "little"), 8 * len(p), int.from_bytes(q, "little"), 8 * len(q)) <= len(a ^ b)


def test_components(spark, work):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (301, 300), (300, 301)]
    rng = random.Random(4)
    rng.shuffle(edges)
    rows = {r["node"]: r["component"] for r in components(spark, spark.createDataFrame(edges, "a long, b long"), work).collect()}
    assert rows == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}
    assert components(spark, spark.createDataFrame([], "a long, b long"), f"{work}/none").count() == 0


def test_components_of_a_chain_in_ascending_order(spark, work):
    """Each document an edit of the one before: rounds by the least neighbour alone shorten this by one link a round."""
    edges = [(i, i + 1) for i in range(300)] + [(1000 + i, 1001 + i) for i in range(40)]
    rows = {r["node"]: r["component"] for r in components(spark, spark.createDataFrame(edges, "a long, b long"), work).collect()}
    assert rows == {**{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1041)}}


def test_components_raise_when_rounds_run_out(spark, work, monkeypatch):
    monkeypatch.setattr(graph, "ROUNDS", 2)
    with pytest.raises(RuntimeError):
        components(spark, spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long"), work)


def test_frequent_ngrams_change_nothing(spark, monkeypatch):
    rows = corpus(9, 80)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    a = got(J.join(spark, df))
    monkeypatch.setattr(J, "COMMON", 1)
    assert got(J.join(spark, df)) == a and F is not None


def test_sliding_windows_by_all_pairs(spark):
    """Each text is the one before, moved by some words: linked to its neighbours only, one component of 300."""
    rng = random.Random(6)
    stream = [f"w{rng.randrange(10**6)}" for _ in range(1_500)]
    rows = [(i, " ".join(stream[3 * i : 3 * i + 120])) for i in range(300)]
    rng.shuffle(rows)
    assert got(J.join(spark, spark.createDataFrame(rows, "doc_id long, text string"), 3, 90)) == brute(rows, 3, 90)


@pytest.mark.parametrize("order", ["ascending", "descending", "shuffled"])
def test_long_chains_take_few_rounds(spark, work, monkeypatch, order):
    monkeypatch.setattr(graph, "ROUNDS", 24)
    ids = list(range(1_000))
    if order == "descending":
        ids.reverse()
    if order == "shuffled":
        random.Random(2).shuffle(ids)
    edges = spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long")
    rows = components(spark, edges, work).collect()
    assert {r["node"] for r in rows} == set(range(1_000)) and {r["component"] for r in rows} == {0}


def test_repeated_rows_and_shared_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (1, a), (2, b), (2, a), (None, c), (None, c), (3, b + " end"), (4, ""), (4, ""), (None, None)]
    kept = J.one_of_each(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(1, a), (2, b), (None, c), (4, ""), (4, ""), (None, None)], key=str)
