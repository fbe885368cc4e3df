import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import suffix_dedup


def brute(rows, length):
    """(doc_id, n_bytes, spans, kept) of (doc_id, text) rows in order."""
    seen, out = set(), []
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            t = raw[s : s + length]
            if t in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(t)
        spans, start = [], None
        for k, g in enumerate([*gone, 0]):
            if g and start is None:
                start = k
            elif not g and start is not None:
                spans.append((start, k))
                start = None
        out.append((i, len(raw), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def told(df):
    return [(r["doc_id"], r["n_bytes"], [tuple(s) for s in r["removed_spans"]], bytes(r["kept"])) for r in df.collect()]


def texts(seed, n, letters="ab", longest=120):
    rng = random.Random(seed)
    passages = ["".join(rng.choice(letters) for _ in range(rng.randrange(5, 60))) for _ in range(12)]
    make = lambda: "".join(rng.choice([rng.choice(passages), rng.choice(letters) * rng.randrange(20), "é漢\0"[: rng.randrange(4)]]) for _ in range(rng.randrange(8)))
    rows = [make()[:longest] for _ in range(n)]
    return rows + [rng.choice(rows) for _ in range(n // 4)] + ["", None, "a" * 300]


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefghijklmnopqrstuvwxyz"])
@pytest.mark.parametrize("length", [1, 5, 12, 40])
def test_boundaries_equal_common_prefixes(letters, length):
    rng = np.random.default_rng(len(letters) + length)
    passage = rng.choice(list(letters.encode()), 60).astype(np.uint8)
    raw = np.concatenate([[0], rng.choice(list(letters.encode()), 300), [0], passage, [0], passage, rng.choice(list(letters.encode()), 100), passage[10:], [0] * 8]).astype(np.uint8)
    order = suffix_dedup.sorted_suffixes(raw, length + 1)
    assert sorted(order.tolist()) == list(range(len(raw)))
    twice = raw.tobytes() * 2
    turned = [twice[k : k + length] for k in order.tolist()]
    assert turned == sorted(turned)
    want = [True] + [a != b for a, b in zip(turned, turned[1:])]
    assert suffix_dedup.boundaries(raw, order, length).tolist() == want


@pytest.mark.parametrize("segment", [1 << 20, 31])
def test_equal_strings_have_equal_anchors(monkeypatch, segment):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
    rng = random.Random(4)
    passage = "".join(rng.choice("abc ") for _ in range(400)).encode()
    find = suffix_dedup.Anchors(20, 8)
    got = []
    for a, b in ((0, 0), (3, 50), (97, 1)):
        rows = [bytes(rng.choices(b"abc ", k=a)) + passage + bytes(rng.choices(b"abc ", k=b)), b"short", b"a" * 40]
        ends = np.cumsum([len(r) for r in rows])
        p, first, last, h = find(np.frombuffer(b"".join(rows), np.uint8), ends)
        each = {s: (q - s, x) for q, f, z, x in zip(p.tolist(), first.tolist(), last.tolist(), h.tolist()) for s in range(f, z + 1)}
        assert len(each) == sum(max(0, len(r) - 19) for r in rows)
        got.append([each[a + s] for s in range(len(passage) - 19)])
    assert got[0] == got[1] == got[2]


@pytest.mark.parametrize("hot, segment, block, held", [(1 << 16, 1 << 20, 1 << 20, 1 << 24), (3, 50, 200, 300), (0, 1 << 20, 1, 1), (1 << 16, 31, 64, 1 << 24)])
def test_spans_equal_brute_force(spark, work, monkeypatch, hot, segment, block, held):
    for name, value in (("SEGMENT", segment), ("BLOCK", block), ("HELD", held), ("ANCHORS", held)):
        monkeypatch.setattr(suffix_dedup, name, value)
    for seed, letters in ((1, "ab"), (2, "abcdefgh ")):
        rows = list(enumerate(texts(seed, 80, letters)))
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        got = told(suffix_dedup.deduplicated(spark, docs, f"{work}/{seed}", 12, 4, hot))
        assert sorted(got) == brute(rows, 12)


def test_given_documents_equal_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    want = [(i, n, sum(b - a for a, b in s), len(s), hashlib.sha256(k).hexdigest()) for i, n, s, k in brute(rows, 100)]
    assert sorted(tuple(r) for r in suffix_dedup.query(spark, sf).collect()) == want


def test_rough_rows_repeated_ids_and_empty_tables(spark, rough, empty, work):
    docs = rough.unionByName(rough.filter("doc_id is null or doc_id in (5, 6)"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = told(suffix_dedup.deduplicated(spark, docs, work))
    # Rows of equal ids may stand in any order of their own; it is that of the rows as they were numbered.
    named = spark.read.parquet(f"{work}/rows").orderBy("row").collect()
    assert sorted(((r["doc_id"], r["text"]) for r in named), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in named]
    assert ids == sorted(ids)
    want = brute([(r["doc_id"], r["text"]) for r in named], 100)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert suffix_dedup.deduplicated(spark, empty, f"{work}/none").count() == 0


def test_a_passage_of_all_documents(spark, work):
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(130))
    rows = [(k, f"{rng.random()} {passage} {rng.random()}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for hot in (1 << 16, 20):
        got = suffix_dedup.deduplicated(spark, docs, f"{work}/{hot}", hot=hot)
        assert sorted(told(got)) == brute(rows, 100)
    assert got.filter(F.size("removed_spans") > 0).count() == 299
