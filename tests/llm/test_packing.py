import random
import zlib

import numpy as np
import pytest

from paperloom.llm import packing


def test_cuts():
    assert packing.cuts(1, 4) == [(0, 1)] and packing.cuts(4, 4) == [(0, 4)] and packing.cuts(9, 4) == [(0, 1), (1, 4), (5, 4)] and packing.cuts(8, 4) == [(0, 4), (4, 4)]


def check(rows, length):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return len(by)


def test_rough_rows(spark, rough, tokenizer):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer)
    rows = packing.pack_documents(spark, rough, tokenizer, 2).collect()
    want = []
    for r in rough.select("doc_id", "text").collect():
        ids = np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [2], dtype="<u4")
        want += [(r["doc_id"] or 0, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(packing.cuts(len(ids), 1024))]
    assert sorted((r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    assert check(rows, 1024) >= -(-sum(r["length"] for r in rows) // 1024)
    assert any(r["doc_id"] is None for r in rows)


def test_empty_table(spark, empty, tokenizer):
    assert packing.pack_documents(spark, empty, tokenizer, 2).count() == 0


def test_large_ids_beside_null(spark, tokenizer):
    rows = spark.createDataFrame([(2**62 + 1, "a"), (None, "b"), (2**53 + 1, "c")], "doc_id long, text string")
    out = packing.pack_documents(spark, rows, tokenizer, 2).collect()
    assert {r["doc_id"] for r in out} == {2**62 + 1, None, 2**53 + 1} and len({r["sequence_id"] for r in out}) == 1


def test_near_the_bound_over_blocks(spark, work, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 700)
    rng = random.Random(5)
    sizes = [min(1023, int(rng.expovariate(1 / 300)) + 1) for _ in range(3_000)] + [1024] * 20
    rows = spark.createDataFrame([(i, i, 0, 0, n, 0) for i, n in enumerate(sizes)], packing.PIECES)
    out = packing.pack(spark, packing.common.cut(spark, rows, f"{work}/p"), work).collect()
    assert len(out) == len(sizes) and check(out, 1024) <= -(-sum(sizes) // 1024) * 1.01 + 5


def starts(sizes):
    """Bins of best-fit decreasing, which an island starts from."""
    counts = [0] * 1025
    for x in sizes:
        counts[int(x)] += 1
    return packing.best_fit([], packing.Pool(counts))


def whole(bins, sizes):
    return sorted(x for b in bins for x in b) == sorted(map(int, sizes)) and max(map(sum, bins)) <= 1024


@pytest.mark.parametrize("seed", range(3))
def test_operators_of_the_search_keep_every_document(seed):
    rng = np.random.default_rng(seed)
    own = random.Random(seed)
    sizes = rng.integers(1, 1024, 400)
    counts = packing.counts_of([sizes.tolist()], 1024)
    a, b = starts(sizes), packing.best_fit([], packing.Pool(list(counts)), 2)
    assert whole(a, sizes) and whole(b, sizes)
    for _ in range(30):
        a, b = packing.crossover(a, b, counts, own), packing.mutate(a, 1024, own)
        assert whole(a, sizes) and whole(b, sizes)
    assert whole(packing.evolve(sizes, [a, b], seed), sizes) and whole(packing.evolve(sizes, [], seed), sizes)


@pytest.mark.parametrize("lo, hi, saved", [(200, 512, 0.03), (100, 400, 0.005), (256, 600, 0.03), (300, 700, 0)])
def test_the_search_beats_its_start(lo, hi, saved):
    """Two islands of two epochs against best-fit decreasing; lengths of 300 to 700 leave it almost nothing to save."""
    sizes = np.random.default_rng(1).integers(lo, hi + 1, 4_000)
    first = len(starts(sizes))
    islands = [packing.evolve(sizes, [], seed) for seed in range(2)]
    best = [packing.evolve(sizes, [islands[k], islands[1 - k]], 10 + k) for k in range(2)]
    assert all(whole(b, sizes) for b in best)
    assert min(map(len, best)) <= first * (1 - saved) and min(map(len, best)) >= packing.bound(sizes, 1024)
    assert min(map(len, best)) <= min(map(len, islands))


def test_generations_beat_the_islands_own_start():
    sizes = np.random.default_rng(2).integers(200, 513, 4_000)
    assert len(packing.evolve(sizes, [], 1, generations=24)) < len(packing.evolve(sizes, [], 1, generations=0))


def test_bound_is_below_the_optimum():
    """By all partitions of a few documents."""
    rng = random.Random(3)

    def least(left, bins):
        if not left:
            return len(bins)
        x, out = left[0], len(left) + len(bins)
        for i, b in enumerate(bins):
            if b + x <= 20 and b not in bins[:i]:
                out = min(out, least(left[1:], bins[:i] + [b + x] + bins[i + 1 :]))
        return min(out, least(left[1:], bins + [x]))

    for _ in range(60):
        sizes = [rng.randrange(1, 20) for _ in range(7)]
        assert packing.bound(sizes, 20) <= least(sizes, [])


def test_seats_and_bytes():
    bins = [[3, 5], [5], [1, 1, 1]]
    assert packing.from_bytes(packing.to_bytes(bins)) == bins and packing.from_bytes(packing.to_bytes([])) == []
    at = packing.seats(np.array([1, 5, 3, 1, 5, 1]), bins).tolist()
    assert at == [2, 0, 0, 2, 1, 2]
