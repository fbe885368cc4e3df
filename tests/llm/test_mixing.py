import numpy as np
from pyspark.sql import functions as F

from paperloom.llm import mixing


def test_targets_reshare_the_excess():
    got = mixing.targets([("b", 100), ("a", 100), (None, 1_000)])
    # a weighs 3, b 1, null 2 and shares are of 1,800: a stops at 200, then b; null takes the rest.
    assert got["a"] == 200 and got["b"] == 200 and round(got[None], 6) == 1400
    assert mixing.targets([]) == {} and mixing.targets([("a", 0)]) == {"a": 0.0}


def test_sources_sort_by_code_point():
    got = mixing.targets([("\U0001F600", 10_000), ("￿", 10_000)])
    assert got["￿"] > got["\U0001F600"]


def test_tree_keeps_quotas():
    quotas = [1_000, 7, 0, 333]
    parts = np.array(mixing.split(quotas, 7))
    assert parts.sum(0).tolist() == quotas and parts.sum(1).max() - parts.sum(1).min() <= 1
    assert mixing.split(quotas, 7) == parts.tolist() and mixing.split([], 3) == [[], [], []]


def documents(spark):
    rows = [(i, "w " * (1 + i * 7 % 50), "hot" if i % 3 else f"s{i % 4}") for i in range(600)] + [(900, None, None), (901, "x", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_taken_words_meet_targets(spark, work):
    docs = documents(spark)
    rows = mixing.taken(*mixing.mix(spark, docs, work)).collect()
    assert len(rows) == 602 and all(r["taken"] <= 2 * r["size"] for r in rows)
    for s in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == s]
        assert sum(r["size"] for r in own) == own[0]["source_size"]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(1, own[0]["source_size"] / 1_000)


def test_pieces_are_disjoint_and_reruns_agree(spark, work):
    docs = documents(spark)
    _, a = mixing.mix(spark, docs, f"{work}/a", shards=5)
    _, b = mixing.mix(spark, docs.repartition(7), f"{work}/b", shards=5)
    key = lambda df: sorted((r["doc_id"], r["pass"], r["shard"], r["from_word"], r["to_word"]) for r in df.collect())
    one = key(a)
    assert one == key(b)
    last = {}
    for d, p, _, x, y in sorted(one, key=lambda r: (r[0], r[1], r[3])):
        assert x >= last.get((d, p), 0) and y > x
        last[d, p] = y
    assert len({r[2] for r in one}) == 5


def test_whole_documents(spark, rough, work):
    out = mixing.mixed_documents(spark, rough, work)
    assert out.columns == rough.columns
    texts = {(r["doc_id"], r["text"]) for r in rough.collect()}
    counts = out.groupBy("doc_id", "text").agg(F.count("*").alias("n")).collect()
    assert all((r["doc_id"], r["text"]) in texts and r["n"] <= 4 for r in counts)


def test_rough_and_empty(spark, rough, empty, work):
    rows = mixing.taken(*mixing.mix(spark, rough, f"{work}/a")).collect()
    assert len(rows) == rough.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert mixing.taken(*mixing.mix(spark, empty, f"{work}/b")).count() == 0


def test_each_pass_is_a_permutation():
    blocks, quotas = [10, 1, 7, 64], [23, 2, 5, 64]
    seen = {}
    for s, p, shard, lo, hi, factor, shift in mixing.runs(blocks, quotas, 3):
        assert 0 <= shard < 3
        for i in range(lo, hi):
            seen.setdefault((s, p), []).append((factor * i + shift) % blocks[s])
    assert all(len(set(v)) == len(v) for v in seen.values())
    assert {s: sum(len(v) for (t, _), v in seen.items() if t == s) for s in range(4)} == dict(enumerate(quotas))
    # The last pass takes blocks from all over a source, and not the first ones.
    assert sorted(seen[2, 0]) != list(range(5)) or sorted(seen[0, 2]) != list(range(3))


def brute_taken(rows, goal, blocks, quotas, shards):
    """{uid: {shard: words}}: draws each block word by word; ``rows`` are (uid, source, words before it, size)."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(r[3] for r in rows if r[1] == s) for s in sources}
    draws = {}
    for s, _, shard, lo, hi, factor, shift in mixing.runs(blocks, quotas, shards):
        for i in range(lo, hi):
            draws.setdefault((s, (factor * i + shift) % blocks[s]), []).append(shard)
    out = {}
    for uid, source, start, size in rows:
        no = sources.index(source)
        for x in range(start, start + size):
            block = next(k for k in range(blocks[no]) if k * total[source] // blocks[no] <= x < (k + 1) * total[source] // blocks[no])
            for shard in draws.get((no, block), []):
                own = out.setdefault(uid, {})
                own[shard] = own.get(shard, 0) + 1
    return out


def test_taken_equals_the_drawn_blocks(spark, work, monkeypatch):
    """Word by word over the blocks that the tree and the permutations draw; the tree decides ``shards``."""
    monkeypatch.setattr(mixing, "LEAST_BLOCKS", 40)
    docs = spark.createDataFrame([(i, "w " * (1 + i * 7 % 23), "hot" if i % 3 else f"s{i % 2}") for i in range(120)] + [(500, "x y z", None)], "doc_id long, text string, source string")
    rows = mixing.sized(docs).withColumn("uid", F.col("doc_id"))
    order = [(r["doc_id"], r["source"], r["start"], r["size"]) for r in mixing.streamed(rows, 121).collect()]
    totals = {}
    for _, s, start, size in order:
        totals.setdefault(s, []).append((start, size))
    for spans in totals.values():  # starts are a prefix sum
        at = 0
        for start, size in sorted(spans):
            assert start == at
            at += size
    size = {s: sum(n for _, n in v) for s, v in totals.items()}
    names = sorted(size, key=lambda s: (s is None, s or ""))
    goal = mixing.targets([(s, size[s]) for s in names])
    blocks = [max(1, min(size[s], 40)) for s in names]
    quotas = [round(k * goal[s] / size[s]) for s, k in zip(names, blocks)]
    want = brute_taken(order, goal, blocks, quotas, 5)
    got = {}
    for r in mixing.taken(*mixing.mix(spark, docs, work, shards=5)).collect():
        own = {int(a): int(b) for a, b in (x.split(":") for x in r["shards"].split(",") if x)}
        assert sum(own.values()) == r["taken"]
        if own:
            got[r["doc_id"]] = own
    assert got == want


def test_the_tree_is_in_the_plan(spark, work):
    plan = mixing.taken(*mixing.mix(spark, documents(spark), work))._jdf.queryExecution().optimizedPlan().toString()
    assert "shard" in plan and "factor" in plan
