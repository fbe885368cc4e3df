import hashlib
import math
import re
import zlib

from pyspark.sql import functions as F

from paperloom.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TO_LOWER = str.maketrans(resampling.UPPER, resampling.LOWER)


def grams(text, longest=1):
    w = WORD.findall((text or "").translate(TO_LOWER))
    return w, [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, longest=1, k=10_000, percent=10):
    """(doc_id, n_features, weight, score, rank) of each (doc_id, text), in order."""
    bucket = lambda g: zlib.crc32(g.encode()) % k
    counts = []
    for texts in ([t for _, t in docs], target):
        c = [0] * k
        for t in texts:
            for g in grams(t, longest)[1]:
                c[bucket(g)] += 1
        counts.append(c)
    s, t = map(sum, counts)
    gain = [math.floor(1000 * math.log(float(b + 1) * float(s + k) / (float(a + 1) * float(t + k)))) for a, b in zip(*counts)]
    rows = []
    for i, text in docs:
        w, own = grams(text, longest)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(g)] for g in own)
        rows.append((i, len(w), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    some = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    some = some[: percent * len(some) // 100]
    ranks = {}
    for n, r in enumerate(some, 1):
        ranks.setdefault(r, []).append(n)
    return [(*r[:1], *r[2:], ranks[r].pop(0) if ranks.get(r) else None) for r in rows]


def told(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x or 0) for x in r))


def test_rows_equal_brute_force(spark, rough):
    target = [r["text"] for r in rough.collect()][4:8]
    for longest, percent in ((1, 10), (3, 60), (2, 100)):
        got = resampling.scores(spark, rough, rough.filter("doc_id between 5 and 7").limit(4), longest, percent=percent)
        want = brute([(r["doc_id"], r["text"]) for r in rough.collect()], target, longest, percent=percent)
        assert told(got.select("doc_id", "n_features", "weight", "score", "rank").collect()) == told(want)


def test_documents_in_many_ranges_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(7)
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    for few in (1, 30):
        spark.conf.set("spark.sql.shuffle.partitions", few)
        got = told(resampling.query(spark, "/root/testdata/sf0.001").collect())
        assert got == told(brute([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in target.collect()]))
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_ties_go_to_the_smaller_id(spark):
    rows = spark.createDataFrame([(i, 30, 5) for i in (9, 3, 7, 1, None)] + [(2, 30, 6), (0, 3, 99)], "doc_id long, n_words long, score long")
    got = {r["doc_id"]: r["rank"] for r in resampling.drawn(spark, rows, 100).collect()}
    assert got == {2: 1, 1: 2, 3: 3, 7: 4, 9: 5, None: 6, 0: None}


def test_likely_documents_are_drawn_and_columns_stay(spark):
    near, far = "alpha beta gamma delta " * 10, "one two three four " * 10
    docs = spark.createDataFrame([(i, near if i % 10 == 0 else far, "x", "y") for i in range(100)], "doc_id long, text string, rank string, _drawn_id string")
    out = resampling.resampled(spark, docs, docs.filter("doc_id = 0").select("text"))
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == set(range(0, 100, 10))


def test_empty_tables(spark, empty, rough):
    assert resampling.scores(spark, empty, rough).count() == 0
    assert resampling.scores(spark, rough, empty).filter(F.col("rank").isNull()).count() == rough.count()  # a tenth of nine is none
