import hashlib
import re
import struct

import xxhash
from pyspark.sql import functions as F

from paperloom.llm import fingerprints as P

UNITS = re.compile(r"[^\x20\x09-\x0D]{1,16}")


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def of_text(s):
    return signed(xxhash.xxh64_intdigest(s.encode(), 42))


def of_longs(*a):
    seed = 42
    for x in a:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", x), seed)
    return signed(seed)


def anchors(text):
    u = UNITS.findall(text)
    if len(u) < P.K:
        return [(0, of_text(" ".join(u)))] if u else []
    h = [of_text(x) for x in u]
    m = [of_longs(a, b) for a, b in zip(h, h[1:])]
    return [(i, of_longs(m[i], m[i + 2], m[i + 4], h[i + 6])) for i in range(len(u) - 6) if min(m[i : i + 6]) in (m[i], m[i + 5])]


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, of_text(r[1] or "")))
    texts = [t or "" for _, t in rows]
    out = []
    jac = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    for k, (i, _) in enumerate(rows):
        t, following = texts[k], texts[(k + 1) % len(texts)]
        q = len(t) // 4
        e = t[: len(t) - q] + following[:q]
        f, g, h = ([x for _, x in anchors(s)] for s in (t, e, following))
        written = lambda a: "".join(f"{x & 0xFFFFFFFF:08x}" for x in a)
        out.append((i or 0, len(t), hashlib.sha256(e.encode()).hexdigest(), written(f), written(g), round(jac(set(f), set(g)), 12), round(jac(set(f), set(h)), 12)))
    return sorted(out)


def result(docs, ranges):
    rows = P.with_neighbours(docs, ranges).select("doc_id", "n_chars", "edited_sha256", P.written("fp").alias("a"), P.written("edited").alias("b"), P.likeness("fp", "edited").alias("c"), P.likeness("fp", "following").alias("d"))
    return sorted((r[0] or 0, *r[1:5], round(r[5], 12), round(r[6], 12)) for r in rows.collect())


def test_equals_brute_force(spark, rough):
    rows = [(r["doc_id"], r["text"]) for r in rough.collect()]
    for ranges in (1, 3, 50):
        assert result(rough, ranges) == brute(rows)


def test_sparse_ids_and_one_row(spark):
    rows = [(i * i * 1_000_003, f"w{i} " * (i % 13) + "the end of it") for i in range(120)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string"), 8) == brute(rows)
    assert result(spark.createDataFrame([(5, "a b c d e f g h")], "doc_id long, text string"), 4) == brute([(5, "a b c d e f g h")])


def test_places(spark):
    text = " ".join(f"w{i % 37}x{i % 11}" for i in range(200))
    got = P.anchor_places(spark.createDataFrame([(1, text), (2, "a b"), (3, "")], "doc_id long, text string")).collect()
    assert [[(p["unit"], p["hash"]) for p in r["places"]] for r in got] == [anchors(t) for t in (text, "a b", "")]


def test_anchors_do_not_depend_on_their_surroundings(spark):
    middle = " ".join(f"m{i}" for i in range(60))
    rows = [(1, "x y z " + middle), (2, middle + " tail tail2")]
    a, b = P.with_anchors(spark.createDataFrame(rows, "doc_id long, text string"), "text", "fp").orderBy("doc_id").collect()
    own = {x for _, x in anchors(middle)}
    assert own <= set(a["fp"]) and own <= set(b["fp"])


def test_no_python_and_empty(spark, rough, empty):
    assert "Python" not in P.with_neighbours(rough, 4)._jdf.queryExecution().toString()
    assert P.with_neighbours(empty, 4).count() == 0
    assert F is not None


def test_an_id_that_many_rows_share_is_spread(spark):
    """A third of the rows without id, some of them equal, and a third of one id."""
    rows = [(None, f"null {i % 40} " + "a b c d e f g h " * (i % 5)) for i in range(60)] + [(7, f"seven {i} words of it " * (1 + i % 4)) for i in range(60)] + [(i, f"own {i} text") for i in range(60)]
    rows += [(None, "the same text in many rows")] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for ranges in (1, 4, 16):
        assert result(df, ranges) == brute(rows), ranges
    ranged = P.in_ranges(df, 16).filter("not guest")
    assert ranged.filter("doc_id is null").select("range").distinct().count() > 2 and ranged.filter("doc_id = 7").select("range").distinct().count() > 2
