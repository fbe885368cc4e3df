import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from paperloom.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least_docs=3, top=200):
    """{(lang, source, part, item, value, rank)} of (lang, source, text) rows, term by term."""
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = TERM.findall((text or "").translate(TO_LOWER))
        groups[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        own = {s: c for (x, s), c in groups.items() if x == lang}
        whole = sum(own.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[k] for k in kept) + len(kept)) for t in kept}  # noqa: E731, B023
        p, q = {s: share(c) for s, c in own.items()}, share(whole)
        for s in own:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in own if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, k) for k, (value, item) in enumerate(found[:most], 1)}
    return out


def told(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def texts(seed, n, sources, vocabulary=300):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeÉßЖ漢") for _ in range(rng.randrange(1, 6))) for _ in range(vocabulary)]
    pick = lambda: words[min(int(rng.expovariate(0.02)), vocabulary - 1)]
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(sources), " ".join(rng.choice([str.lower, str.upper, str])(pick()) for _ in range(rng.randrange(40)))) for _ in range(n)]
    return rows + [("fr", "lonely", "no term is kept here"), ("fr", "other", None), ("en", "words", "1 2 3")]


@pytest.mark.parametrize("heavy", [0, 1, 3, 1_000])
def test_all_terms_dense_to_all_light(spark, work, monkeypatch, heavy):
    monkeypatch.setattr(divergence, "TILE", 3)
    monkeypatch.setattr(divergence, "CELLS", 64)
    rows = texts(5, 250, [*"abcdefg", None])
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    assert told(divergence.audit(spark, docs, work, heavy, top=7)) == brute(rows, top=7)


def test_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["lang"], r["source"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert told(divergence.query(spark, sf)) == brute(rows)


def test_rough_rows_and_empty_tables(spark, rough, empty, work):
    rows = [(r["lang"], r["source"], r["text"]) for r in rough.collect()]
    assert told(divergence.audit(spark, rough, work)) == brute(rows)
    out = divergence.audit(spark, empty, f"{work}/none")
    assert out.count() == 0 and out.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_shares_beyond_64_bits(spark):
    df = spark.createDataFrame([(10**12, 3 * 10**12, 10**9), (0, 7, 0)], "n long, total long, v long")
    got = [r[0] for r in df.select(divergence.share(F.col("n"), F.col("total"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (10**12 + 1) // (3 * 10**12 + 10**9), None]


def test_counts_are_passed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 5)
    rows = texts(8, 60, ["a", "b"])
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    whole = Counter()
    for lang, source, text in rows:
        whole.update((lang or "", source or "", t) for t in TERM.findall((text or "").translate(TO_LOWER)))
    assert {(r["lang"], r["source"], r["term"]): r["n"] for r in divergence.counted(docs).collect()} == dict(whole)


def test_counts_of_terms_pass_one_exchange(spark, work):
    """What is told of a term (documents, occurrences, groups) comes from the exchange that counts it, and is no join."""
    docs = spark.createDataFrame(texts(9, 200, [*"abc", None]), "lang string, source string, text string").repartition(5)
    plan = divergence.counted(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(lang" in plan and "source" not in plan.split("hashpartitioning(", 1)[1].split(")")[0]
    rows = divergence.Tables(spark, docs, work).rows
    assert "lead" in rows.columns
    leads = rows.filter("lead").select("lang", "term")
    assert leads.count() == leads.distinct().count() == rows.select("lang", "term").distinct().count() < rows.count()


def test_words_end_with_their_text_and_pieces_add_up(spark, monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 40)
    monkeypatch.setattr(divergence, "HELD", 30)
    some = ["ab", "cd", "", "ab CD\0ab", "é", "Éx1é", None, "漢字 " * 30, "x" * 100, "ab", "\n", "[`{@Z"]
    rows = [(lang, source, text) for lang in ("en", None) for source in ("a", "b") for text in some * 3]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(2)
    n, held = Counter(), Counter()
    for lang, source, text in rows:
        found = TERM.findall((text or "").translate(TO_LOWER))
        n.update((lang or "", source, t) for t in found)
        held.update((lang or "", source, t) for t in set(found))
    got = divergence.counted(docs).select("lang", "source", "term", "n", "docs").collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == {k: (n[k], held[k]) for k in n} and len(got) == len(n)


def test_steps_of_a_task_are_columns(spark, work, monkeypatch):
    """A task's Python takes no step a word, and none a pair of places of a posting."""
    import sys

    import pyarrow as pa

    runs, steps = [], Counter()
    monkeypatch.setattr(divergence.common, "task", lambda run: runs.append(run) or run)
    docs = spark.createDataFrame([("en", "a", "w")], "lang string, source string, text string")
    divergence.counted(docs)
    many = 2_000
    texts = pa.array([f"w{'abcdefghij'[i % 10]} same words again" for i in range(many)])
    batch = pa.RecordBatch.from_arrays([texts, pa.array(["en"] * many), pa.array(["a"] * many)], names=["text", "lang", "source"])
    sys.setprofile(lambda _, kind, __: steps.update([kind]))
    out = list(runs[0](iter([batch])))
    sys.setprofile(None)
    assert sum(b.num_rows for b in out) == 13 and steps["call"] + steps["c_call"] < 3 * many

    divergence.light(divergence.Tables(spark, docs, work), 16)
    plain, calls = divergence._f, []
    monkeypatch.setattr(divergence, "_f", lambda p, q: calls.append(1) or plain(p, q))
    held = [[{"no": i, "p": 5 + i * k, "none": 3 + i} for i in range(k)] for k in range(2, 12)]
    kind = pa.list_(pa.struct([("no", pa.int32()), ("p", pa.int64()), ("none", pa.int64())]))
    out = list(runs[-1](iter([pa.RecordBatch.from_arrays([pa.array(["en"] * 10), pa.array(held, kind)], names=["lang", "held"])])))
    want = Counter()
    for posting in held:
        for a in posting:
            for b in posting:
                if a is not b:
                    want[a["no"], b["no"]] += plain(a["p"], b["p"]) - plain(a["p"], b["none"]) - plain(a["none"], b["p"]) + plain(a["none"], b["none"])
    assert {(r["a"], r["b"]): r["value"] for b in out for r in b.to_pylist()} == dict(want) and len(calls) <= 4 * 10
