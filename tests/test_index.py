import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paperloom.operators import index
from paperloom.operators.index import TextIndex
from paperloom.sources.querylang import predicate

KIND = "pmid string, title string, abstract string, mesh_terms array<string>, authors array<string>, year string, date_published string, doi string, source string, journal string, is_full_text_pmc boolean"
WORDS = ["alpha", "Beta", "gamma", "covid-19", "19", "covid", "größe", "GRÖSSE", "naïve", "漢字", "a.b", "al", "alpine", "x_y"]


def rows(n=120, seed=1):
    rng = random.Random(seed)
    text = lambda k: rng.choice([" ", ", ", "\n", " - "]).join(rng.choice(WORDS) for _ in range(rng.randrange(k)))
    out = []
    for i in range(n):
        title, abstract = (rng.choice([text(6), text(6), None, ""]) for _ in range(2))
        out.append((str(i), title, abstract, rng.choice([[], ["Alpha", "beta gamma"]]), rng.choice([[], ["Gamma A", "Doe B"]]), str(1990 + i % 30), None, f"10.1/{i}", rng.choice(["PPR", "MED"]), "Journal", i % 2 == 0))
    return [*out, (None, "alpha", "beta", [], [], None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def papers(spark):
    return spark.createDataFrame(rows(), KIND).repartition(3).cache()


@pytest.fixture(scope="module")
def built(spark, papers, tmp_path_factory):
    return TextIndex.build(papers, f"file://{tmp_path_factory.mktemp('index')}")


QUERIES = [
    "alpha", "alpha[ti]", '"alpha beta"[tiab]', "al*[tiab]", '"beta al"*[tiab]', "covid-19[tiab]", '"covid 19"[tiab]', "a.b[ti] OR x_y", "größe[tiab] NOT 漢字", "abstract:gamma AND alpha[ti]",
    '"alpha alpha"', "(alpha OR beta) AND 1995:2005[dp]", "NOT alpha[tiab]", "alpha OR NOT beta[ti]", "alpha[mesh] AND gamma[au]", '"beta gamma gamma a"', "SRC:PPR", "nothing[tiab]", "naïve* AND SRC:MED NOT al*",
]


@pytest.mark.parametrize("query", QUERIES)
def test_the_index_finds_what_a_scan_finds(papers, built, query):
    known = papers.filter("pmid is not null")
    want = sorted(r["pmid"] for r in known.filter(predicate(query, papers.columns)).select("pmid").collect())
    assert sorted(r["pmid"] for r in built.search(known, query).select("pmid").collect()) == want


def brute(some, words):
    streams = {}
    for r in some:
        if r[0] is not None:
            text = " ".join(x for x in (r[1], r[2], " ".join(r[3]), " ".join(r[4])) if x is not None)
            streams[r[0]] = [index.folded(w) for w in re.findall(r"[^\W_]+", text)]
    mean, out = sum(map(len, streams.values())) / len(streams), {}
    for w in sorted(set(map(index.folded, words))):
        df = sum(w in s for s in streams.values())
        for i, s in streams.items():
            tf = Counter(s)[w]
            if tf:
                norm = tf + 1.2 * (0.25 + 0.75 * len(s) / mean)
                out[i] = out.get(i, 0) + math.log(1 + (len(streams) - df + 0.5) / (df + 0.5)) * tf * 2.2 / norm
    return out


def test_scores_equal_brute_force(built):
    for words in (["alpha"], ["Alpha", "beta", "alpha"], ["größe", "漢字", "none"]):
        want = brute(rows(), words)
        got = {r["pmid"]: r["score"] for r in built.scores(words).collect()}
        assert got.keys() == want.keys() and all(abs(got[i] - s) < 1e-9 for i, s in want.items())


@pytest.mark.parametrize("k", [1, 7, 1_000])
def test_the_best_of_many_blocks_are_exact(spark, papers, tmp_path, monkeypatch, k):
    monkeypatch.setattr(index, "BLOCK_PAPERS", 5)
    monkeypatch.setattr(index, "FIRST_BLOCKS", 2)
    own = TextIndex.build(papers, f"file://{tmp_path}")
    assert own.table("papers").select("block").distinct().count() > 10
    want = sorted(((-round(s, 9), i) for i, s in brute(rows(), ["beta", "naïve"]).items()))[:k]
    got = own.best(["beta", "naïve"], k).orderBy("rank").collect()
    assert [r["pmid"] for r in got] == [i for _, i in want] and [r["rank"] for r in got] == list(range(1, len(want) + 1))


def test_the_list_of_a_frequent_word_is_split(spark, tmp_path):
    some = spark.range(3_000).select(F.col("id").cast("string").alias("pmid"), F.lit("the same word").alias("title"), F.lit(None).cast("string").alias("abstract"), *(F.array().cast("array<string>").alias(c) for c in ("mesh_terms", "authors")))
    built = TextIndex.build(some, f"file://{tmp_path}")
    parts = index.parts_of(built, "the").collect()
    assert len(parts) > 1 and sum(r["rows"] for r in parts) == 3_000


def test_a_lookup_reads_its_terms_only(built):
    plan = built.leaf(0, "alpha", "tiab")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "EqualTo(term,alpha)" in plan.replace("In(term, [alpha])", "EqualTo(term,alpha)")


def test_empty_tables(spark, papers, tmp_path):
    own = TextIndex.build(papers.limit(0), f"file://{tmp_path}")
    assert own.search(papers.limit(0), "alpha").count() == 0 and own.best(["alpha"], 3).count() == 0


def test_a_phrase_is_met_without_a_row_a_place(papers, built):
    """Words that follow one another are met by papers: no place is a row, as the lists of frequent words are long."""
    for text in ('"alpha beta"', '"beta al"*', '"alpha alpha"', '"beta gamma gamma a"'):
        plan = built.leaf(0, text, "all")._jdf.queryExecution().optimizedPlan().toString()
        assert "explode(starts" not in plan and "start#" not in plan, text
    found = sorted(r["pmid"] for r in built.leaf(0, '"beta al"*', "all").collect())
    want = sorted(r["pmid"] for r in papers.filter("pmid is not null").filter(predicate('"beta al"*', papers.columns)).collect())
    assert found == want and found


def test_texts_are_dealt_only_where_ids_repeat(spark, tmp_path, monkeypatch):
    """Of papers of one pmid one is indexed; where none repeats, their texts reach the index from where they are read."""
    seen, plain_streams = [], index.streams
    monkeypatch.setattr(index, "streams", lambda p: (seen.append(p._jdf.queryExecution().optimizedPlan().toString()), plain_streams(p))[1])
    empty = [F.array().cast("array<string>").alias(c) for c in ("mesh_terms", "authors")]
    own = lambda n: spark.range(60).select((F.col("id") % n).cast("string").alias("pmid"), F.lit("same words").alias("title"), F.lit(None).cast("string").alias("abstract"), *empty)
    for n in (60, 50):
        built = TextIndex.build(own(n), f"file://{tmp_path}/{n}")
        assert {tuple(r) for r in built.table("terms").collect()} == {("same", n), ("words", n)}
        assert built.table("blocks").agg(F.sum("papers")).first()[0] == 2 * n and built.table("papers").count() == n
    assert "Aggregate" not in seen[0] and "Aggregate" in seen[1]
