import collections
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_ngram_join import brute

SECRET = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]{8,})", re.A)


def test_stages_are_named_and_in_order():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near copies", "secret scan", "mixing", "packing"] and corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The output of each stage over sf0.001, each held on its own input."""
    root, sf = tmp_path_factory.mktemp("stages"), "/root/testdata/sf0.001"
    docs = [spark.read.parquet(f"{sf}/documents.parquet")]
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, docs[-1], sf).write.parquet(f"file://{root}/{k}")
        docs.append(spark.read.parquet(f"file://{root}/{k}"))
    return docs


def test_columns_stay(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns and df.dtypes == stages[0].dtypes


def test_near_copies_by_all_pairs(stages):
    before, after = stages[1], stages[2]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    want = sorted(i for (_, i), _, c in brute(rows, 5, 80) if i == c)
    assert sorted(r["doc_id"] for r in after.collect()) == want


def test_quality_leaves_labelled_good_documents(spark, stages):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").filter("quality = 1")
    long = stages[0].filter(F.size(F.split("text", r"\s+")) >= 55).join(labels, "doc_id", "left_semi")
    assert long.join(stages[1], "doc_id", "left_anti").count() == 0


def test_secrets_are_gone_and_other_texts_stay(stages):
    before = {r["doc_id"]: r["text"] for r in stages[2].collect()}
    after = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    assert before.keys() == after.keys()
    for i, t in after.items():
        assert not SECRET.search(t) and (t == before[i] or "[SECRET]" in t)


def test_mix_repeats_whole_documents(stages):
    texts = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    rows = stages[4].collect()
    assert all(texts[r["doc_id"]] == r["text"] for r in rows)
    counts = stages[4].groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert counts <= 2


def test_sequences_hold_the_mix(stages):
    rows = stages[5].groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("e")).collect()
    assert all(r["n"] == r["e"] <= 1024 for r in rows)
    assert stages[5].filter("piece = 0").count() == stages[4].count()


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages_take_rough_and_empty_tables(spark, rough, empty, k):
    name, f = corpus_pipeline.STAGES[k]
    docs = rough
    rows, none = f(spark, docs, "unused"), f(spark, empty, "unused")
    assert none.count() == 0
    if name == "packing":
        pieces = [r["doc_id"] for r in rows.filter("piece = 0").collect()]
        assert sorted(i or 0 for i in pieces) == sorted(r["doc_id"] or 0 for r in docs.collect())
        return
    assert rows.columns == docs.columns and none.columns == docs.columns
    texts = collections.Counter((r["doc_id"], r["text"]) for r in docs.collect())
    out = [(r["doc_id"], r["text"]) for r in rows.collect()]
    if name == "quality rules":
        # 5, 6 and its copies: all others have too few words.
        assert {i for i, _ in out} <= {5, 6, 7, 8} and all(x in texts for x in out)
    elif name == "near copies":
        assert sorted(i or 0 for i, _ in out) == [0, 0, 1, 2, 3, 4, 5, 6, 9, 10, 12, 13]
    elif name == "secret scan":
        assert sorted((i or 0 for i, _ in out)) == sorted(r[0] or 0 for r in texts.elements()) and all(x in texts or "[SECRET]" in x[1] for x in out)
    else:
        assert all(x in texts for x in out)


def test_near_copies_with_repeated_and_null_ids_by_all_pairs(spark):
    rng = __import__("random").Random(3)
    base = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(12)]
    rows = [(rng.choice([None, 1, 2, 3, 4, 5]), t if rng.random() < 0.5 else t + f" x{k}") for k, t in enumerate(base * 4)]
    near = dict(corpus_pipeline.STAGES)["near copies"]
    out = [(r[0], r[1]) for r in near(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "unused").select("doc_id", "text").collect()]
    assert len(out) == len(base)
    for t in base:
        group = [r for r in rows if r[1].startswith(t)]
        kept = [r for r in out if r[1].startswith(t)]
        assert len(kept) == 1 and (kept[0][0] is None) == all(i is None for i, _ in group)
        assert kept[0][0] is None or kept[0][0] == min(i for i, _ in group if i is not None)
