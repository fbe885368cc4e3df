"""Runs that break off, batches that are repeated, records that can't be read, lookups that skip row groups."""

import pytest
from pyspark.sql import functions as F

from paperloom import schema, shared
from paperloom.operators import dedup, pubmed
from paperloom.operators.store import CorpusStore
from paperloom.plans import collect
from paperloom.streaming import upserts

RECORD = "<PubmedArticle><MedlineCitation><PMID>%s</PMID><Article><ArticleTitle>t%s</ArticleTitle></Article></MedlineCitation></PubmedArticle>"
WORKS = "doi string, cited_by_count long, fwci double, percentile double, oa_url string"
WHEN = ("2024-01-01T00:00:00", "2024-01-01T00:01:00")


class Breaking(CorpusStore):
    """A store whose process ends behind its n-th commit."""

    left = 99

    def _commit(self, *args, **more):
        super()._commit(*args, **more)
        self.left -= 1
        if not self.left:
            raise ConnectionError("lost")


def some_papers(spark, n=12):
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("pmid"), F.when(F.col("id") % 4 != 0, F.concat(F.lit("10.1/"), "id")).alias("doi"),
        (F.col("id") % 3 == 0).alias("is_full_text_pmc"),
    )
    lacking = [f for f in schema.paper() if f.name not in rows.columns]
    return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking})


def state(store):
    out = {}
    for table in ("queries", "papers", "failed_dois", "rejects", "collection_runs"):
        out[table] = sorted(map(str, store.read(table).collect()))
    return out


def test_a_run_that_breaks_off_behind_any_commit_is_repeated(spark):
    found, works = some_papers(spark), spark.createDataFrame([("10.1/1", 5, None, None, None)], WORKS)
    rejects = pubmed.bad(pubmed.checked(spark.createDataFrame([("x",), (None,)], "xml string")))
    more = {"skip_existing": True, "run_id": "r1", "rejects": rejects}
    whole = CorpusStore(spark, shared.folder(spark, "whole"), 2)
    want_run = collect.collect(whole, found, works, "q", *WHEN, **more).collect()
    assert want_run[0]["failed_pubmed"] == 2 and want_run[0]["total_processed"] == 12
    want = state(whole)
    for n in range(1, 6):
        base = shared.folder(spark, "broken")
        store = Breaking(spark, base, 2)
        store.left = n
        with pytest.raises(ConnectionError):
            collect.collect(store, found, works, "q", *WHEN, **more)
        again = CorpusStore(spark, base, 2)
        assert collect.collect(again, found, works, "q", *WHEN, **more).collect() == want_run, n
        assert state(again) == want, n
    # Another id is another run.
    other = collect.collect(again, found, works, "q", *WHEN, run_id="r2").first()
    assert other["id"] == 2 and again.queries().count() == 2 and again.read("papers").count() == 12


def test_a_broken_run_counts_its_own_papers_though_another_came_between(spark):
    found, works = some_papers(spark), spark.createDataFrame([], WORKS)
    base = shared.folder(spark, "between")
    store = Breaking(spark, base, 2)
    store.left = 2
    with pytest.raises(ConnectionError):
        collect.collect(store, found, works, "q", *WHEN, run_id="r1")
    store = CorpusStore(spark, base, 2)
    collect.collect(store, found.filter("pmid < '5'"), works, "other", *WHEN, run_id="r2")
    run = collect.collect(store, found, works, "q", *WHEN, run_id="r1").first()
    assert run["total_processed"] == 12 and run["query"] == "q"


def test_marks(spark):
    store = CorpusStore(spark, shared.folder(spark, "marks"), 2)
    assert store.marked("papers", "a") is None and store.marked("papers", None) is None
    v = store.upsert("papers", some_papers(spark, 3), "a")
    store.upsert("papers", some_papers(spark, 4), "a/1")
    assert store.marked("papers", "a") == v and store.upsert("papers", some_papers(spark, 9), "a") == v
    assert store.read("papers").count() == 4 and store.marked("papers", "a/") is None
    with pytest.raises(ValueError):
        store.upsert("papers", some_papers(spark, 1), "two\nlines")


def test_a_repeated_batch_of_a_stream_does_not_undo_later_writes(spark, tmp_path):
    store = CorpusStore(spark, shared.folder(spark, "stream"), 2)
    source, checkpoint = str(tmp_path / "in"), tmp_path / "checkpoint"
    some_papers(spark, 5).write.parquet(source)
    start = lambda: upserts.upsert_stream(
        upserts.read_stream(spark, source, some_papers(spark, 1)), store, "papers", str(checkpoint)
    ).awaitTermination()
    start()
    store.upsert("papers", some_papers(spark, 5).withColumn("title", F.lit("later")))
    # As if the process had ended before Spark noted that the batch was done.
    for f in checkpoint.glob("commits/*0*"):
        f.unlink()
    (checkpoint / "commits" / ".0.crc").unlink(missing_ok=True)
    start()
    assert {r["title"] for r in store.read("papers").collect()} == {"later"}
    some_papers(spark, 7).write.mode("append").parquet(source)
    start()
    assert store.read("papers").count() == 7 and store.read("papers").filter("title is null").count() == 7


def test_every_record_is_a_paper_or_told(spark):
    good, cut = RECORD % (1, 1), (RECORD % (2, 2))[:-30]
    book = "<PubmedBookArticle><BookDocument><PMID>9</PMID></BookDocument></PubmedBookArticle>"
    texts = [good, good, cut, RECORD % ("", 3), "words", "", " \n", None, book, "<PubmedArticle><a></b></PubmedArticle>"]
    told = pubmed.checked(spark.createDataFrame([(t,) for t in texts], "xml string")).cache()
    assert told.count() == len(texts)
    assert sorted(r["pmid"] for r in pubmed.good(told).collect()) == ["1", "1", "9"]
    bad = sorted((r["reason"], r["pmid"] or "") for r in pubmed.bad(told).collect())
    assert bad == [("empty", ""), ("empty", ""), ("empty", ""), ("malformed", ""), ("malformed", "2"), ("no id", ""), ("no record", "")]
    # The record is kept as it came, and without rejects it is no row of nulls.
    assert {r["record"] for r in pubmed.bad(told).filter("reason = 'malformed'").collect()} == {cut, texts[-1]}
    assert pubmed.papers(spark.createDataFrame([(cut,), (good,)], "xml string")).count() == 1
    none = pubmed.checked(spark.createDataFrame([], "xml string"))
    assert none.count() == 0 and pubmed.good(none).count() == 0


def test_rejects_are_retried(spark):
    store, works = CorpusStore(spark, shared.folder(spark, "retry"), 2), spark.createDataFrame([], WORKS)
    texts = [RECORD % (1, 1), (RECORD % (2, 2))[:-30], (RECORD % (3, 3))[:-30], "words"]
    run = collect.collect_xml(store, spark.createDataFrame([(t,) for t in texts], "xml string"), works, "q", *WHEN).first()
    assert (run["total_processed"], run["failed_pubmed"]) == (1, 3)
    two = store.read("rejects").filter("pmid = '2'").select("digest", F.lit(RECORD % (2, 2)).alias("record"))
    again = collect.retry_rejects(store, works, "2024-01-02", "2024-01-02", "retry-1", two).first()
    assert (again["total_processed"], again["failed_pubmed"]) == (1, 2)
    left = {(r["pmid"], r["reason"], r["timestamp"]) for r in store.read("rejects").collect()}
    assert left == {("3", "malformed", "2024-01-02"), (None, "no record", "2024-01-02")}
    assert sorted(r["pmid"] for r in store.read("papers").collect()) == ["1", "2"]


def scanned(df):
    """Rows that the scans of a plan gave."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
    return total


def test_lookups_skip_row_groups(spark):
    store = CorpusStore(spark, shared.folder(spark, "lookup"), 8)
    rows = some_papers(spark, 1).select("pmcid").join(spark.range(8000)).select(
        F.col("id").cast("string").alias("pmid"), F.concat(F.lit("10.1/"), F.md5(F.col("id").cast("string"))).alias("doi")
    )
    store.upsert("papers", rows)
    one = store.paper("77")
    assert one.first()["pmid"] == "77" and scanned(one) <= 8000 / 4
    doi = one.first()["doi"]
    by_doi = store.paper(doi, "doi")
    assert by_doi.first()["pmid"] == "77" and scanned(by_doi) <= 8000 / 2
    assert scanned(store.paper("10.1/8", "doi")) == 0 and store.paper("none").count() == 0


def test_groups_resolved_as_by_a_window(spark):
    rows = [(str(k), "hot" if k % 3 == 0 else f"d{k % 5}" if k % 7 else None, [None, "", "2024", "2023"][k % 4], k % 5 == 0,
             [None, "", f"t{k}"][k % 3 if k % 2 else 2], [None, [], ["a"]][k % 3]) for k in range(60)]
    p = spark.createDataFrame(
        rows, "pmid string, doi string, collection_date string, is_full_text_pmc boolean, title string, mesh_terms array<string>"
    )
    for full in (False, True):
        groups = {}
        for r in rows:
            if r[1]:
                groups.setdefault(r[1], []).append(r)
        order = lambda r: (not r[3] if full else 0, r[2] is None, [-ord(c) for c in r[2] or ""] + [1], r[0])
        firsts = {d: min(g, key=order)[0] for d, g in groups.items()}
        got = {(r["doi"], r["pmid"], r["action"]) for r in dedup.plan(p, full).collect()}
        assert got == {(d, r[0], "keep" if r[0] == firsts[d] else "delete") for d, g in groups.items() for r in g}
        kept = sorted(r["pmid"] for r in dedup.keep_one(p, full).collect())
        assert kept == sorted([*firsts.values(), *(r[0] for r in rows if not r[1])])
    merged = {r["doi"]: r for r in dedup.merge_groups(p).collect() if r["doi"]}
    order = lambda r: (r[2] is None, [-ord(c) for c in r[2] or ""] + [1], r[0])
    for d, g in groups.items():
        g = sorted(g, key=order)
        title = next((r[4] for r in g if r[4]), g[0][4])
        mesh = next((r[5] for r in g if r[5] is not None), None)
        assert (merged[d]["pmid"], merged[d]["title"], merged[d]["mesh_terms"], merged[d]["collection_date"]) == (g[0][0], title, mesh, g[0][2])
        assert merged[d]["is_full_text_pmc"] == any(r[3] for r in g)
