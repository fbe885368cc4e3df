import json

from paperloom import cli
from paperloom.operators import corpus
from paperloom.operators.store import CorpusStore
from tests.test_operators import ids, papers


def test_commands(spark, tmp_path, capsys):
    base, other = f"file://{tmp_path}/s", f"file://{tmp_path}/o"
    store = CorpusStore(spark, base)
    store.upsert("papers", papers(spark, {"pmid": "1", "doi": "d", "collection_date": "2023", "title": "alpha", "mesh_terms": [], "authors": []}, {"pmid": "2", "doi": "d", "collection_date": "2024", "full_text": "a\n\nok then", "mesh_terms": [], "authors": [], "is_full_text_pmc": False}))
    CorpusStore(spark, other).upsert("papers", papers(spark, {"pmid": "9", "abstract": "new"}))
    run = lambda *a: cli.main([a[0], "--base", base, *a[1:]], spark)
    for command in ("stats", "duplicates", "dedup", "reclean", "cache"):
        run(command)
    run("search", "alpha[ti]")
    assert "delete" in capsys.readouterr().out
    run("export", "--out", f"file://{tmp_path}/all")
    run("failed", "--out", f"file://{tmp_path}/failed")
    run("dedup", "--strategy", "export", "--out", f"file://{tmp_path}/groups")
    groups = json.loads("".join(p.read_text() for p in sorted((tmp_path / "groups").glob("part-*"))))
    assert groups[0]["doi"] == "d" and groups[0]["count"] == 2
    assert "".join(p.read_text() for p in (tmp_path / "failed").glob("part-*")).strip() == "d | 2 | NO_TITLE"
    run("dedup", "--apply")
    assert ids(store.read("papers")) == ["2"]
    run("merge", "--source", other, "--apply")
    run("reclean", "--apply")
    assert {r["pmid"]: r["full_text"] for r in store.read("papers").collect()} == {"2": "ok then", "9": None}
    run("restore", "--version", "1")
    assert ids(store.read("papers")) == ["1", "2"]


def test_changes_and_summary(spark):
    a = papers(spark, {"pmid": "1", "abstract": "", "full_text": "x", "authors": ["a"]}, {"pmid": "2", "abstract": "same"})
    b = papers(spark, {"pmid": "1", "abstract": "new", "full_text": "xyz", "authors": ["a", "b"]}, {"pmid": "2", "abstract": "same"})
    rows = corpus.changes(a, b).collect()
    assert [(r["pmid"], r["changes"]) for r in rows] == [("1", ["abstract added", "full_text longer by 2", "authors grew by 1"])]
    run = spark.createDataFrame([("q", 3, 0, 0, 0, 0, 0, 0, "2024-01-01T00:00:00", "2024-01-01T00:02:00")], "query string, total_found long, total_processed long, with_full_text long, without_full_text long, with_openalex long, failed_pubmed long, failed_openalex long, start_time string, end_time string")
    text = corpus.run_summary(run)
    assert "full text: -" in text and "seconds: 120" in text


def test_run_of_a_configuration(spark, tmp_path, capsys):
    rows = papers(spark, {"pmid": "1", "doi": "10.1/a", "title": "alpha"}, {"pmid": "2", "title": "beta"}, {"pmid": "3", "title": "alpha too", "is_full_text_pmc": True})
    rows.write.parquet(f"file://{tmp_path}/papers")
    spark.createDataFrame([("10.1/A", 7, 0.5, 1.0, "u")], "doi string, cited_by_count bigint, percentile double, fwci double, oa_url string").write.parquet(f"file://{tmp_path}/works")
    (tmp_path / "c.json").write_text(json.dumps({"queries": ["alpha[ti]", "beta[ti]"], "output_dir": f"file://{tmp_path}/out", "test_db": True, "queries_suffix": "NOT too", "use_suffix": True}))
    cli.main(["run", "--base", "unused", "--config", f"file://{tmp_path}/c.json", "--papers", f"file://{tmp_path}/papers", "--works", f"file://{tmp_path}/works", "--log", f"{tmp_path}/log"], spark)
    store = CorpusStore(spark, f"file://{tmp_path}/out/test_store")
    assert {r["pmid"]: r["cited_by_count"] for r in store.read("papers").collect()} == {"1": 7, "2": None}
    assert store.read("collection_runs").count() == 2 and "total processed: 1" in (tmp_path / "log").read_text()
    store.put_cache("q", ["1"], 5, "now")
    assert [r["query"] for r in store.cache_entries().collect()] == ["q"]
