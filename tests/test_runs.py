import random
import re

import pytest
from pyspark.sql import functions as F

from paperloom import shared
from paperloom.functions import sections
from paperloom.operators import corpus, fulltext, hits
from paperloom.operators.store import CorpusStore
from paperloom.sources import files, offline, remote
from paperloom.sources.querylang import doi_filter, predicate, preprint_query


def test_deeply_nested_documents():
    n = 100_000
    page = "<article>" + "<div>" * n + "<p>" + "long text " * 100 + "</p>" + "</div>" * n + "</article>"
    assert len(fulltext.parse_html(page)) > 900
    for frame in ("<article><body>%s</body></article>", "<article>%s</article>"):
        text, found, _, _ = fulltext.parse_jats(frame % ("<sec>" * n + "<p>the only words</p>" + "</sec>" * n))
        assert text.endswith("the only words") and [c for _, _, c in found] == ["the only words"]


def test_unclosed_and_stray_tags():
    long = "A sentence that is certainly long enough to stay in it. " * 12
    assert fulltext.parse_html(f"<article><div></b></i><p>{long}<p>{long}</article>").count("A sentence") == 24
    assert fulltext.parse_html("") is None and fulltext.parse_html(None) is None and fulltext.parse_jats("") == (None, [], False, None)


def test_extras_of_articles(spark):
    xml = """<article article-type="review" xmlns:xlink="http://www.w3.org/1999/xlink"><body><p>Words.</p><ext-link xlink:href="http://a.example">a</ext-link>
    <table-wrap><label>T1</label><caption><p>Two by two</p></caption><table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table></table-wrap>
    <fig><label>F1</label><caption><p>A curve</p></caption></fig></body><back><ref-list><ref><label>1</label><mixed-citation>Doe 2001</mixed-citation></ref></ref-list></back></article>"""
    df = spark.createDataFrame([(1, xml), (2, "none"), (3, None)], "id int, xml string")
    rows = fulltext.article_extras(df).orderBy("id").collect()
    assert rows[0]["tables"][0]["content"] == "a | b\n1 | 2" and rows[0]["figures"][0]["caption"] == "A curve" and rows[0]["references"][0]["content"] == "Doe 2001"
    assert rows[0]["article_type"] == "review" and rows[0]["links"] == ["http://a.example"] and rows[1]["tables"] == [] and rows[2]["article_type"] is None
    text = fulltext.parse_jats(xml, ("tables", "figures", "references"))[0]
    assert "## TABLES\n\n**Table 1:** Two by two\na | b" in text and "**Figure 1:** A curve" in text and text.endswith("## REFERENCES\n\n[1] Doe 2001")
    assert "TABLES" not in fulltext.parse_jats(xml)[0]


def fold(text):
    """Sections line by line."""
    out, name, lines = {}, "Main", []

    def put():
        if lines:
            out[name] = "\n".join(lines).strip()

    for line in text.split("\n"):
        if line.startswith("## "):
            put()
            name, lines = re.sub("^#+", "", line).strip(), []
        else:
            lines.append(line)
    put()
    return list(out.items())


def test_sections_of_flat_text_by_folding(spark):
    rng = random.Random(3)
    parts = ["## A", "## B", "## ", "##C", "text", "", " ", "### D", "more text", "## A\n"]
    texts = ["\n".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(300)] + ["", "\n", "## A", "## A\n", "\n## A\nx"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", sections.from_flat(F.col("t")).alias("s")).collect()
    for r in rows:
        assert [(s["name"], s["content"]) for s in r["s"]] == fold(texts[r["i"]]), texts[r["i"]]
        assert [s["pos"] for s in r["s"]] == list(range(len(r["s"])))


def paper(spark, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], "pmid string, title string, collection_date string")


def test_store_keeps_the_last_row_of_a_batch_and_other_buckets(spark, tmp_path):
    store = CorpusStore(spark, f"file://{tmp_path}/s", buckets=4)
    store.upsert("papers", paper(spark, *((str(i), "a", "2024") for i in range(40))))
    first = store.manifest("papers", 1)
    store.upsert("papers", paper(spark, ("7", "late", "2026"), ("7", "early", "2025"), (None, "none", "2026")).repartition(2))
    second = store.manifest("papers", 2)
    assert set(first) == set(second) and sum(first[k] != second[k] for k in first) == 1
    assert {r["pmid"]: r["title"] for r in store.read("papers").collect()} == {**{str(i): "a" for i in range(40)}, "7": "late"}
    store.delete("papers", spark.createDataFrame([("3",), (None,), ("no",)], "pmid string"))
    assert store.read("papers").count() == 39 and store.read("papers", 1).count() == 40


def test_two_writers_of_one_snapshot(spark, tmp_path):
    store = CorpusStore(spark, f"file://{tmp_path}/s")
    store.upsert("papers", paper(spark, ("1", "a", "2024")))
    with pytest.raises(RuntimeError):
        store._commit("papers", 1, {})
    assert store.version("papers") == 1 and store.read("papers").first()["title"] == "a"
    assert [p.name for p in (tmp_path / "s/papers/commits").iterdir() if not p.name.endswith(".crc")] == ["1"]


def test_numbers_follow_the_order(spark):
    rng = random.Random(1)
    keys = sorted({f"{rng.randrange(10**9):09d}" for _ in range(3_000)})
    df = spark.createDataFrame([(k,) for k in rng.sample(keys, len(keys))], "k string").repartition(7)
    rows = {r["k"]: r["number"] for r in corpus.numbered(df, "k").collect()}
    assert rows == {k: i for i, k in enumerate(keys)} and corpus.numbered(df.limit(0), "k").count() == 0


def test_arrays_of_no_rows_and_of_many_tasks(spark, tmp_path):
    import json

    for n in (0, 1, 500):
        files.write_array(spark.range(n).repartition(5), f"file://{tmp_path}/{n}")
        text = "".join(p.read_text() for p in sorted((tmp_path / str(n)).glob("part-*")))
        assert sorted(x["id"] for x in json.loads(text)) == list(range(n))


def test_shared_folder(spark):
    assert shared.root(spark) and shared.folder(spark, "x") != shared.folder(spark, "x")

    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("S", (), {"master": "spark://somewhere", "getConf": staticmethod(lambda: type("G", (), {"get": staticmethod(lambda *_: None)}))})

    with pytest.raises(ValueError):
        shared.root(Cluster)


def words_of(t):
    return frozenset(re.sub(r"[^\w]+|_", " ", t.lower()).split())


def test_titles_by_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    works = [(f"d{i:03d}", " ".join(rng.sample(vocabulary, rng.randrange(3, 12)))) for i in range(150)]
    titles = []
    for _, t in rng.sample(works, 60):
        w = t.upper().split()
        if rng.random() < 0.7:
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        titles.append(": ".join([" ".join(w[:2]), " ".join(w[2:])]))
    titles += ["", "nothing like it"]
    got = {r["title"]: (r["doi"], r["score"]) for r in hits.dois_of_titles(spark.createDataFrame([(t,) for t in titles], "title string"), spark.createDataFrame(works, "doi string, title string"), 0.6, 5).collect()}
    for t in titles:
        a = words_of(t)
        scored = [(1.0 if t.lower().replace(":", "") == v else len(a & words_of(v)) / len(a | words_of(v)), d) for d, v in works if a]
        best = max((s for s, _ in scored), default=0)
        want = min(d for s, d in scored if s == best) if best >= 0.6 else None
        assert got[t][0] == want and (want is None or abs(got[t][1] - best) < 1e-12), t


def test_preprint_text_and_filters(spark):
    p = spark.createDataFrame([("10.1101/av2", "medRxiv (preprint)", None), ("10.1101/b", "x", "u"), ("10.1101/c", None, "")], "doi string, journal string, pdf_url string")
    pdfs = spark.createDataFrame([("https://www.medrxiv.org/content/10.1101/a.full.pdf", ["one", "", "two"]), ("u", [""]), ("https://www.biorxiv.org/content/10.1101/b.full.pdf", ["other"])], "url string, pages array<string>")
    rows = {r["doi"]: r for r in hits.preprint_full_text(p, pdfs).collect()}
    assert rows["10.1101/av2"]["full_text"] == "one\ntwo" and rows["10.1101/av2"]["sections"][0]["name"] == "main"
    assert rows["10.1101/b"]["full_text_url"].endswith("b.full.pdf") and rows["10.1101/c"]["full_text"] is None
    assert preprint_query("a OR b", "MedRxiv") == "(a OR b) AND (SRC:MED)" and doi_filter("doi:A| https://doi.org/b |") == ["a", "b"]
    with pytest.raises(ValueError):
        doi_filter("title:x")
    df = spark.createDataFrame([("1", "a"), ("2", "B"), ("3", None)], "pmid string, doi string")
    assert sorted(r["pmid"] for r in df.filter(predicate("doi:a|b")).collect()) == ["1", "2"]


class Flaky:
    def __init__(self, failures):
        self.failures, self.rotated, self.calls = failures, 0, 0

    def rotate(self):
        self.rotated += 1

    def ask(self):
        self.calls += 1
        if self.calls <= self.failures:
            raise ConnectionError
        return self.calls


def test_pacing_retries_rotation_and_budget():
    slept = []
    calls = remote.Pacer(Flaky(2), 10, sleep=slept.append)
    assert calls.call("ask") == 3 and calls.client.rotated == 2 and len(slept) == 5 and abs(slept[0] - 0.1) < 0.01
    with pytest.raises(ConnectionError):
        remote.Pacer(Flaky(9), 10, sleep=slept.append).call("ask")
    spent = remote.Pacer(Flaky(0), 10, budget=2, sleep=slept.append)
    assert [spent.call("ask"), spent.call("ask")] == [1, 2]
    with pytest.raises(remote.BudgetSpent):
        spent.call("ask")


def test_cursor_and_works_sources(spark):
    remote.register(spark)
    options = {"client": "paperloom.sources.offline:Numbers", "requests_per_second": "100000"}
    ids = spark.read.format("corpus_cursor").options(query="small\nnothing", max_results="950", **options).load()
    assert sorted(int(r["id"].split("-")[1]) for r in ids.collect()) == list(range(950))
    works = spark.read.format("corpus_works").options(dois="d1|d2|d17|d18", batch="2", **options).load()
    assert sorted(r["doi"] for r in works.collect()) == ["d1", "d18", "d2"]
    assert offline.Numbers().count("small") == 9_000


def test_tee_log_and_folders(tmp_path):
    log = files.tee_log("paperloom-test", str(tmp_path / "run.log"))
    assert files.tee_log("paperloom-test", "elsewhere") is log
    log.info("a line")
    assert (tmp_path / "run.log").read_text().endswith("a line\n") and files.output_folders("/b")["store"] == "/b/store"


class Crowded:
    """30,000 ids in one month, 1,500 of them on most of its days."""

    def count(self, query):
        depth = query.count("/")
        if "[pdat]" not in query:
            return 30_000
        if "2024" not in query or ("/" in query and "2024/03" not in query):
            return 0
        return 30_000 if depth < 2 else 1_500 if int(query.rpartition("/")[2][:2]) <= 20 else 0


def test_crowded_months_go_by_day():
    pages = remote.split(Crowded(), "q", 50_000, 2024)
    assert sum(p.size for p in pages) == 30_000 and all(p.start + p.size <= remote.CAP for p in pages) and pages[0].query.endswith("2024/03/01[pdat]")
    assert sum(p.size for p in remote.split(Crowded(), "q", 4_000, 2024)) == 4_000


class OneDay:
    """50,000 ids on one day, told apart by a digit that their titles begin with; some of other years, some without a date."""

    def __init__(self, lost=0):
        self.lost = lost
        self.ids = [("2024/03/05", str(k % 30), k) for k in range(50_000)] + [("2024/04", "x", k) for k in range(50_000, 50_300)] + [("1901/01/01", "x", 60_000), ("", "x", 60_001), ("2023", "y", 60_002)]

    def found(self, query):
        out = self.ids
        for joint, stamp, word_joint, word in re.findall(r"(AND|NOT) ([\d/:]+)\[pdat\]|(AND|NOT) (\w+)\*\[ti\]", query):
            if word:
                out = [r for r in out if (r[1] == word) == (word_joint == "AND")]
                continue
            low, _, high = stamp.partition(":")
            inside = (lambda d: low <= d and d[: len(high)] <= high and len(d) >= len(high)) if high else (lambda d: d.startswith(low))  # noqa: B023
            out = [r for r in out if inside(r[0]) == (joint == "AND")]
        return out

    def count(self, query):
        return len(self.found(query)) + (self.lost if "[pdat]" not in query else 0)


def test_a_day_over_the_cap_goes_by_a_second_field_and_nothing_is_lost():
    client = OneDay()
    facets = ";".join(f"{k}*[ti]" for k in range(29))
    pages = remote.split(client, "q", 10**6, 2024, facets=facets)
    got = [r[2] for p in pages for r in client.found(p.query)[p.start : p.start + p.size]]
    assert sorted(got) == sorted(r[2] for r in client.ids)
    assert all(p.start + p.size <= remote.CAP for p in pages)


def test_what_cannot_be_reconciled_or_split_raises():
    with pytest.raises(remote.Unreconciled, match="in its parts"):
        remote.split(OneDay(lost=5), "q", 10**6, 2024, facets=";".join(f"{k}*[ti]" for k in range(30)))
    with pytest.raises(remote.Unreconciled, match="over the cap"):
        remote.split(OneDay(), "q", 10**6, 2024, facets="1*[ti]")


def test_all_tasks_together_keep_to_rate_and_budget():
    for n, rate in ((1, 8.0), (3, 8.0), (16, 5.0)):
        stamps, shares = [], []
        for part in remote.dealt(list(range(n)), n, origin=100.0):
            now = [100.0 + 0.37 * part.slot]  # tasks start at different times
            options = {"client": "tests.test_runs:OneDay", "daily_budget": "10", "requests_per_second": str(rate)}
            calls = remote.pacer(options, part)
            shares.append(calls.budget)
            calls.clock, calls.sleep = lambda now=now: now[0], lambda s, now=now: now.__setitem__(0, now[0] + s)
            for _ in range(12):
                calls.wait()
                stamps.append(now[0])
                now[0] += 0.01
        assert sum(shares) == 10
        stamps.sort()
        assert all(b - a > 1 / rate - 1e-6 for a, b in zip(stamps, stamps[1:]))


def updates_table(spark, path, upto):
    rows = [(f"p{k:03d}", "t", f"2024-01-{k % 28 + 1:02d}") for k in range(200) if k % 28 + 1 <= upto]
    spark.createDataFrame(rows, "pmid string, title string, date_published string").write.mode("overwrite").parquet(path)
    return {r[0] for r in rows}


def test_a_stream_that_is_stopped_and_started_again_gives_each_id_once(spark, tmp_path):
    remote.register(spark)
    table, sink, marks = (f"file://{tmp_path}/{x}" for x in ("papers", "sink", "marks"))

    def run():
        options = {"client": "paperloom.sources.offline:Papers", "papers": table, "query": "q", "after": "2024/01/03", "requests_per_second": "100000", "cap": "40", "last_year": "2024", "first_year": "2024"}
        rows = spark.readStream.format("corpus_updates").options(**options).load()
        rows.writeStream.format("parquet").option("checkpointLocation", marks).option("path", sink).trigger(availableNow=True).start().awaitTermination(120)
        return sorted(r["pmid"] for r in spark.read.schema("pmid string").parquet(sink).collect())

    early = {f"p{k:03d}" for k in range(200) if k % 28 + 1 <= 3}
    assert run.__name__ and sorted(updates_table(spark, table, 10) - early) == run()
    assert run() == sorted(updates_table(spark, table, 10) - early)
    assert sorted(updates_table(spark, table, 28) - early) == run()


def test_a_client_over_a_table_holds_no_rows(tmp_path):
    """Counts and pages over several files are those of a loop over all rows, and a client's memory is a batch's."""
    import re
    import tracemalloc

    import pyarrow as pa
    import pyarrow.parquet as pq

    dates = (None, "2024", "2023-03", "2024-03-05", "2024-03-06", "2022-12-31")
    rows = [(f"p{k}", None if k % 9 == 0 else f"Ünder{k % 4} {'the' if k % 2 else 'éthe a_the'} x{k}" + " word" * 20, dates[k % 6]) for k in range(60_000)]
    for k in range(3):
        part = pa.table(dict(zip(("pmid", "title", "date_published"), map(list, zip(*rows[k::3])))))
        pq.write_table(part, tmp_path / f"part-{k}.parquet", row_group_size=5_000)
    tracemalloc.start()
    client = offline.Papers(f"file://{tmp_path}")
    word = lambda title, w: re.search(rf"(^|[^\w]){w}", (title or "").lower()) is not None
    day = lambda d: (d or "").startswith("2024-03-05")
    cases = {
        "q": lambda t, d: True,
        "(q) AND 2024[pdat]": lambda t, d: (d or "").startswith("2024"),
        "(q) NOT 2023:2024[pdat]": lambda t, d: not "2023" <= (d or "") <= "2024~",
        "((q) AND 2024[pdat]) NOT 2024/01:2024/12[pdat]": lambda t, d: d == "2024",
        "(((q) AND 2024/03/05[pdat]) NOT t*[ti]) AND x1*[ti]": lambda t, d: day(d) and not word(t, "t") and word(t, "x1"),
        "((q) AND 2024/03/05[pdat]) NOT ü*[ti]": lambda t, d: day(d) and not word(t, "ü"),
    }
    counts = {q: client.count(q) for q in cases}
    assert client.latest() == "2024/03/06"
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 << 20
    for query, holds in cases.items():
        wanted = sorted(p for p, t, d in rows if holds(t, d))
        size = max(1, len(wanted) // 3)
        pages = [client.page(query, s, size) for s in range(0, len(wanted), size)]
        assert counts[query] == len(wanted) and sorted(x for page in pages for x in page) == wanted, query


def test_pages_are_parsed_a_few_at_a_time(spark):
    import pyarrow as pa

    text = "A sentence that is certainly long enough to stay in it. " * 12
    html = [None if k % 50 == 0 else f"<article><p>{k} {text}</p></article>" if k % 3 else "<p>short</p>" for k in range(1_000)]
    parts = list(fulltext.page_texts(iter([pa.array(html, pa.string()), pa.array([], pa.string())])))
    assert max(map(len, parts)) <= fulltext.PAGES < 100 and [x for p in parts for x in p.to_pylist()] == [fulltext.parse_html(x) for x in html]
    df = spark.createDataFrame(list(enumerate(html)), "id int, html string").coalesce(1)
    got = {r["id"]: r["page_text"] for r in fulltext.pages(df).collect()}
    assert len(got) == 1_000 and all((got[k] or "").startswith(f"{k} A sentence") == bool(k % 3 and k % 50) for k in got)


def test_upserts_and_deletes_move_rows_once(spark, tmp_path):
    """Batches with repeated and null keys against a dictionary; whole rows pass one exchange, and none is joined."""
    rng = random.Random(8)
    store, held = CorpusStore(spark, f"file://{tmp_path}/s", buckets=3), {}
    for turn in range(3):
        rows = [(rng.choice([None, *(str(k) for k in range(40))]), f"t{turn}-{k}", f"20{k:02d}") for k in range(30)]
        store.upsert("papers", paper(spark, *rows).repartition(3))
        held |= {k: t for k, t, _ in rows if k is not None}
        gone = [str(rng.randrange(60)) for _ in range(5)]
        store.delete("papers", spark.createDataFrame([(k,) for k in [*gone, *gone, None]], "pmid string"))
        held = {k: t for k, t in held.items() if k not in gone}
        assert sorted((r["pmid"], r["title"]) for r in store.read("papers").collect()) == sorted(held.items())
    old = store.read("papers")
    for before in (None, old):
        plan = store._last("papers", old, before, 3)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Join" not in plan


def test_a_run_to_files_finds_its_papers_once(spark, tmp_path):
    from paperloom.plans import collect

    kind = "pmid string, doi string, cited_by_count bigint, citation_normalized_percentile double, fwci double, oa_url string, openalex_retrieved boolean, is_full_text_pmc boolean"
    found = spark.createDataFrame([(str(k % 6), f"10.1/{k % 6}", 0, None, None, None, None, k % 2 == 0) for k in range(12)], kind)
    works = spark.createDataFrame([("10.1/3", 9, None, None, None)], "doi string, cited_by_count bigint, percentile double, fwci double, oa_url string")
    rows = collect.collect_to_files(found, works, f"file://{tmp_path}/run", "aging", seen=found.filter("pmid = '0'").select("pmid"))
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    got = spark.read.schema("pmid string, cited_by_count bigint").json(f"file://{tmp_path}/run/papers_all").collect()
    assert sorted((r[0], r[1]) for r in got) == [("1", 0), ("2", 0), ("3", 9), ("4", 0), ("5", 0)]


def test_rows_that_no_batch_replaces_do_not_move(spark, tmp_path, monkeypatch):
    """Old rows pass an exchange where their slot is hit; keys that share a slot with a new one stay, too."""
    from paperloom.operators import store as module

    for slots in (1 << 25, 40):
        monkeypatch.setattr(module, "SLOTS", slots)
        store = CorpusStore(spark, f"file://{tmp_path}/s{slots}", buckets=3)
        store.upsert("papers", paper(spark, *((str(k), f"old {k}", "2024") for k in range(200))))
        new = paper(spark, *((str(k), f"new {k}", "2023") for k in range(190, 210)))
        old, hit = store.read("papers"), store._hit(new, "pmid")
        stay, moved = (store._met(old, hit, "pmid", met) for met in (False, True))
        plan = stay._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(pmid" not in plan and "hashpartitioning(_bucket" not in plan
        assert stay.count() + moved.count() == 200 and moved.filter("cast(pmid as int) >= 190").count() == 10
        assert moved.count() == 10 if slots > 40 else 10 < moved.count() < 200
        store.upsert("papers", new)
        store.delete("papers", spark.createDataFrame([("0",), ("205",)], "pmid string"))
        wanted = {str(k): f"{'new' if k >= 190 else 'old'} {k}" for k in range(210) if k not in (0, 205)}
        got = store.read("papers").select("pmid", "title").collect()
        assert len(got) == len(wanted) and dict(map(tuple, got)) == wanted
    files_ = list(tmp_path.glob("s40/papers/data-*/*/*.parquet"))
    assert files_ and all(".zstd." in f.name for f in files_)


def test_rows_that_a_batch_replaces_or_deletes_do_not_move(spark, tmp_path, monkeypatch):
    """Of an upsert only the batch passes an exchange, whole, of a delete nothing but keys."""
    import time

    from paperloom.operators import store as module

    def moved():
        time.sleep(1)
        return spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()

    rng = random.Random(4)
    text = lambda: "".join(chr(rng.randrange(33, 127)) for _ in range(20_000))
    for slots in (1 << 25, 40):
        monkeypatch.setattr(module, "SLOTS", slots)
        store = CorpusStore(spark, f"file://{tmp_path}/s{slots}", buckets=3)
        store.upsert("papers", paper(spark, *((str(k), text(), "2024") for k in range(60))))
        before = moved()
        store.upsert("papers", paper(spark, *((str(k), "new", "2023") for k in range(30)), ("7", "newest", "2024"), (None, "none", "2024")))
        store.upsert("papers", spark.createDataFrame([], "pmid string, title string"))
        store.delete("papers", spark.createDataFrame([(k,) for k in [*range(20, 50), 7_000, None]], "pmid long"))
        if slots > 40:
            assert moved() - before < 100_000
        wanted = {str(k): "newest" if k == 7 else "new" if k < 20 else None for k in range(60) if not 20 <= k < 50}
        got = store.read("papers").select("pmid", "title").collect()
        assert len(got) == len(wanted) and {r[0]: r[1] if len(r[1]) < 10 else None for r in got} == wanted
        assert store.read("papers", 1).count() == 60 and store.read("papers", 2).count() == 60 and store.versions("papers") == [1, 2, 3, 4]
