import random

import pytest
from pyspark.sql import functions as F

from paperloom.operators import corpus, dedup, fulltext, hits, matching, pubmed
from paperloom.operators.store import CorpusStore
from paperloom.plans import collect as C
from paperloom.sources import files, remote
from paperloom.sources.querylang import any_of, parse, predicate, with_suffix
from paperloom.streaming import upserts

PAPER = "pmid string, doi string, title string, abstract string, full_text string, is_full_text_pmc boolean, collection_date string, authors array<string>, mesh_terms array<string>, cited_by_count bigint, year string, date_published string, source string, openalex_retrieved boolean"


def papers(spark, *rows):
    base = dict.fromkeys(("pmid", "doi", "title", "abstract", "full_text", "is_full_text_pmc", "collection_date", "authors", "mesh_terms", "cited_by_count", "year", "date_published", "source", "openalex_retrieved"))
    return spark.createDataFrame([tuple((base | r).values()) for r in rows], PAPER)


def ids(df):
    return sorted(r["pmid"] for r in df.collect())


def test_dedup_order_and_strategies(spark):
    df = papers(
        spark, {"pmid": "9", "doi": "d", "collection_date": "2024", "is_full_text_pmc": True}, {"pmid": "10", "doi": "d", "collection_date": "2024", "is_full_text_pmc": False, "mesh_terms": []},
        {"pmid": "11", "doi": "d", "collection_date": None, "title": "t", "cited_by_count": 4, "mesh_terms": ["m"]}, {"pmid": "1", "doi": ""}, {"pmid": "2", "doi": None},
    )
    assert ids(dedup.keep_one(df)) == ["1", "10", "2"] and ids(dedup.keep_one(df, True)) == ["1", "2", "9"]
    merged = {r["pmid"]: r for r in dedup.merge_groups(df).collect()}
    assert set(merged) == {"1", "10", "2"}
    m = merged["10"]
    assert (m["title"], m["cited_by_count"], m["is_full_text_pmc"], m["mesh_terms"]) == ("t", 4, True, [])
    assert ids(dedup.keep_one(dedup.keep_one(df))) == ids(dedup.keep_one(df))
    r = dedup.report(df).first()
    assert (r["total_papers"], r["with_doi"], r["without_doi"], r["duplicate_groups"], r["duplicate_rows"]) == (5, 3, 2, 1, 3)


def test_classify_and_needs(spark):
    store = papers(spark, {"pmid": "1", "doi": "a", "abstract": "  ", "full_text": "t"}, {"pmid": "2", "doi": "b", "abstract": "x", "full_text": "t"})
    cand = spark.createDataFrame([("1",), ("a",), ("2",), ("b",), ("zz",), ("",)], "id string")
    got = {r["id"]: r["action"] for r in corpus.classify(cand, store).collect()}
    assert got == {"1": "enrich", "a": "enrich", "2": "skip", "b": "skip", "zz": "new", "": "new"}
    assert {r["action"] for r in corpus.classify(cand, store, True).collect()} == {"skip", "new"}


def test_enrich_overwrites_metrics_but_not_addresses(spark):
    df = papers(spark, {"pmid": "1", "doi": "10.1/A", "cited_by_count": 3}, {"pmid": "2", "doi": None, "cited_by_count": 5}).withColumns({"fwci": F.lit(1.5), "citation_normalized_percentile": F.lit(0.5), "oa_url": F.lit("old")})
    works = spark.createDataFrame([("https://doi.org/10.1/a", 9, None, None, None)], "doi string, cited_by_count bigint, percentile double, fwci double, oa_url string")
    rows = {r["pmid"]: r for r in corpus.enrich(df, works).collect()}
    assert (rows["1"]["cited_by_count"], rows["1"]["fwci"], rows["1"]["oa_url"], rows["1"]["openalex_retrieved"]) == (9, None, "old", True)
    assert (rows["2"]["cited_by_count"], rows["2"]["fwci"], rows["2"]["openalex_retrieved"]) == (5, 1.5, False)


def test_merge_stores(spark):
    target = papers(spark, {"pmid": "1", "doi": "d1", "title": "short", "authors": ["a"], "collection_date": "old"}, {"pmid": "2", "doi": None})
    source = papers(spark, {"pmid": "7", "doi": "d1", "title": "a longer title", "authors": ["a", "b"], "collection_date": "new"}, {"pmid": "2", "abstract": "x"}, {"pmid": "8", "doi": "d9"}, {"pmid": "9", "doi": "d9", "abstract": "late"})
    rows = {r["pmid"]: r for r in corpus.merge_stores(source, target).collect()}
    assert set(rows) == {"1", "2", "8"}
    assert (rows["1"]["title"], rows["1"]["authors"], rows["1"]["collection_date"], rows["1"]["action"]) == ("a longer title", ["a", "b"], "old", "merged")
    assert rows["2"]["abstract"] == "x" and rows["8"]["abstract"] == "late" and rows["8"]["action"] == "added"


def merged_one_by_one(source, target):
    """A merge of (pmid, doi, title, authors, cited_by_count, flag) rows, one after another, into a store of such rows."""
    store = {r[0]: [*r[:3], list(r[3]), *r[4:]] for r in target}
    actions = dict.fromkeys(store, "kept")
    first = lambda x, y: x if x else y if y else None
    for pmid, doi, title, authors, cited, flag in source:
        pmid = pmid or doi
        if not pmid:
            continue
        # Of several rows with a DOI: the store's own first, by pmid.
        by_doi = sorted((actions[k] == "added", k) for k, r in store.items() if doi and r[1] == doi)
        hit = by_doi[0][1] if by_doi else pmid if pmid in store else None
        if hit is None:
            store[pmid], actions[pmid] = [pmid, doi, title, list(authors), cited, flag], "added"
            continue
        r = store[hit]
        actions[hit] = "merged" if actions[hit] == "kept" else actions[hit]
        longest = title if title and (not r[2] or len(title) > len(r[2])) else r[2] or None
        store[hit] = [hit, first(r[1], doi), longest, r[3] + [a for a in authors if a not in r[3]], first(r[4], cited), bool(r[5] or flag)]
    return {(r[0], r[1], r[2], tuple(r[3]), r[4], r[5], actions[k]) for k, r in store.items()}


@pytest.mark.parametrize("seed", range(6))
def test_merging_random_key_graphs_equals_a_sequential_merge(spark, seed):
    rng = random.Random(seed)
    kind = "pmid string, doi string, title string, authors array<string>, cited_by_count long, is_full_text_pmc boolean"
    n, m = ((40, 12), (60, 60), (30, 200))[seed % 3]
    own = lambda pmid, dois: (pmid, rng.choice(dois), rng.choice([None, "", "ab", "abc", "xyz", "longer"]), rng.choices("abc", k=rng.randrange(4)), rng.choice([None, 0, 3, 5]), rng.choice([None, True, False]))
    dois = [None, "", *(f"d{k}" for k in range(m))]
    target = [own(f"p{k}", [None, "", f"d{k % m}", f"d{(k + 1) % m}"]) for k in range(0, n, 2)]
    source = [own(rng.choice([None, "", *(f"p{j}" for j in range(n))]), dois) for _ in range(3 * n)]
    rows = spark.createDataFrame([(*r, k) for k, r in enumerate(source)], f"{kind}, at int").repartition(3)
    got = corpus.merge_stores(rows, spark.createDataFrame(target, kind), order_by=("at",))
    assert {(r[0], r[1], r[2], tuple(r[3]), *r[4:]) for r in got.collect()} == merged_one_by_one(source, target)


def test_merging_leaves_no_two_rows_of_a_doi(spark):
    target = papers(spark, {"pmid": "b", "doi": None})
    for order, want in ((("pmid",), {("b", None), ("a", "d")}), (("title",), {("b", "d")})):
        source = papers(spark, {"pmid": "b", "doi": "d", "title": "1"}, {"pmid": "a", "doi": "d", "title": "2"})
        got = corpus.merge_stores(source, target, order_by=order)
        assert {(r["pmid"], r["doi"]) for r in got.collect()} == want


def test_a_chain_of_keys_in_its_order(spark):
    """Each link waits for the one before: the longest way of rounds."""
    pairs = [(f"p{(k + 1) // 2}", f"d{k // 2}", k) for k in range(14)]
    got = matching.taken(spark, spark.createDataFrame(pairs, "pmid string, doi string, seq int"))
    assert {(r["doi"], r["pmid"]) for r in got.collect()} == {(f"d{k}", f"p{k}") for k in range(7)}


def test_batches_and_guard(spark):
    df = spark.createDataFrame([(f"{i:04d}",) for i in range(95)], "pmid string")
    rows = sorted((r["pmid"], r["batch"]) for r in corpus.batches(df.repartition(5), 30).collect())
    assert rows == [(f"{i:04d}", i // 30) for i in range(95)]
    with pytest.raises(ValueError):
        corpus.guard(df, 95)
    assert corpus.guard(df, 96).count() == 95


def test_hits(spark):
    kind = "pmid string, pmcid string, doi string, title string, abstract string, authors string, journal string, year string, date string, source string, cited_by_count bigint"
    df = spark.createDataFrame([(None, None, "d", "t", "a", "X, Y; ", "Cell", None, "2021-05-01", "MED", None), (None, None, None, "t", "", "", "J", "2020", None, "PMC", 2)], kind)
    r = hits.from_europepmc(df).collect()
    assert len(r) == 1 and (r[0]["pmid"], r[0]["journal"], r[0]["year"], r[0]["authors"], r[0]["cited_by_count"]) == ("d", "Cell (preprint)", "2021", ["X, Y"], 0)
    p = spark.createDataFrame([("", "d", "t", "a", "A", None, "2019-01-02", "PPR"), ("1", "", "t", "a", "A", "2019", None, "x")], "pmid string, doi string, title string, abstract string, authors string, date string, first_date string, server string")
    r = hits.from_preprints(p).collect()
    assert len(r) == 1 and (r[0]["pmid"], r[0]["year"], r[0]["journal"], r[0]["source"]) == ("d", "2019", "PPR (preprint)", "PubMed")
    urls = spark.range(1).select(hits.pdf_url(F.lit("10.1/xv2"), F.lit("biorxiv")), hits.pdf_url(F.lit("10.1/xv2"), F.lit("biorxiv"), True), hits.pages_text(F.array(F.lit("a"), F.lit(""), F.lit("b")))).first()
    assert tuple(urls) == ("https://www.biorxiv.org/content/10.1/xv2.full.pdf", "https://www.biorxiv.org/content/10.1/x.full.pdf", "a\n\nb")


ARTICLE = """<PubmedArticle><MedlineCitation><PMID Version="1">77</PMID><Article><Journal><Title>J</Title><JournalIssue><PubDate><Year>2013</Year><Month>Mar</Month></PubDate></JournalIssue></Journal>
<ArticleTitle>T</ArticleTitle><Abstract><AbstractText Label="AIM">one</AbstractText><AbstractText>two  three</AbstractText></Abstract>
<AuthorList><Author><LastName>Doe</LastName><Initials>J</Initials></Author><Author><CollectiveName>Group</CollectiveName></Author><Author><Initials>X</Initials></Author></AuthorList></Article>
<MeshHeadingList><MeshHeading><DescriptorName UI="D1">Aging</DescriptorName></MeshHeading></MeshHeadingList><KeywordList><Keyword MajorTopicYN="N">k1</Keyword></KeywordList><KeywordList><Keyword>k2</Keyword></KeywordList></MedlineCitation>
<PubmedData><ArticleIdList><ArticleId IdType="pubmed">77</ArticleId><ArticleId IdType="pmc">PMC5</ArticleId><ArticleId IdType="doi"> 10.1/x </ArticleId></ArticleIdList></PubmedData></PubmedArticle>"""
BOOK = """<PubmedBookArticle><BookDocument><PMID>88</PMID><ArticleIdList><ArticleId IdType="bookaccession">NBK1</ArticleId></ArticleIdList><Book><BookTitle book="b">Big Book</BookTitle></Book><ArticleTitle book="b">Chapter</ArticleTitle>
<AuthorList><Author><LastName>Roe</LastName></Author></AuthorList><Abstract><AbstractText>text</AbstractText></Abstract></BookDocument><PubmedBookData><History><PubMedPubDate PubStatus="x"><Year>2001</Year></PubMedPubDate></History><ArticleIdList><ArticleId IdType="pubmed">88</ArticleId></ArticleIdList></PubmedBookData></PubmedBookArticle>"""


def test_pubmed_xml(spark):
    rows = {r["pmid"]: r for r in pubmed.papers(spark.createDataFrame([(ARTICLE,), (BOOK,), ("<Other/>",)], "xml string")).collect()}
    assert set(rows) == {"77", "88"}
    a, b = rows["77"], rows["88"]
    assert (a["doi"], a["pmcid"], a["is_full_text_pmc"], a["abstract"], a["mesh_terms"], a["keywords"], a["authors"]) == ("10.1/x", "PMC5", True, "AIM: one two three", ["Aging"], ["k1"], ["Doe J", "Group"])
    assert (a["date_published"], a["year"], a["journal"], a["title"]) == ("2013-03-01", "2013", "J", "T")
    assert (b["title"], b["journal"], b["year"], b["authors"], b["doi"]) == ("Chapter", "Big Book", "2001", ["Roe"], None)


JATS = """<article><front><abstract><p>Short abstract.</p></abstract></front><body><p>Loose words.</p><sec><title>Methods</title><p>How it was done.</p><sec><title>Sub</title><p>Detail.</p></sec></sec><sec><p>No title here.</p></sec></body></article>"""


def test_jats_sections(spark):
    r = fulltext.jats(spark.createDataFrame([(1, JATS), (2, "no xml"), (3, None)], "id int, xml string")).orderBy("id").collect()
    assert [(s["name"], s["content"]) for s in r[0]["sections"]] == [("Main", "Loose words."), ("Methods/Sub", "Detail."), ("Methods", "How it was done."), ("Section 1", "No title here.")]
    assert r[0]["full_text"].startswith("Loose words.\n\n# Methods\n\nHow it was done.\n\n## Sub") and r[0]["abstract"] == "Short abstract." and r[0]["has_body"]
    assert r[1]["full_text"] is None and r[2]["sections"] == []


def test_html_pages(spark):
    long = "A sentence that is certainly long enough to stay. " * 6
    page = f"<html><body><nav><p>{long}</p></nav><article><div><h2>Methods</h2><p>{long}</p><p>short</p></div><section><p>{long}</p><script>var x = '</p>';</script></section></article></body></html>"
    plain = f"<article><p>{long}</p><p>{long}</p></article>"
    rows = fulltext.pages(spark.createDataFrame([(1, page), (2, plain), (3, "<article><p>tiny</p></article>"), (4, None), (5, "<p>no article</p>")], "id int, html string")).orderBy("id").collect()
    assert rows[0]["page_text"].startswith("## Methods\nA sentence") and "short" not in rows[0]["page_text"]
    assert rows[1]["page_text"].count("A sentence") == 12 and [r["page_text"] for r in rows[2:]] == [None] * 3


def test_assembly_and_waterfall(spark):
    secs = [(0, "Introduction", "x" * 600)]
    kind = "t string, s array<struct<pos:int,name:string,content:string>>, b boolean, a string, p string"
    df = spark.createDataFrame([("Body text", secs, True, "Abs", None), ("Body", [], True, "Abs", "page"), ("Body", [], True, "", "page")], kind)
    got = [r[0] for r in df.select(fulltext.assemble(F.col("t"), F.col("s"), F.col("b"), F.col("a"), F.col("p"))).collect()]
    assert got[0]["full_text"] == "ABSTRACT:\nAbs\n\nBody text" and [s["name"] for s in got[0]["sections"]] == ["Abstract", "Introduction"]
    assert got[1]["full_text"] == "page" and got[2] is None
    p = spark.createDataFrame([("1", "PMC1", "d1"), ("2", "", "d1"), ("3", None, None)], "pmid string, pmcid string, doi string")
    w = fulltext.waterfall(p, spark.createDataFrame([("PMC1", "A")], "pmcid string, text string"), spark.createDataFrame([("d1", "B")], "doi string, text string"))
    assert {r["pmid"]: (r["full_text"], r["origin"]) for r in w.collect()} == {"1": ("A", "pmcid"), "2": ("B", "doi"), "3": (None, None)}


@pytest.mark.parametrize(
    ("query", "want"),
    [
        ("aging[tiab]", "12"), ("AGING[ti]", "1"), ("aging AND theory", "1"), ("aging OR cells", "123"), ("aging NOT theory", "2"), ("NOT aging", "34"), ("cells AND NOT theory", "3"), ("cells OR NOT aging", "34"),
        ('"theory of aging"', "1"), ("theor*", "1"), ("theor", ""), ("2020:2021[dp]", "12"), ("2021/05[pdat]", "2"), ("2021[dp]", "2"), ('"Mice"[MeSH Terms]', "2"), ("mice/genetics[MAJR]", "2"), ("doe j[au]", "3"),
        ("full text[sb]", "3"), ("SRC:PPR", "4"), ("PUB_YEAR:[2019 TO 2020]", "1"), ("10.1/x[DOI]", "1"), ("theory OR aging NOT mice[mh]", "1"), ("theory OR (aging NOT mice[mh])", "1"), ("cells doe*[au]", "3"), ("", "1234"),
    ],
)
def test_search_language(spark, query, want):
    df = papers(
        spark, {"pmid": "1", "title": "A theory of Aging", "abstract": "", "year": "2020", "doi": "10.1/X", "mesh_terms": [], "authors": []},
        {"pmid": "2", "title": "Mice", "abstract": "on aging.", "year": "2021", "date_published": "2021-05-03", "mesh_terms": ["Mice"], "authors": []},
        {"pmid": "3", "title": "Cells", "abstract": None, "mesh_terms": [], "authors": ["Doe J"], "is_full_text_pmc": True}, {"pmid": "4", "title": None, "source": "PPR", "mesh_terms": [], "authors": []},
    )
    query = query.replace("full text[sb]", '"full text"[sb]').replace("doe j[au]", '"doe j"[au]')
    assert "".join(ids(df.filter(predicate(query)))) == want


def test_search_language_details(spark):
    assert parse("a b") == ("AND", ("term", "a", "all"), ("term", "b", "all")) and parse("a OR b AND c")[0] == "AND"
    assert with_suffix("q", " AND x ") == "q AND x" and with_suffix("q", "") == "q"
    with pytest.raises(ValueError):
        parse("x[nofield]")
    df = papers(spark, {"pmid": "1", "title": "a"}, {"pmid": "2", "title": "b"}, {"pmid": "3", "title": "c"})
    assert ids(df.filter(any_of(["a[ti]", "b[ti]"]))) == ["1", "2"]


def test_store(spark, tmp_path):
    with CorpusStore(spark, f"file://{tmp_path}/s") as store:
        assert store.read("papers").count() == 0 and store.version("papers") == 0
        store.upsert("papers", papers(spark, {"pmid": "1", "title": "a", "mesh_terms": ["m"], "doi": "d"}, {"pmid": None, "title": "x"}))
        store.upsert("papers", papers(spark, {"pmid": "1", "title": "b", "mesh_terms": ["m"], "doi": "d"}, {"pmid": "2", "title": "c", "is_full_text_pmc": True}))
        assert sorted((r["pmid"], r["title"], r["source"]) for r in store.read("papers").collect()) == [("1", "b", "PubMed"), ("2", "c", "PubMed")]
        assert store.versions("papers") == [1, 2] and store.read("papers", 1).first()["title"] == "a"
        assert store.append("queries", spark.createDataFrame([("q", "", "now")], "query_text string, description string, created_date string")) == 1
        assert store.append("queries", spark.createDataFrame([("r", "", "now")], "query_text string, description string, created_date string")) == 2
        assert [r["id"] for r in store.queries().collect()] == [1, 2]
        assert store.paper("2").first()["title"] == "c" and ids(store.with_full_text()) == ["2"] and [r["doi"] for r in store.by_mesh("m").collect()] == ["d"]
        assert ids(store.exists(spark.createDataFrame([("1",), ("",), ("9",)], "pmid string"))) == ["1"]
        store.delete("papers", spark.createDataFrame([("1",)], "pmid string"))
        assert ids(store.read("papers")) == ["2"] and store.statistics().first()["total_papers"] == 1
        store.restore("papers", 2)
        assert ids(store.read("papers")) == ["1", "2"]
        store.put_cache(" my  query ", ["5", "6"], 2, "now")
        assert ids(store.cached("my query", 1)) == ["5"] and store.cached("my query", 3) is None and store.cached("other", 1) is None
        info = store.cache_info().first()
        assert (info["entries"], info["ids"]) == (1, 2) and info["bytes"] > 0 and abs(info["kb"] - info["bytes"] / 1024) < 0.01
        store.clear_cache()
        assert store.cache_info().first()["entries"] == 0


def test_collect(spark, tmp_path):
    store = CorpusStore(spark, f"file://{tmp_path}/s")
    found = papers(spark, {"pmid": "1", "doi": "10.1/a", "abstract": "x", "full_text": "y", "is_full_text_pmc": True}, {"pmid": "2", "doi": "10.1/b"})
    works = spark.createDataFrame([("10.1/A", 7, 0.5, 1.0, "u")], "doi string, cited_by_count bigint, percentile double, fwci double, oa_url string")
    full = found.withColumns({"citation_normalized_percentile": F.lit(None).cast("double"), "fwci": F.lit(None).cast("double"), "oa_url": F.lit(None).cast("string")})
    run = C.collect(store, full, works, "q", "2024-01-01T00:00:00", "2024-01-01T00:01:00").first()
    assert (run["total_found"], run["total_processed"], run["with_full_text"], run["without_full_text"], run["with_openalex"], run["failed_openalex"]) == (2, 2, 1, 1, 1, 1)
    assert {r["pmid"]: r["cited_by_count"] for r in store.read("papers").collect()} == {"1": 7, "2": None} and store.read("failed_dois").first()["doi"] == "10.1/b"
    again = C.collect(store, full, works, "q2", "2024-01-02T00:00:00", "2024-01-02T00:01:00").first()
    assert again["total_processed"] == 1
    _, missed = C.collect_from_dois(store, spark.createDataFrame([("10.1/B",), ("10.9/z",)], "doi string"), full, works, "2024-01-03T00:00:00", "2024-01-03T00:01:00")
    assert [r["doi"] for r in missed.collect()] == ["10.9/z"]
    assert ids(C.search(found.withColumn("title", F.lit("alpha")), "alpha[ti]", 1)) == ["1"]


def test_files(spark, tmp_path):
    (tmp_path / "dois.txt").write_text("# c\n10.1/a \n\n 10.1/b\n")
    assert [r["doi"] for r in files.doi_list(spark, f"{tmp_path}/dois.txt").collect()] == ["10.1/a", "10.1/b"]
    assert files.doi_list(spark, f"{tmp_path}/dois.txt", False).count() == 3
    (tmp_path / "c.json").write_text('{"queries": ["a"], "max_results": 5}')
    conf = files.config(spark, f"{tmp_path}/c.json")
    assert conf["max_results"] == 5 and conf["check_num"] == 60_000
    (tmp_path / "q.json").write_text('{"queries": [{"id": "1", "name": "n", "query": "x"}, {"id": "2", "name": "m", "queries": ["y", "z"]}]}')
    assert [(r["id"], r["query"]) for r in files.catalogue(spark, f"{tmp_path}/q.json").collect()] == [("1", "x"), ("2", "y"), ("2", "z")]
    (tmp_path / "x.xml").write_text(f"<?xml version='1.0'?><Set>{ARTICLE}\n{ARTICLE.replace('77', '78')}</Set>")
    assert ids(pubmed.articles(files.xml_records(spark, f"{tmp_path}/x.xml", "PubmedArticle"))) == ["77", "78"]
    files.write_array(spark.createDataFrame([(1, "é"), (2, None)], "a int, b string").coalesce(1), f"file://{tmp_path}/arr")
    import json

    parts = "".join(p.read_text() for p in sorted((tmp_path / "arr").glob("part-*")))
    assert json.loads(parts) == [{"a": 1, "b": "é"}, {"a": 2, "b": None}]
    files.write_runs(papers(spark, {"pmid": "1", "is_full_text_pmc": True}, {"pmid": "2"}), f"file://{tmp_path}/run")
    assert spark.read.json(f"file://{tmp_path}/run/papers_without_fulltext").first()["pmid"] == "2"


class FakeClient:
    """Eleven thousand ids a year, 200 of them without a month."""

    def count(self, query):
        return 200 if " NOT " in query else 900 if "/" in query else 11_000 if "[pdat]" in query else 22_000

    def page(self, query, start, size):
        tag = query.rpartition("AND ")[2]
        return [f"{tag}-{i}" for i in range(start, start + size)]


def test_remote_source(spark):
    pages = remote.split(FakeClient(), "q", 15_000, 2024)
    assert sum(p.size for p in pages) == 15_000 and pages[0].query.endswith("2024/01[pdat]") and all(p.size <= remote.PAGE for p in pages)
    remote.register(spark)
    df = spark.read.format("corpus_search").options(query="q", client="tests.test_operators:FakeClient", max_results="2000", requests_per_second="1000", last_year="2024").load()
    assert df.count() == 2_000 and df.distinct().count() == 2_000


def test_stream_upserts(spark, tmp_path):
    store = CorpusStore(spark, f"file://{tmp_path}/s")
    like = papers(spark, {"pmid": "1", "title": "a"})
    for k, t in enumerate(("a", "b")):
        papers(spark, {"pmid": "1", "title": t}, {"pmid": f"x{k}", "title": t}).write.mode("append").parquet(f"file://{tmp_path}/in")
        upserts.upsert_stream(upserts.read_stream(spark, f"file://{tmp_path}/in", like), store, "papers", f"file://{tmp_path}/ck").awaitTermination()
    assert sorted((r["pmid"], r["title"]) for r in store.read("papers").collect()) == [("1", "b"), ("x0", "a"), ("x1", "b")]


def test_a_store_opened_with_another_number_of_buckets_keeps_unique_keys(spark, tmp_path):
    rows = lambda note: papers(spark, *({"pmid": str(k), "title": note, "collection_date": note} for k in range(50)))
    base = f"file://{tmp_path}/store"
    CorpusStore(spark, base, buckets=32).upsert("papers", rows("a"))
    other = CorpusStore(spark, base, buckets=8)
    other.upsert("papers", rows("b"))
    assert other.buckets_of("papers") == 32
    got = other.read("papers").select("pmid", "title").collect()
    assert len(got) == 50 and {r["title"] for r in got} == {"b"}
    other.delete("papers", spark.createDataFrame([("7",)], "pmid string"))
    other.rebucket("papers", 5)
    assert other.buckets_of("papers") == 5 and set(other.manifest("papers", other.version("papers"))) <= set(range(5))
    CorpusStore(spark, base).upsert("papers", rows("c"))
    got = other.read("papers").select("pmid", "title").collect()
    assert len(got) == 50 and {r["title"] for r in got} == {"c"}
    other.restore("papers", 1)
    assert other.buckets_of("papers") == 32
    other.upsert("papers", rows("d"))
    assert sorted(r["pmid"] for r in other.read("papers").select("pmid").collect()) == sorted(str(k) for k in range(50))
