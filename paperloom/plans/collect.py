"""Collection as one plan: search, classify, parse, full text, enrichment, upsert, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom import shared
from paperloom.functions.falsy import filled
from paperloom.operators import corpus, fulltext, hits, pubmed
from paperloom.operators.store import CorpusStore
from paperloom.sources import files
from paperloom.sources.querylang import predicate


def search(papers: DataFrame, query: str, max_results: int = 50_000) -> DataFrame:
    """Ids of papers that match, in order of id, at most ``max_results``."""
    return papers.filter(predicate(query, papers.columns)).select("pmid").orderBy("pmid").limit(max_results)


def cached_search(store: CorpusStore, papers: DataFrame, query: str, max_results: int, now: str) -> DataFrame:
    """``search`` through the store's query cache. Only ids of one query reach the driver, at most ``max_results``."""
    hit = store.cached(query, max_results)
    if hit is not None:
        return hit
    ids = search(papers, query, max_results)
    store.put_cache(query, [r[0] for r in ids.collect()], max_results, now)
    return ids


def collect(
    store: CorpusStore, found: DataFrame, works: DataFrame, query: str, start: str, end: str, description: str = "",
    skip_existing: bool = False, run_id: str | None = None, rejects: DataFrame | None = None,
) -> DataFrame:
    """Put the ``found`` papers into the store: new ones and those that need enrichment; gives the run's row.

    A run has five commits (its query, papers, DOIs without text, rejected records, its counts), each marked with
    ``run_id``. A run that broke off is repeated under its id: commits that are there are passed over, and the counts are
    those of the papers' snapshot that the run made, so the store is as if it had run once. Without an id each call is a
    run of its own. ``rejects`` (as of ``pubmed.rejects``) are kept with the run's time and counted as failed_pubmed.
    """
    spark = store.spark
    asked = spark.createDataFrame(
        [(query, description, start)], "query_text string, description string, created_date string"
    )
    query_id = store.append("queries", asked, run_id)
    snapshot = store.marked("papers", run_id)
    if snapshot is None:
        state = corpus.classify(found.select(F.col("pmid").alias("id")), store.read("papers"), skip_existing)
        chosen = state.filter("action <> 'skip'").select(F.col("id").alias("pmid"))
        todo = found.join(chosen, "pmid", "left_semi")
        rows = corpus.enrich(
            todo.withColumn("query_id", F.lit(query_id).cast("long")).withColumn("collection_date", F.lit(start)), works
        )
        snapshot = store.upsert("papers", rows, run_id, fresh=True)
    # The run's papers: query ids are never given twice.
    written = store.read("papers", snapshot).filter(F.col("query_id") == query_id)
    lacking = written.filter("not coalesce(is_full_text_pmc, false) and coalesce(doi, '') <> ''")
    store.upsert(
        "failed_dois",
        lacking.select("doi", "pmid", F.lit("no full text").alias("reason"), F.lit(end).alias("timestamp")),
        run_id,
    )
    failed = 0
    if rejects is not None:
        kept = rejects.withColumn("timestamp", F.lit(start))
        store.upsert("rejects", kept, run_id)
        failed = rejects.count()
    run = written.agg(
        F.count("*").alias("total_processed"), F.count_if("is_full_text_pmc").alias("with_full_text"),
        F.count_if("openalex_retrieved").alias("with_openalex"),
        F.count_if(
            F.expr("coalesce(doi, '') <> '' and not coalesce(openalex_retrieved, false)")
        ).alias("failed_openalex"),
    )
    told = {
        "query": F.lit(query), "total_found": F.lit(found.count()).cast("long"), "failed_pubmed": F.lit(failed).cast("long"),
        "without_full_text": F.col(
            "total_processed"
        ) - F.col("with_full_text"), "start_time": F.lit(start), "end_time": F.lit(end),
    }
    number = store.append("collection_runs", run.withColumns(told), run_id)
    return store.read("collection_runs").filter(F.col("id") == number)


def collect_xml(
    store: CorpusStore, xml: DataFrame, works: DataFrame, query: str, start: str, end: str, description: str = "",
    skip_existing: bool = False, run_id: str | None = None,
) -> DataFrame:
    """``collect`` of bibliographic XML (xml): good records become papers, others go to the store's rejects with a reason.
    Each record is parsed once."""
    told = pubmed.checked(xml)
    path = shared.folder(store.spark, "records")
    told = shared.written(store.spark, told, path)
    run = collect(
        store, pubmed.good(told), works, query, start, end, description, skip_existing, run_id, pubmed.bad(told)
    )
    shared.drop(store.spark, path)
    return run


def retry_rejects(
    store: CorpusStore, works: DataFrame, start: str, end: str, run_id: str | None = None, repaired: DataFrame | None = None
) -> DataFrame:
    """Read the store's rejects again, those of ``repaired`` (digest, record) with their new text; gives the run's row.

    What can be read now is collected and leaves the rejects; the rest stays, with its reason and time brought up to date
    and its digest kept, so that a record remains one row however often it fails.
    """
    old = store.read("rejects").select("digest", "record")
    if repaired is not None:
        new = repaired.groupBy("digest").agg(F.min("record").alias("_new"))
        old = old.join(new, "digest", "left").select("digest", F.coalesce("_new", "record").alias("record"))
    path = shared.folder(store.spark, "retry")
    told = shared.written(store.spark, pubmed.checked(old, "record"), path)
    mended = pubmed.good(told)
    run = collect(
        store, mended, works, "retry of rejects", start, end, run_id=run_id, rejects=pubmed.bad(told)
    )
    store.delete("rejects", told.filter("reason is null").select("digest"))
    shared.drop(store.spark, path)
    return run


def batch_papers(
    hits_: DataFrame, articles: DataFrame, works: DataFrame, page_texts: DataFrame | None = None
) -> DataFrame:
    """Papers of Europe PMC hits: hits without id are dropped, full text comes from article XML (pmcid, xml) or, where that
    holds no more than boilerplate, from pages (pmcid, page_text), only for hits with a pmcid; then citation data."""
    rows = hits.from_europepmc(hits_)
    # The first article and the first page of an id: papers stay one row each.
    first = fulltext.first_text(articles, F.col("pmcid"), "xml").select(F.col("key").alias("pmcid"), F.col("text").alias("xml"))
    parsed = fulltext.jats(first).drop("xml")
    if page_texts is None:
        parsed = parsed.withColumn("page_text", F.lit(None).cast("string"))
    else:
        pages = fulltext.first_text(page_texts, F.col("pmcid"), "page_text")
        parsed = parsed.join(pages.select(F.col("key").alias("pmcid"), F.col("text").alias("page_text")), "pmcid", "left")
    best = fulltext.assemble(
        F.col("full_text"), F.col("sections"), F.col("has_body"), F.col("abstract"), F.col("page_text")
    )
    texts = parsed.select("pmcid", best.alias("t")).select(
        "pmcid", F.col("t.full_text").alias("full_text"), F.col("t.sections").alias("full_text_sections")
    )
    rows = rows.join(texts, "pmcid", "left").withColumn("is_full_text_pmc", filled(F.col("full_text")))
    none = {
        "citation_normalized_percentile": "double",
        "fwci": "double",
        "oa_url": "string",
        "openalex_retrieved": "boolean",
    }
    return corpus.enrich(rows.withColumns({c: F.lit(None).cast(k) for c, k in none.items()}), works)


def collect_to_files(
    found: DataFrame, works: DataFrame, path: str, query: str, description: str = "", seen: DataFrame | None = None
) -> DataFrame:
    """A run without a store: what has not been ``seen`` (pmid) is enriched and written as JSON artefacts; gives its papers."""
    todo = found.dropDuplicates(["pmid"]) if seen is None else found.dropDuplicates(["pmid"]).join(
        seen.select("pmid"), "pmid", "left_anti"
    )
    # Written once: each artefact is a pass over the run's papers.
    rows = shared.written(found.sparkSession, corpus.enrich(todo, works), shared.folder(found.sparkSession, "files-run"))
    files.write_runs(rows, path, query, description)
    return rows


def one_paper(
    pmid: str, xml: DataFrame, articles: DataFrame, works: DataFrame, page_texts: DataFrame | None = None
) -> DataFrame:
    """The whole path for one id: metadata from XML, text by PMC id, then by DOI (which then names the PMC id), citations."""
    paper = pubmed.papers(xml).filter(F.col("pmid") == pmid).limit(1)
    by_doi = articles.filter(filled(F.col("doi"))).groupBy(F.lower("doi").alias("_doi")).agg(F.min("pmcid").alias("_late"))
    paper = paper.join(
        by_doi, F.lower("doi") == F.col("_doi"), "left"
    ).withColumn("pmcid", F.coalesce("pmcid", "_late")).drop("_doi", "_late")
    hit = paper.select(
        "pmid", "pmcid", "doi", "title", "abstract", F.array_join("authors", ";").alias("authors"), "journal", "year",
        F.col(
            "date_published"
        ).alias("date"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("cited_by_count"),
    )
    return batch_papers(hit, articles, works, page_texts).withColumn("source", F.lit("PubMed"))


def collect_from_dois(
    store: CorpusStore, dois: DataFrame, papers: DataFrame, works: DataFrame, start: str, end: str, run_id: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(run, DOIs not found) of a list of DOIs looked up in ``papers``."""
    found, missed = corpus.doi_lookup(dois, papers)
    return collect(
        store, papers.join(found.select("pmid").distinct(), "pmid", "left_semi"), works, "DOI list", start, end, run_id=run_id
    ), missed
