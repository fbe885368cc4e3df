"""Search hits to papers: Europe PMC rows and preprint rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.falsy import filled
from paperloom.functions.text import authors_of, clean_comprehensive
from paperloom.sources.querylang import predicate, preprint_query

#: Sources that count as preprints, and servers' journal names.
PREPRINT_SOURCES = ("PPR", "MED", "Preprints.org")
SERVERS = {"biorxiv": "bioRxiv (preprint)", "medrxiv": "medRxiv (preprint)"}


def _or(*columns: str) -> Column:
    return F.coalesce(*(F.when(filled(F.col(c)), F.col(c)) for c in columns))


def preprint_journal(source: Column, journal: Column, preprint: Column) -> Column:
    """A preprint's journal is marked; without a journal its source stands in."""
    name = F.when(filled(journal), journal).otherwise(source)
    marked = F.when(F.contains(F.lower(name), F.lit("preprint")), name).otherwise(F.concat(name, F.lit(" (preprint)")))
    return F.when(preprint, marked).otherwise(journal)


def from_europepmc(hits: DataFrame) -> DataFrame:
    """Papers of hits (pmid, pmcid, doi, title, abstract, authors, journal, year, date, source, cited_by_count). Hits
    without pmid and DOI are dropped; the DOI stands in for a missing pmid."""
    preprint = F.coalesce(F.col("source").isin(*PREPRINT_SOURCES), F.lit(False))
    rows = hits.filter(filled(F.col("doi")) | filled(F.col("pmid")))
    year = F.when(filled(F.col("year")), F.col("year")).when(F.length("date") >= 4, F.substring("date", 1, 4))
    return rows.select(
        _or("pmid", "doi").alias("pmid"), "pmcid", "doi", "title", "abstract", authors_of(
            F.coalesce("authors", F.lit(""))
        ).alias("authors"),
        year.alias("year"), F.col("date").alias("date_published"), preprint_journal(
            F.col("source"), F.col("journal"), preprint
        ).alias("journal"),
        preprint.alias("is_preprint"), F.coalesce(
            "cited_by_count", F.lit(0)
        ).cast("long").alias("cited_by_count"), F.lit("EuropePMC").alias("source"),
    )


def from_preprints(hits: DataFrame) -> DataFrame:
    """Papers of preprint hits (pmid, doi, title, abstract, authors, date, first_date, server). A DOI is required."""
    date = _or("date", "first_date")
    table = F.create_map(*(F.lit(x) for pair in SERVERS.items() for x in pair))
    journal = F.coalesce(F.try_element_at(table, F.lower("server")), F.concat("server", F.lit(" (preprint)")))
    return hits.filter(filled(F.col("doi"))).select(
        _or("pmid", "doi").alias("pmid"), "doi", "title", "abstract", authors_of(
            F.coalesce("authors", F.lit(""))
        ).alias("authors"),
        F.when(
            F.length(date) >= 4, F.substring(date, 1, 4)
        ).alias("year"), date.alias("date_published"), journal.alias("journal"), F.lit("PubMed").alias("source"),
    )


def pdf_url(doi: Column, server: Column, unversioned: bool = False) -> Column:
    d = F.regexp_replace(doi, "v[^v]*$", "") if unversioned else doi
    return F.concat(F.lit("https://www."), server, F.lit(".org/content/"), d, F.lit(".full.pdf"))


def preprint_dois(
    papers: DataFrame, query: str, max_results: int | None = 100, start: str | None = None, end: str | None = None
) -> DataFrame:
    """(doi) of preprints that match, the first ``max_results`` in order of DOI or all; with dates, only those published from
    ``start`` to ``end``."""
    rows = papers.filter(predicate(preprint_query(query), papers.columns) & filled(F.col("doi")))
    if start:
        rows = rows.filter(F.col("date_published") >= start)
    if end:
        rows = rows.filter(F.substring("date_published", 1, len(end)) <= end)
    found = rows.select("doi").distinct()
    return found if max_results is None else found.orderBy("doi").limit(max_results)


def preprint_details(dois: DataFrame, collections: DataFrame) -> DataFrame:
    """(doi, detail): the first entry of each DOI's ``collection`` (doi, collection), null where there is none. Of several
    collections of a DOI that whose first entry is the least as JSON counts, so rows of ``dois`` stay one each."""
    side = collections.select("doi", F.get("collection", 0).alias("detail")).filter("detail is not null")
    side = side.groupBy("doi").agg(F.min_by("detail", F.to_json(F.struct("detail"))).alias("detail"))
    return dois.select("doi").join(side, "doi", "left")


#: Marks of a server in a journal's name.
SERVER_MARKS = {"medrxiv": "medrxiv", "biorxiv": "biorxiv"}


def server_of(journal: Column) -> Column:
    """The preprint server that a journal's name tells, bioRxiv if none."""
    low = F.lower(F.coalesce(journal, F.lit("")))
    return F.when(F.contains(low, F.lit(SERVER_MARKS["medrxiv"])), "medrxiv").otherwise("biorxiv")


def preprint_full_text(papers: DataFrame, pdfs: DataFrame) -> DataFrame:
    """papers (doi, journal, optional pdf_url) with ``full_text``, ``sections`` and ``full_text_url`` from PDFs (url, pages).

    An explicit address comes first, then the server's for the DOI, then the same without its version. The text is one
    section, "main".
    """
    server = server_of(F.col("journal"))
    explicit = F.col("pdf_url") if "pdf_url" in papers.columns else F.lit(None).cast("string")
    tried = F.array(F.nullif(explicit, F.lit("")), pdf_url(F.col("doi"), server), pdf_url(F.col("doi"), server, True))
    rows = papers.withColumn("_paper", F.monotonically_increasing_id())
    urls = rows.select("_paper", F.posexplode(tried).alias("_rank", "_url")).filter("_url is not null")
    texts = pdfs.select(F.col("url").alias("_url"), clean_comprehensive(pages_text(F.col("pages"))).alias("_text"))
    found = urls.join(texts.filter(filled(F.col("_text"))), "_url")
    first = found.groupBy("_paper").agg(F.min_by(F.struct("_text", "_url"), "_rank").alias("_hit"))
    out = rows.join(first, "_paper", "left")
    main = F.array(F.struct(F.lit(0).alias("pos"), F.lit("main").alias("name"), F.col("_hit._text").alias("content")))
    columns = [c for c in papers.columns if c not in ("full_text", "sections", "full_text_url")]
    return out.select(
        *columns, F.col("_hit._text").alias("full_text"), F.when(F.col("_hit").isNotNull(), main).alias("sections"),
        F.col("_hit._url").alias("full_text_url"),
    )


def title_key(c: Column) -> Column:
    """A title's letters and numbers in lower case, one space between words."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def dois_of_titles(titles: DataFrame, works: DataFrame, least: float = 0.8, frequent: int = 1_000) -> DataFrame:
    """(title, doi, score): the work (doi, title) nearest to each title, null if none has a score of ``least``.

    Equal normalised titles score 1. Others score the Jaccard index of their words, and are candidates if they share one of
    their rare words: for ``least`` t, two sets of words share one of the first n - ceil(t n) + 1 in any common order, here
    that of rising frequency, so no such pair is lost; ``frequent`` words (in more titles) are held back only as long as
    a title has rarer ones. Ties go to the smaller DOI.
    """
    words = lambda c: F.array_distinct(F.split(title_key(c), " "))
    asked = titles.select("title").distinct().withColumn("a", words(F.col("title"))).withColumn(
        "key", title_key(F.col("title"))
    )
    known = works.filter(filled(F.col("doi")) & filled(F.col("title")))
    known = known.select("doi", words(F.col("title")).alias("b"), title_key(F.col("title")).alias("key"))
    exact = asked.filter("key <> ''").join(known.groupBy("key").agg(F.min("doi").alias("doi")), "key")
    exact = exact.select("title", "doi", F.lit(1.0).alias("score"))
    left = asked.join(exact.select("title"), "title", "left_anti").filter("key <> ''")
    # Frequencies over both sides give one order of words.
    both = known.select(F.explode("b").alias("w")).unionByName(left.select(F.explode("a").alias("w")))
    often = both.groupBy("w").agg(F.count("*").alias("n")).filter(F.col("n") > frequent)

    def heads(rows: DataFrame, c: str, *keep: str) -> DataFrame:
        each = rows.select(*keep, c, F.explode(c).alias("w")).join(often, "w", "left")
        rank = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "w")
        ranked = each.groupBy(*keep, c).agg(F.array_sort(F.collect_list(rank)).alias("r"))
        size = F.size("r")
        return ranked.select(
            *keep, c, F.explode(F.slice("r", F.lit(1), size - F.ceil(size * least).cast("int") + 1)).alias("h")
        ).select(*keep, c, "h.w")

    pairs = heads(left, "a", "title").join(heads(known, "b", "doi"), "w").dropDuplicates(["title", "doi", "b"])
    score = F.size(F.array_intersect("a", "b")) / F.size(F.array_union("a", "b"))
    near = pairs.select("title", "doi", score.alias("score")).filter(F.col("score") >= least)
    best = near.groupBy("title").agg(
        F.max("score").alias("score"), F.min_by("doi", F.struct(-F.col("score"), "doi")).alias("doi")
    )
    found = exact.unionByName(best.select("title", "doi", "score"))
    return titles.select("title").distinct().join(found, "title", "left")


def pages_text(pages: Column) -> Column:
    """Pages of a document joined by blank lines, empty ones left out."""
    return F.array_join(F.filter(pages, filled), "\n\n")
