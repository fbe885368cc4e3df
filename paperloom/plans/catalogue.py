"""Named queries over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom import schema
from paperloom.functions import merge, records, sections, text, validity
from paperloom.functions.falsy import NONWORD, WS, filled
from paperloom.operators import corpus, dedup, fulltext, hits
from paperloom.plans import views
from paperloom.sources.querylang import predicate
from paperloom.streaming.upserts import counts_by_window

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with SQL over the views where there is one."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = f"WITH {'RECURSIVE ' if 'walk(' in sql else ''}{views.SQL} {sql}"
        return f

    return put


def paper_query(name: str, sql: str):
    """A query over papers alone."""
    return lambda f: query(name, sql)(lambda s, d: f(views.papers(s, d)))


RANKED = """ranked AS (SELECT *, row_number() OVER (PARTITION BY doi ORDER BY {first}collection_date DESC NULLS
  LAST, pmid ASC NULLS FIRST) AS rn, count(*) OVER (PARTITION BY doi) AS n FROM papers WHERE coalesce(doi, '') <>
  '')"""
RECENT, FULL = RANKED.format(first=""), RANKED.format(first="is_full_text_pmc DESC, ")

# Duplicate DOIs
paper_query(
    "dup_doi_groups",
    "SELECT doi, count(*) AS n FROM papers WHERE coalesce(doi, '') <> '' GROUP BY doi HAVING count(*) > 1",
)(dedup.groups)
paper_query("dup_doi_report", """SELECT count(*) AS total_papers, count(doi) AS with_doi, count(*) - count(doi) AS
  without_doi,
  (SELECT count(*) FROM (SELECT doi FROM papers WHERE doi IS NOT NULL GROUP BY doi HAVING count(*) > 1)) AS
  duplicate_groups,
  (SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM papers WHERE doi IS NOT NULL GROUP BY doi HAVING
  count(*) > 1)) AS duplicate_rows FROM papers""")(dedup.report)
paper_query(
    "dedup_keep_recent",
    f", {
        RECENT
    } SELECT p.pmid, p.doi, p.collection_date FROM papers p LEFT JOIN ranked r ON p.pmid = r.pmid WHERE coalesce(r.rn, 1) = 1",
)(lambda p: dedup.keep_one(p).select("pmid", "doi", "collection_date"))
paper_query(
    "dedup_keep_fulltext",
    f", {
        FULL
    } SELECT p.pmid, p.doi, p.is_full_text_pmc FROM papers p LEFT JOIN ranked r ON p.pmid = r.pmid WHERE coalesce(r.rn, 1) = 1",
)(lambda p: dedup.keep_one(p, True).select("pmid", "doi", "is_full_text_pmc"))
paper_query(
    "dedup_plan",
    f", {RECENT} SELECT doi, pmid, CASE WHEN rn = 1 THEN 'keep' ELSE 'delete' END AS action FROM ranked WHERE n > 1",
)(dedup.plan)
paper_query("dedup_merge", f""", {RECENT} SELECT max(CASE WHEN rn = 1 THEN pmid END) AS pmid, doi, arg_min(title,
  rn) AS title,
    coalesce(arg_min(abstract, rn) FILTER (WHERE abstract <> ''), arg_min(abstract, rn)) AS abstract,
  coalesce(arg_min(year, rn) FILTER (WHERE year <> ''), arg_min(year, rn)) AS year,
    coalesce(arg_min(cited_by_count, rn) FILTER (WHERE cited_by_count <> 0), arg_min(cited_by_count, rn)) AS
  cited_by_count, bool_or(is_full_text_pmc) AS is_full_text_pmc FROM ranked GROUP BY doi
  UNION ALL SELECT pmid, doi, title, abstract, year, cited_by_count, is_full_text_pmc FROM papers WHERE
  coalesce(doi, '') = ''""")(lambda p: dedup.merge_groups(p).select("pmid", "doi", "title", "abstract", "year", "cited_by_count", "is_full_text_pmc"))
HOT_DOI = "CASE WHEN doi IS NOT NULL AND CAST(pmid AS BIGINT) % 3 = 0 THEN '10.5555/hot' ELSE doi END"
HOT = f", hot AS (SELECT * REPLACE ({HOT_DOI} AS doi) FROM papers)"


def _hot(p: DataFrame) -> DataFrame:
    """Papers of which a third share a DOI."""
    return p.withColumn("doi", F.expr(HOT_DOI))


paper_query("dedup_hot_plan", f"""{HOT}, {FULL.replace("FROM papers", "FROM hot")} SELECT doi, pmid, CASE WHEN rn = 1
  THEN 'keep' ELSE 'delete' END AS action FROM ranked WHERE n > 1""")(lambda p: dedup.plan(_hot(p), True))
paper_query("dedup_hot_keep", f"""{HOT}, {RECENT.replace("FROM papers", "FROM hot")} SELECT pmid, doi FROM ranked
  WHERE rn = 1 UNION ALL SELECT pmid, doi FROM hot WHERE coalesce(doi, '') = ''""")(
    lambda p: dedup.keep_one(_hot(p)).select("pmid", "doi")
)
paper_query("dedup_hot_merge", f"""{HOT}, {RECENT.replace("FROM papers", "FROM hot")} SELECT max(CASE WHEN rn = 1
  THEN pmid END) AS pmid, doi, coalesce(arg_min(abstract, rn) FILTER (WHERE abstract <> ''), arg_min(abstract, rn)) AS
  abstract, arg_min(full_text, rn) FILTER (WHERE full_text <> '') AS full_text, max(collection_date) AS collection_date
  FROM ranked GROUP BY doi UNION ALL SELECT pmid, doi, abstract, full_text, collection_date FROM hot WHERE
  coalesce(doi, '') = ''""")(
    lambda p: dedup.merge_groups(_hot(p)).select("pmid", "doi", "abstract", "full_text", "collection_date")
)
paper_query(
    "dedup_export",
    """SELECT doi, count(*) AS n, string_agg(pmid, ',' ORDER BY pmid) AS pmids FROM papers WHERE doi IS NOT NULL
  GROUP BY doi HAVING count(*) > 1""",
)(lambda p: dedup.export_groups(p).select("doi", F.col("count").alias("n"), F.array_join(F.transform("papers", lambda x: x["pmid"]), ",").alias("pmids")))

# Statistics
query("store_statistics", """SELECT count(*) AS total_papers, count(*) FILTER (WHERE is_full_text_pmc) AS
  with_full_text, count(*) FILTER (WHERE NOT is_full_text_pmc) AS without_full_text, count(*) FILTER (WHERE
  openalex_retrieved) AS with_openalex, (SELECT count(*) FROM papers WHERE doi IS NOT NULL AND NOT is_full_text_pmc)
  AS failed_dois FROM papers""")(
    lambda s, d: corpus.store_statistics(
        views.papers(s, d), views.papers(s, d).filter("doi is not null and not is_full_text_pmc")
    )
)
paper_query(
    "count_by_query", "SELECT query_id, count(*) AS n FROM papers GROUP BY query_id"
)(lambda p: p.groupBy("query_id").agg(F.count("*").alias("n")))
paper_query("hit_statistics", """SELECT count(*) AS total, count(doi) AS with_doi, count(pmid) AS with_pmid,
  count(*) FILTER (WHERE abstract <> '') AS with_abstract, count(*) FILTER (WHERE source IN ('PPR', 'MED')) AS
  preprints, count(*) FILTER (WHERE source NOT IN ('PPR', 'MED')) AS published, CAST(sum(cited_by_count) AS BIGINT)
  AS total_citations FROM papers""")(
    lambda p: corpus.hit_statistics(p.withColumn("is_preprint", F.col("source").isin("PPR", "MED")))
)
paper_query(
    "year_histogram", "SELECT coalesce(year, 'Unknown') AS year, count(*) AS n FROM papers GROUP BY 1"
)(corpus.year_histogram)
paper_query(
    "coverage_ratios",
    """SELECT round(avg(CASE WHEN doi <> '' THEN 1 ELSE 0 END), 6) AS doi_coverage, round(avg(CASE WHEN abstract <>
  '' THEN 1 ELSE 0 END), 6) AS abstract_coverage, round(avg(CASE WHEN full_text <> '' THEN 1 ELSE 0 END), 6) AS
  full_text_coverage FROM papers""",
)(lambda p: corpus.coverage(p, ["doi", "abstract", "full_text"]))
paper_query("run_counters", """SELECT query_id, count(*) AS processed, count(*) FILTER (WHERE is_full_text_pmc) AS
  with_full_text, count(*) - count(*) FILTER (WHERE is_full_text_pmc) AS without_full_text, round(100.0 * count(*)
  FILTER (WHERE is_full_text_pmc) / count(*), 1) AS percent FROM papers GROUP BY query_id""")(
    lambda p: p.groupBy("query_id").agg(
        F.count("*").alias("processed"), F.count_if("is_full_text_pmc").alias("with_full_text")
    ).select("query_id", "processed", "with_full_text", (F.col("processed") - F.col("with_full_text")).alias("without_full_text"), F.round(F.lit(100.0) * F.col("with_full_text") / F.col("processed"), 1).alias("percent"))
)

# Predicates and lookups
paper_query(
    "papers_with_fulltext", "SELECT pmid FROM papers WHERE is_full_text_pmc"
)(lambda p: p.filter("is_full_text_pmc").select("pmid"))
paper_query(
    "papers_without_fulltext", "SELECT pmid FROM papers WHERE NOT is_full_text_pmc"
)(lambda p: p.filter("not is_full_text_pmc").select("pmid"))
paper_query(
    "papers_by_query", "SELECT pmid, title FROM papers WHERE query_id = 3"
)(lambda p: p.filter("query_id = 3").select("pmid", "title"))
paper_query(
    "paper_by_doi", "SELECT min(pmid) AS pmid, doi FROM papers WHERE coalesce(doi, '') <> '' GROUP BY doi"
)(lambda p: dedup.with_doi(p).groupBy("doi").agg(F.min("pmid").alias("pmid")))
paper_query(
    "mesh_membership",
    """SELECT pmid, doi FROM papers WHERE list_contains(mesh_terms, 'The') AND query_id <= 4 AND cited_by_count > 50
  AND doi IS NOT NULL""",
)(lambda p: p.filter(F.array_contains("mesh_terms", "The") & (F.col("query_id") <= 4) & (F.col("cited_by_count") > 50) & F.col("doi").isNotNull()).select("pmid", "doi"))
paper_query(
    "needs_enrichment",
    f"SELECT pmid, coalesce(abstract, '') = '' OR coalesce(full_text, '') = '' OR regexp_replace(abstract, '^{WS}+|{
        WS
    }+$', '', 'g') = '' AS needs FROM papers",
)(lambda p: p.select("pmid", corpus.needs_enrichment(F.col("abstract"), F.col("full_text")).alias("needs")))
CANDIDATES = """(SELECT CASE WHEN i % 3 = 0 THEN coalesce(doi, 'none-' || pmid) WHEN i % 3 = 1 THEN pmid ELSE 'new-'
  || pmid END AS id FROM (SELECT *, CAST(pmid AS BIGINT) AS i FROM papers))"""
STORE = """store AS (SELECT *, coalesce(abstract, '') = '' OR coalesce(full_text, '') = '' AS needs FROM papers
  WHERE CAST(pmid AS BIGINT) % 2 = 0)"""


def candidates(p):
    i = F.col("pmid").cast("long")
    return p.select(
        F.when(
            i % 3 == 0, F.coalesce("doi", F.concat(F.lit("none-"), "pmid"))
        ).when(i % 3 == 1, F.col("pmid")).otherwise(F.concat(F.lit("new-"), "pmid")).alias("id")
    )


paper_query("classify_candidates", f""", {STORE}, by_doi AS (SELECT doi, arg_min(needs, pmid) AS needs FROM store
  WHERE doi IS NOT NULL GROUP BY doi)
  SELECT c.id, CASE WHEN coalesce(a.needs, b.needs) IS NULL THEN 'new' WHEN coalesce(a.needs, b.needs) THEN 'enrich'
  ELSE 'skip' END AS action
  FROM {CANDIDATES} c LEFT JOIN store a ON c.id = a.pmid LEFT JOIN by_doi b ON c.id = b.doi""")(lambda p: corpus.classify(candidates(p), p.filter(F.col("pmid").cast("long") % 2 == 0)))
paper_query(
    "missing_ids", f"SELECT id FROM {CANDIDATES} c WHERE NOT EXISTS (SELECT 1 FROM papers p WHERE p.pmid = c.id)"
)(lambda p: corpus.missing(candidates(p), p.select(F.col("pmid").alias("id")), "id"))
paper_query(
    "doi_lookup_found",
    f"SELECT c.id AS doi, min(p.pmid) AS pmid FROM (SELECT DISTINCT id FROM {
        CANDIDATES
    }) c JOIN papers p ON lower(c.id) = lower(p.doi) GROUP BY c.id",
)(lambda p: corpus.doi_lookup(candidates(p).select(F.col("id").alias("doi")), p)[0])
paper_query(
    "doi_lookup_not_found",
    f"SELECT DISTINCT c.id AS doi FROM {
        CANDIDATES
    } c WHERE NOT EXISTS (SELECT 1 FROM papers p WHERE lower(p.doi) = lower(c.id))",
)(lambda p: corpus.doi_lookup(candidates(p).select(F.col("id").alias("doi")), p)[1])

# Upserts and merges
SECOND = """second AS (SELECT pmid, 'new ' || title AS title, CAST(2 AS BIGINT) AS ingest_seq FROM papers WHERE
  CAST(pmid AS BIGINT) % 4 = 0)"""
paper_query("upsert_latest", f""", {SECOND} SELECT p.pmid, coalesce(s.title, p.title) AS title FROM papers p LEFT
  JOIN second s ON p.pmid = s.pmid""")(
    lambda p: corpus.upsert(
        p.select("pmid", "title", F.lit(1).cast("long").alias("ingest_seq")),
        p.filter(F.col("pmid").cast("long") % 4 == 0).select(
            "pmid", F.concat(F.lit("new "), "title").alias("title"), F.lit(2).cast("long").alias("ingest_seq")
        ),
    ).select("pmid", "title")
)
paper_query(
    "failed_doi_upsert",
    "SELECT doi, max(pmid) AS pmid FROM papers WHERE doi IS NOT NULL AND NOT is_full_text_pmc GROUP BY doi",
)(lambda p: _failed_upsert(p))


def _failed_upsert(p):
    """Failed DOIs into a table that has an earlier row for each of them."""
    rows = p.filter("doi is not null and not is_full_text_pmc").groupBy("doi").agg(
        F.min("pmid").alias("first"), F.max("pmid").alias("last")
    )
    old = rows.select("doi", F.concat(F.lit("old "), "first").alias("pmid"), F.lit("2024-01-01").alias("timestamp"))
    return corpus.upsert(
        old, rows.select("doi", F.col("last").alias("pmid"), F.lit("2024-02-01").alias("timestamp")), "doi", "timestamp"
    ).select("doi", "pmid")


OTHER = """src AS (SELECT CASE WHEN i % 2 = 0 THEN 'x' || pmid ELSE pmid END AS pmid, doi, CASE WHEN i % 3 = 0 THEN
  title || ' extended' ELSE '' END AS title, list_slice(authors, 2, 3) || ['Extra'] AS authors, CASE WHEN i % 2 = 0
  THEN cited_by_count + 1 ELSE 0 END AS cited_by_count FROM (SELECT *, CAST(pmid AS BIGINT) AS i FROM papers) WHERE
  i % 5 = 1), tgt AS (SELECT pmid, doi, title, authors, cited_by_count FROM papers WHERE CAST(pmid AS BIGINT) % 5 <>
  1 OR CAST(pmid AS BIGINT) % 2 = 1)"""


def two_stores(p):
    i = F.col("pmid").cast("long")
    extra = F.concat(F.filter(F.slice("authors", 2, 2), lambda x: x != ""), F.array(F.lit("Extra")))
    src = p.filter(i % 5 == 1).select(
        F.when(i % 2 == 0, F.concat(F.lit("x"), "pmid")).otherwise(F.col("pmid")).alias("pmid"),
        "doi",
        F.when(i % 3 == 0, F.concat("title", F.lit(" extended"))).otherwise("").alias("title"),
        extra.alias("authors"),
        F.when(i % 2 == 0, F.col("cited_by_count") + 1).otherwise(0).alias("cited_by_count"),
    )
    return src, p.filter((i % 5 != 1) | (i % 2 == 1)).select("pmid", "doi", "title", "authors", "cited_by_count")


MERGED = f""", {OTHER}, hit AS (SELECT s.*, coalesce((SELECT min(t.pmid) FROM tgt t WHERE t.doi = s.doi), (SELECT
  min(t.pmid) FROM tgt t WHERE t.pmid = s.pmid)) AS hit FROM src s),
  placed AS (SELECT *, coalesce(hit, min(pmid) OVER (PARTITION BY coalesce(doi, pmid))) AS cluster FROM hit),
  ordered AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY pmid) AS rn FROM placed),
  one AS (SELECT cluster, max(hit) AS hit, arg_min(pmid, rn) AS pmid, coalesce(arg_min(doi, rn) FILTER (WHERE doi <>
  ''), arg_min(doi, rn)) AS doi, CASE WHEN count(*) = 1 THEN any_value(title) ELSE arg_min(title,
  (-length(title)) * 100000 + rn) FILTER (WHERE title <> '') END AS title, list({{'rn': rn, 'a': authors}} ORDER BY rn) AS every, coalesce(arg_min(cited_by_count, rn) FILTER (WHERE cited_by_count
  <> 0), CASE WHEN count(*) = 1 THEN any_value(cited_by_count) END) AS cited_by_count FROM ordered GROUP BY cluster),
  folded AS (SELECT *, flatten(list_transform(every, lambda s: list_filter(s.a, lambda x: len(list_filter(every, lambda e: e.rn < s.rn
  AND list_contains(e.a, x))) = 0))) AS authors FROM one)
  SELECT t.pmid, coalesce(nullif(t.doi, ''), nullif(o.doi, '')) AS doi, CASE WHEN o.hit IS NULL THEN t.title WHEN
  length(o.title) > length(t.title) THEN o.title ELSE nullif(t.title, '') END AS title,
    array_to_string(CASE WHEN o.hit IS NULL THEN t.authors ELSE t.authors || list_filter(o.authors, lambda x: NOT
  list_contains(t.authors, x)) END, '|') AS authors,
    CASE WHEN o.hit IS NULL OR t.cited_by_count <> 0 THEN t.cited_by_count ELSE nullif(o.cited_by_count, 0) END AS
  cited_by_count, CASE WHEN o.hit IS NULL THEN 'kept' ELSE 'merged' END AS action
  FROM tgt t LEFT JOIN folded o ON t.pmid = o.hit
  UNION ALL SELECT pmid, doi, title, array_to_string(authors, '|'), cited_by_count, 'added' FROM folded WHERE hit IS
  NULL"""


@query("merge_stores", MERGED)
def _merge_stores(s, d):
    return corpus.merge_stores(*two_stores(views.papers(s, d))).withColumn("authors", F.array_join("authors", "|"))


#: Crossing keys: every paper once more under another pmid, DOIs shared by a few, merged in the order of the numbers.
CROSSED = """keyed AS (SELECT CAST(pmid AS BIGINT) AS i, title FROM papers),
tgt AS (SELECT 'p' || i AS pmid, CASE WHEN i % 4 = 0 THEN NULL WHEN i % 4 = 1 THEN '' ELSE 'd' || (i // 3) END AS doi, title FROM keyed),
src AS (SELECT i, coalesce(nullif(pmid, ''), doi) AS pmid, doi, title FROM (SELECT i, CASE WHEN i % 9 = 0 THEN NULL ELSE 'p' || ((i * 7) % 1500 + i // 1500) END AS pmid,
  CASE WHEN i % 5 = 0 THEN '' ELSE 'd' || ((i * 11) % 400) END AS doi, title || ' ' || (i % 4) AS title FROM keyed) WHERE coalesce(nullif(pmid, ''), doi) <> '')"""


def crossed(p):
    i = F.col("pmid").cast("long")
    name = lambda c: F.concat(F.lit("p"), c.cast("string"))
    doi = lambda c: F.concat(F.lit("d"), c.cast("string"))
    tgt = p.select(name(i).alias("pmid"), F.when(i % 4 == 0, None).when(i % 4 == 1, "").otherwise(doi(F.floor(i / 3))).alias("doi"), "title")
    src = p.select(
        i.alias("i"), F.when(i % 9 != 0, name((i * 7) % 1500 + F.floor(i / 1500))).alias("pmid"),
        F.when(i % 5 == 0, "").otherwise(doi((i * 11) % 400)).alias("doi"), F.concat("title", F.lit(" "), (i % 4).cast("string")).alias("title"),
    )
    return src, tgt


paper_query("merge_crossing_keys", f""", {CROSSED},
held AS (SELECT doi, min(pmid) AS held FROM tgt WHERE doi <> '' GROUP BY doi),
open_pairs AS (SELECT pmid, doi, row_number() OVER (ORDER BY min(i)) AS n, min(i) AS i FROM src WHERE doi <> '' AND doi NOT IN (SELECT doi FROM held)
  AND pmid NOT IN (SELECT pmid FROM tgt WHERE doi <> '') GROUP BY pmid, doi),
walk(n, takes) AS (SELECT CAST(0 AS BIGINT), CAST([] AS STRUCT(doi VARCHAR, pmid VARCHAR, i BIGINT)[])
  UNION ALL SELECT w.n + 1, CASE WHEN len(list_filter(takes, lambda t: t.doi = o.doi OR t.pmid = o.pmid)) = 0 THEN list_append(takes, {{'doi': o.doi, 'pmid': o.pmid, 'i': o.i}}) ELSE takes END
  FROM walk w JOIN open_pairs o ON o.n = w.n + 1),
takes AS (SELECT t.doi, t.pmid, t.i FROM (SELECT unnest(takes) AS t FROM walk WHERE n = (SELECT max(n) FROM walk))),
placed AS (SELECT s.*, coalesce(h.held, CASE WHEN s.i > t.i THEN t.pmid END, s.pmid) AS place FROM src s LEFT JOIN held h ON s.doi = h.doi LEFT JOIN takes t ON s.doi = t.doi),
folded AS (SELECT place, coalesce(arg_min(doi, i) FILTER (WHERE doi <> ''), CASE WHEN count(*) = 1 THEN any_value(doi) END) AS doi, arg_min(title, -length(title) * 10000000 + i) AS title FROM placed GROUP BY place)
SELECT t.pmid, CASE WHEN f.place IS NULL THEN t.doi ELSE coalesce(nullif(t.doi, ''), nullif(f.doi, '')) END AS doi, CASE WHEN length(f.title) > length(t.title) THEN f.title ELSE t.title END AS title,
  CASE WHEN f.place IS NULL THEN 'kept' ELSE 'merged' END AS action FROM tgt t LEFT JOIN folded f ON t.pmid = f.place
UNION ALL SELECT place, doi, title, 'added' FROM folded WHERE place NOT IN (SELECT pmid FROM tgt)""")(lambda p: corpus.merge_stores(*crossed(p), order_by=("i",)))
query("merge_actions", f""", {OTHER}, hit AS (SELECT s.pmid, coalesce((SELECT min(t.pmid) FROM tgt t WHERE t.doi =
  s.doi), (SELECT min(t.pmid) FROM tgt t WHERE t.pmid = s.pmid)) AS hit, s.doi FROM src s),
  placed AS (SELECT pmid, hit, coalesce(hit, min(pmid) OVER (PARTITION BY coalesce(doi, pmid))) AS cluster FROM hit)
  SELECT 'merged' AS action, count(DISTINCT hit) AS n FROM placed WHERE hit IS NOT NULL UNION ALL SELECT 'added',
  count(DISTINCT cluster) FROM placed WHERE hit IS NULL
  UNION ALL SELECT 'kept', (SELECT count(*) FROM tgt) - (SELECT count(DISTINCT hit) FROM placed WHERE hit IS NOT
  NULL)""")(
    lambda s, d: corpus.merge_stores(*two_stores(views.papers(s, d))).groupBy("action").agg(F.count("*").alias("n"))
)
paper_query(
    "merge_lists",
    """SELECT pmid, array_to_string(mesh_terms || list_filter(authors, lambda x: NOT list_contains(mesh_terms, x)),
  '|') AS merged FROM papers""",
)(lambda p: p.select("pmid", F.array_join(merge.lists(F.col("mesh_terms"), F.col("authors")), "|").alias("merged")))
paper_query("merge_scalar", """SELECT pmid, CASE WHEN coalesce(abstract, '') <> '' AND length(title) >
  length(abstract) THEN title WHEN coalesce(abstract, '') <> '' THEN abstract WHEN title <> '' THEN title END AS
  longest, CASE WHEN cited_by_count <> 0 THEN cited_by_count WHEN query_id <> 0 THEN query_id END AS first FROM
  papers""")(
    lambda p: p.select(
        "pmid",
        merge.scalar(F.col("abstract"), F.col("title"), p.schema["title"].dataType, True).alias("longest"),
        merge.scalar(F.col("cited_by_count"), F.col("query_id"), p.schema["query_id"].dataType).alias("first"),
    )
)

# Enrichment
query("enrich_left_join", """SELECT p.pmid, CASE WHEN w.doi IS NULL THEN p.cited_by_count ELSE w.cited_by_count END
  AS cited_by_count, w.fwci, w.oa_url, w.doi IS NOT NULL OR p.openalex_retrieved AS openalex_retrieved FROM papers p
  LEFT JOIN works w ON lower(p.doi) = lower(replace(w.doi, 'https://doi.org/', ''))""")(
    lambda s, d: corpus.enrich(
        views.papers(s, d).withColumns(
            {
                "citation_normalized_percentile": F.lit(None).cast("double"),
                "fwci": F.lit(None).cast("double"),
                "oa_url": F.lit(None).cast("string"),
            }
        ),
        views.works(s, d),
    ).select("pmid", "cited_by_count", "fwci", "oa_url", "openalex_retrieved")
)
query("enrich_unmatched", """SELECT pmid FROM papers p WHERE doi IS NOT NULL AND NOT EXISTS (SELECT 1 FROM works w
  WHERE lower(replace(w.doi, 'https://doi.org/', '')) = lower(p.doi))""")(
    lambda s, d: views.papers(s, d).filter("doi is not null").select(
        "pmid", text.doi_key(F.col("doi")).alias("k")
    ).join(views.works(s, d).select(text.doi_key(F.col("doi")).alias("k")), "k", "left_anti").select("pmid")
)
query(
    "doi_normalise", "SELECT doi, lower(replace(doi, 'https://doi.org/', '')) AS key FROM works"
)(lambda s, d: views.works(s, d).select("doi", text.doi_key(F.col("doi")).alias("key")))

# Text
STRIP = f"regexp_replace(%s, '^{WS}+|{WS}+$', '', 'g')"
paper_query(
    "clean_abstract",
    f"SELECT pmid, {STRIP % f'''regexp_replace(abstract, '{WS}+', ' ', 'g')'''} AS abstract FROM papers",
)(lambda p: p.select("pmid", text.clean_abstract(F.col("abstract")).alias("abstract")))


def clean_sql(c: str) -> str:
    """Cleaning as SQL, in literals of its own."""
    x = rf"regexp_replace({
        c
    }, '\\documentclass\[.*?\]\{{.*?\}}.*?\\begin\{{document\}}(.*?)\\end\{{document\}}', '\1', 'gs')"
    for p in (
        r"\\documentclass\[.*?\]\{.*?\}",
        r"\\usepackage\{.*?\}",
        r"\\setlength\{.*?\}\{.*?\}",
        r"\\begin\{document\}",
        r"\\end\{document\}",
    ):
        x = f"regexp_replace({x}, '{p}', '', 'g')"
    for name, sign in zip(("alpha", "beta", "gamma", "delta"), "αβγδ"):
        x = f"replace({x}, '$$\\{name}$$', '{sign}')"
    for name, sign in zip(
        ("alpha", "beta", "gamma", "delta", "mu", "sigma", "lambda", "theta", "pi", "omega"), "αβγδμσλθπω"
    ):
        x = f"replace({x}, '\\{name}', '{sign}')"
    x = rf"regexp_replace(regexp_replace({x}, '\\[a-zA-Z]+\{{([^}}]*)\}}', '\1', 'g'), '\\[a-zA-Z]+', '', 'g')"
    x = rf"regexp_replace(regexp_replace({x}, '\$+', '', 'g'), '\t+', ' ', 'g')"
    x = rf"regexp_replace(regexp_replace({x}, ' {{3,}}', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')"
    lines = f"list_transform(string_split({x}, chr(10)), lambda s: {STRIP % 's'})"
    kept = f"list_filter({lines}, lambda s: length(s) > 1 AND regexp_matches(s, '[\\p{{L}}\\p{{N}}]'))"
    return STRIP % f"array_to_string({kept}, chr(10))"


def strip_sql(c: str) -> str:
    headed = rf"regexp_replace({c}, '(?is)\n##\s*references\s*\n.*$', '')"
    return rf"regexp_replace({headed}, '(?is)\nreferences\s*\n.*$', '')"


query("clean_full_text", f"SELECT pmid, {clean_sql('text')} AS text FROM latex")(
    lambda s, d: views.latex(s, d).select("pmid", text.clean_full_text(F.col("text")).alias("text"))
)
query("strip_references", f"SELECT pmid, {strip_sql('text')} AS text FROM latex")(
    lambda s, d: views.latex(s, d).select("pmid", text.strip_references(F.col("text")).alias("text"))
)
query("clean_comprehensive", f"SELECT pmid, {strip_sql(clean_sql('text'))} AS text FROM latex")(
    lambda s, d: views.latex(s, d).select("pmid", text.clean_comprehensive(F.col("text")).alias("text"))
)
query("reclean_changed", f"""SELECT pmid, text AS full_text FROM (SELECT pmid, text AS old,
  {strip_sql(clean_sql('text'))} AS text FROM latex) WHERE old <> text""")(
    lambda s, d: corpus.reclean(
        views.latex(s, d).select("pmid", F.lit("a").alias("abstract"), F.col("text").alias("full_text"))
    ).select("pmid", "full_text")
)
paper_query(
    "query_hash", f"SELECT pmid, md5({STRIP % f'''regexp_replace(title, '{WS}+', ' ', 'g')'''}) AS hash FROM papers"
)(lambda p: p.select("pmid", text.query_hash(F.col("title")).alias("hash")))
paper_query(
    "summary_line",
    """SELECT 'PMID: ' || pmid || ' | DOI: ' || coalesce(doi, 'None') || ' | Title: ' || substring(title, 1, 50) ||
  '...' AS line FROM papers""",
)(lambda p: p.select(text.summary_line(F.col("pmid"), F.col("doi"), F.col("title")).alias("line")))
paper_query(
    "author_split",
    f"SELECT pmid, array_to_string(list_filter(list_transform(string_split(array_to_string(authors, '; ') || ';;', ';'), lambda s: {
        STRIP % 's'
    }), lambda s: s <> ''), '|') AS authors FROM papers",
)(lambda p: p.select("pmid", F.array_join(text.authors_of(F.concat(F.array_join("authors", "; "), F.lit(";;"))), "|").alias("authors")))
paper_query("preprint_journal", """SELECT pmid, CASE WHEN source IN ('PPR', 'MED') THEN journal || ' (preprint)'
  ELSE journal END AS journal, source IN ('PPR', 'MED') AS is_preprint, coalesce(year, '2024') AS year FROM papers""")(
    lambda p: hits.from_europepmc(
        p.select(
            "pmid",
            F.lit(None).cast("string").alias("pmcid"),
            "doi",
            "title",
            "abstract",
            F.array_join("authors", "; ").alias("authors"),
            "journal",
            "year",
            F.col("collection_date").alias("date"),
            "source",
            "cited_by_count",
        )
    ).select("pmid", "journal", "is_preprint", "year")
)
paper_query(
    "failed_export_rows",
    """SELECT pmid, doi, title, array_to_string(list_slice(authors, 1, 3), '; ') AS authors, CASE WHEN
  length(abstract) > 200 THEN substring(abstract, 1, 200) || '...' ELSE abstract END AS abstract,
  concat(coalesce(doi, 'NO_DOI'), ' | ', pmid, ' | ', substring(title, 1, 80)) AS line FROM papers WHERE NOT
  is_full_text_pmc""",
)(corpus.failed_export)
paper_query(
    "json_roundtrip",
    """SELECT pmid, doi, title, full_text, array_to_string(mesh_terms, '|') AS mesh_terms, cited_by_count,
  is_full_text_pmc, year, 32 AS fields FROM papers""",
)(lambda p: _round_trip(p))


def _round_trip(p):
    """Whole records: all fields of the paper type go to JSON and come back."""
    kind = schema.paper()
    record = p.select(
        *((F.col(f.name) if f.name in p.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in kind)
    )
    back = records.from_json(records.to_json(record), kind)
    return back.select(
        "pmid",
        "doi",
        "title",
        "full_text",
        F.array_join("mesh_terms", "|").alias("mesh_terms"),
        "cited_by_count",
        "is_full_text_pmc",
        "year",
        F.lit(len(back.columns)).alias("fields"),
    )


paper_query("topic_project", """SELECT pmid, journal AS topic_name, CASE WHEN CAST(pmid AS BIGINT) % 2 = 0 THEN
  source END AS topic_field, CASE WHEN CAST(pmid AS BIGINT) % 3 = 0 THEN year END AS topic_domain,
  CAST(NULL AS VARCHAR) AS topic_subfield FROM papers""")(lambda p: _topics(p))


def _topics(p):
    i, kind = F.col("pmid").cast("long"), schema.paper()["primary_topic"].dataType
    named = lambda c: F.struct(F.lit(None).cast("string").alias("id"), c.alias("display_name"))
    none = F.lit(None).cast("struct<id:string,display_name:string>")
    topic = F.struct(
        F.lit("t").alias("id"), F.col("journal").alias(
            "display_name"
        ), F.lit(0.5).alias("score"), none.alias("subfield"),
        F.when(
            i % 2 == 0, named(F.col("source"))
        ).alias("field"), F.when(i % 3 == 0, named(F.col("year"))).alias("domain"),
    ).cast(kind)
    return p.select("pmid", topic.alias("t")).select("pmid", *records.topic_fields(F.col("t")))


query(
    "batch_ids",
    "SELECT pmid, CAST(floor((row_number() OVER (ORDER BY pmid) - 1) / 30.0) AS BIGINT) AS batch FROM papers",
)(lambda s, d: corpus.batches(views.papers(s, d), 30))

# Sections
SECT = "FROM sections GROUP BY pmid"
BAD = "regexp_matches(lower(name), 'conflicts? of interest|competing interests|acknowledge?ments?|funding|financial disclosure|author contributions|data availability|supplementary material|supporting information|abbreviations|keywords|copyright|license|author information|correspondence|ethics|consent')"
GOOD = "regexp_matches(lower(name), 'introduction|background|method|materials|results|discussion|conclusion|analysis|findings|literature review|theory|hypothesis|experiment|case study|data|implementation|evaluation')"
paper_query("content_validity_lengths", f"""SELECT pmid, CASE CAST(pmid AS BIGINT) % 4 WHEN 0 THEN length(t) > 2000
  WHEN 1 THEN length(t) > 3000 WHEN 2 THEN true ELSE false END AS valid
  FROM (SELECT pmid, {STRIP % "coalesce(full_text, '')"} AS t FROM papers)""")(lambda p: _lengths(p))


def _lengths(p):
    """No sections; two long notes; a long introduction; one long note: the rules on the text's own length."""
    i = F.col("pmid").cast("long") % 4
    note = lambda n, name, size: F.struct(
        F.lit(n).alias("pos"), F.lit(name).alias("name"), F.lit("x" * size).alias("content")
    )
    none = F.array().cast(sections.SECTIONS)
    found = F.when(i == 0, none).when(
        i == 1, F.array(note(0, "Note", 600), note(1, "Remark", 501))
    ).when(i == 2, F.array(note(0, "Introduction", 501)))
    return p.select(
        "pmid",
        validity.has_meaningful_content(
            found.otherwise(F.array(note(0, "Note", 600), note(1, "Remark", 500))), F.col("full_text")
        ).alias("valid"),
    )


query("content_validity", f"""SELECT pmid, CASE WHEN m >= 1 AND l >= 1 THEN true WHEN l >= 3 AND b < l THEN true
  WHEN b > 0 AND m = 0 AND l < 3 THEN false WHEN l < 2 THEN false ELSE false END AS valid FROM (
  SELECT pmid, count(*) FILTER (WHERE bad AND NOT a) AS b, count(*) FILTER (WHERE good AND NOT bad AND NOT a) AS m,
  count(*) FILTER (WHERE NOT a AND NOT bad AND length({STRIP % 'content'}) > 500) AS l
  FROM (SELECT pmid, content, contains(lower(name), 'abstract') AS a, ({BAD}) AS bad, ({GOOD}) AS good FROM
  sections) GROUP BY pmid)""")(lambda s, d: views.sections(s, d).select("pmid", validity.has_meaningful_content(F.col("sections"), F.lit("")).alias("valid")))
FLAT = f"SELECT pmid, {
    STRIP % '''string_agg('## ' || name || chr(10) || chr(10) || trim_content || chr(10) || chr(10), '' ORDER BY CASE WHEN name = 'Abstract' THEN 1 ELSE 100 END, name)'''
} AS text FROM (SELECT *, {STRIP % 'content'} AS trim_content FROM sections WHERE content <> '') GROUP BY pmid"
query("sections_flatten", FLAT)(
    lambda s, d: views.sections(s, d).select("pmid", sections.to_flat(F.col("sections")).alias("text"))
)
query("sections_parse", f"""SELECT pmid, CAST(row_number() OVER (PARTITION BY pmid ORDER BY k) - 1 AS INTEGER) AS
  pos, {STRIP % "regexp_replace(split_part(part, chr(10), 1), '^#+', '')"} AS name,
  {STRIP % "substring(part, strpos(part, chr(10)) + 1)"} AS content FROM (SELECT pmid, unnest(parts) AS part,
  generate_subscripts(parts, 1) AS k FROM (SELECT pmid, string_split(text, chr(10) || '## ') AS parts FROM
  ({FLAT})))
  WHERE contains(part, chr(10))""")(lambda s, d: views.sections(s, d).select("pmid", F.explode(sections.from_flat(sections.to_flat(F.col("sections")))).alias("s")).select("pmid", "s.pos", "s.name", "s.content"))
query(
    "section_lookup",
    """SELECT s.pmid, coalesce((SELECT arg_min(content, pos) FROM sections t WHERE t.pmid = s.pmid AND name =
  'funding 2'), (SELECT arg_min(content, pos) FROM sections t WHERE t.pmid = s.pmid AND lower(name) = 'funding 2'),
  (SELECT arg_min(content, pos) FROM sections t WHERE t.pmid = s.pmid AND contains(lower(name), 'funding 2'))) AS
  content FROM (SELECT DISTINCT pmid FROM sections) s""",
)(lambda s, d: views.sections(s, d).select("pmid", sections.lookup(F.col("sections"), F.lit("funding 2")).alias("content")))
query(
    "section_keyword",
    """SELECT s.pmid, f.name FROM (SELECT DISTINCT pmid FROM sections) s LEFT JOIN (SELECT pmid, arg_min(name, pos)
  AS name FROM sections WHERE contains(lower(name), 'funding') OR contains(lower(name), 'note') GROUP BY pmid) f ON
  s.pmid = f.pmid""",
)(lambda s, d: views.sections(s, d).select("pmid", sections.find_by_keywords(F.col("sections"), ["Funding", "note"])["name"].alias("name")))
query("section_names", f"SELECT pmid, string_agg(name, '|' ORDER BY pos) AS names {SECT}")(
    lambda s, d: views.sections(s, d).select(
        "pmid", F.array_join(sections.names(F.col("sections")), "|").alias("names")
    )
)
query("sections_merge", """SELECT pmid, pos, name, CASE WHEN pos < 3 THEN content || chr(10) || chr(10) || 'new ' ||
  content ELSE content END AS content FROM (SELECT pmid, CAST(row_number() OVER (PARTITION BY pmid ORDER BY pos) - 1
  AS INTEGER) AS pos, name, content FROM sections)""")(
    lambda s, d: views.sections(s, d).select(
        "pmid",
        F.explode(
            sections.merge(
                F.slice("sections", 1, 3),
                F.transform(
                    "sections",
                    lambda x, i: F.struct(
                        x["pos"].alias("pos"),
                        x["name"].alias("name"),
                        F.when(i < 3, F.concat(F.lit("new "), x["content"])).otherwise(x["content"]).alias("content"),
                    ),
                ),
            )
        ).alias("s"),
    ).select("pmid", "s.pos", "s.name", "s.content")
)
query(
    "full_text_format",
    f"SELECT pmid, {
        STRIP % '''string_agg('## ' || name || chr(10) || chr(10) || content, chr(10) ORDER BY pos)'''
    } AS text FROM sections WHERE {STRIP % 'content'} <> '' GROUP BY pmid",
)(lambda s, d: views.sections(s, d).select("pmid", sections.full_text(F.col("sections"), F.lit("flat")).alias("text")))

# Search
LIKE = "regexp_matches(concat_ws(' ', title, abstract), '(?i)(^|[^\\p{L}\\p{N}])%s($|[^\\p{L}\\p{N}])')"
paper_query(
    "search_tiab", f"SELECT pmid FROM papers WHERE {LIKE % 'the'}"
)(lambda p: p.filter(predicate("the[tiab]")).select("pmid"))
paper_query(
    "search_boolean", f"SELECT pmid FROM papers WHERE (({LIKE % 'and'}) OR ({LIKE % 'und'})) AND NOT ({LIKE % 'of'})"
)(lambda p: p.filter(predicate("(and[tiab] OR und[Title/Abstract]) NOT of[tiab]".replace("(and", '("and"'))).select("pmid"))
paper_query("search_year_range", "SELECT pmid FROM papers WHERE year BETWEEN '2000' AND '2005'")(
    lambda p: p.withColumn("date_published", F.col("year")).filter(predicate("2000:2005[dp]")).select("pmid")
)
paper_query(
    "search_wildcard", "SELECT pmid FROM papers WHERE regexp_matches(title, '(?i)(^|[^\\p{L}\\p{N}])tion')"
)(lambda p: p.filter(predicate("tion*[ti]")).select("pmid"))
paper_query(
    "search_mesh_author",
    """SELECT pmid FROM papers WHERE len(list_filter(mesh_terms, lambda x: lower(x) = 'the')) > 0 OR
  len(list_filter(authors, lambda x: starts_with(lower(x), 'er'))) > 0""",
)(lambda p: p.filter(predicate('"the"[mesh] OR er[au]')).select("pmid"))
paper_query("search_europepmc", "SELECT pmid FROM papers WHERE year BETWEEN '1995' AND '2010' AND source <> 'PPR'")(
    lambda p: p.withColumn("date_published", F.col("year")).filter(
        predicate("PUB_YEAR:[1995 TO 2010] NOT SRC:PPR")
    ).select("pmid")
)

# Pages, waterfall, events
query("html_paragraphs")(
    lambda s, d: fulltext.pages(views.table(s, d, "pages").select("page_id", "html")).select("page_id", "page_text")
)
query("fulltext_waterfall", """SELECT pmid, CASE WHEN i % 2 = 0 THEN 'pmcid' WHEN EXISTS (SELECT 1 FROM papers o
  WHERE CAST(o.pmid AS BIGINT) % 3 = 0 AND o.doi = b.doi) THEN 'doi' END AS origin FROM (SELECT *, CAST(pmid AS
  BIGINT) AS i FROM papers) b""")(
    lambda s, d: (
        lambda p: fulltext.waterfall(
            p,
            p.filter(F.col("pmid").cast("long") % 2 == 0).select("pmcid", F.col("title").alias("text")),
            p.filter(F.col("pmid").cast("long") % 3 == 0).groupBy("doi").agg(F.min("title").alias("text")),
        ).join(p.select("pmid"), "pmid").select("pmid", "origin")
    )(views.papers(s, d).dropDuplicates(["doi", "pmid"]).withColumn("pmcid", F.concat(F.lit("PMC"), "pmid")).select("pmid", "pmcid", "doi", "title"))
)
query(
    "event_windows",
    "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
)(lambda s, d: counts_by_window(views.table(s, d, "events")))
query("fulltext_flag", f"""SELECT p.pmid, {STRIP % '''coalesce(full_text, '')'''} <> '' OR s.pmid IS NOT NULL AS has
  FROM papers p LEFT JOIN (SELECT DISTINCT pmid FROM sections) s ON p.pmid = s.pmid""")(
    lambda s, d: views.papers(s, d).join(views.sections(s, d), "pmid", "left").select(
        "pmid", sections.has_full_text(F.col("sections"), F.col("full_text")).alias("has")
    )
)
paper_query(
    "doi_present", "SELECT pmid FROM papers WHERE doi IS NOT NULL AND doi <> ''"
)(lambda p: p.filter(filled(F.col("doi"))).select("pmid"))
