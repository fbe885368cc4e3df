"""Named queries through the text index: each builds the index of all papers in the shared folder and asks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import shared
from paperloom.operators import corpus, fulltext
from paperloom.operators.index import TextIndex, term_counts
from paperloom.plans import views
from paperloom.plans.catalogue import LIKE, ORACLES, QUERIES, paper_query
from paperloom.sources import remote

__all__ = ["ORACLES", "QUERIES"]

#: A paper's stream of words, as the index folds them.
STREAM = """words AS (SELECT pmid, regexp_extract_all(replace(lower(concat_ws(' ', title, abstract, array_to_string(mesh_terms, ' '),
  array_to_string(authors, ' '))), 'ß', 'ss'), '[\\p{L}\\p{N}]+') AS w FROM papers)"""


def built(papers: DataFrame) -> TextIndex:
    return TextIndex.build(papers, shared.folder(papers.sparkSession, "text-index"))


def asked(query: str):
    """The ids that the index finds for a query."""
    return lambda p: built(p).search(p, query).select("pmid")


WORD = "regexp_matches(%s, '(?i)(^|[^\\p{L}\\p{N}])%s($|[^\\p{L}\\p{N}])')"
PHRASE = LIKE % "of[^\\p{L}\\p{N}]+the"

paper_query("indexed_tiab", f"SELECT pmid FROM papers WHERE {LIKE % 'the'}")(asked("the[tiab]"))
paper_query(
    "indexed_boolean", f"SELECT pmid FROM papers WHERE (({LIKE % 'and'}) OR ({LIKE % 'und'})) AND NOT ({LIKE % 'of'})"
)(asked('("and"[tiab] OR und[Title/Abstract]) NOT of[tiab]'))
paper_query(
    "indexed_wildcard", "SELECT pmid FROM papers WHERE regexp_matches(title, '(?i)(^|[^\\p{L}\\p{N}])tion')"
)(asked("tion*[ti]"))
paper_query("indexed_phrase", f"SELECT pmid FROM papers WHERE {PHRASE}")(asked('"of the"[tiab]'))
paper_query(
    "indexed_phrase_prefix",
    f"SELECT pmid FROM papers WHERE {LIKE.replace('($|[^\\p{L}\\p{N}])', '') % 'and[^\\p{L}\\p{N}]+th'}",
)(asked('"and th"*[tiab]'))
paper_query(
    "indexed_mixed",
    f"""SELECT pmid FROM papers WHERE (({LIKE % 'the'}) AND year BETWEEN '2000' AND '2010' OR source = 'PPR' AND {WORD % ('title', 'de')})
  AND NOT coalesce({WORD % ('abstract', 'ing')}, false)""",
)(
    lambda p: asked("the[tiab] AND 2000:2010[dp] OR (SRC:PPR AND de[ti]) NOT abstract:ing")(
        p.withColumn("date_published", F.col("year"))
    )
)
TF = "len(list_filter(w, lambda x: x = '{t}'))"
TERMS = ("and", "de", "the")
BM25 = f"""{STREAM}, sizes AS (SELECT count(*) AS papers, avg(len(w)) AS mean FROM words),
held AS (SELECT pmid, CAST(len(w) AS DOUBLE) AS n, {", ".join(f"CAST({TF.format(t=t)} AS DOUBLE) AS tf_{t}" for t in TERMS)} FROM words),
df AS (SELECT {", ".join(f"count(*) FILTER (WHERE tf_{t} > 0) AS df_{t}" for t in TERMS)} FROM held),
scored AS (SELECT pmid, {" + ".join(f"CASE WHEN tf_{t} > 0 THEN ln(1 + (papers - df_{t} + 0.5::DOUBLE) / (df_{t} + 0.5::DOUBLE)) * (tf_{t} * 2.2::DOUBLE / (tf_{t} + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n / mean))) ELSE 0 END" for t in TERMS)} AS score
  FROM held, sizes, df WHERE {" + ".join(f"tf_{t}" for t in TERMS)} > 0)"""


def micro(c) -> DataFrame:
    return F.floor(c * 1e6 + 0.5).cast("long")


paper_query("indexed_relevance", f", {BM25} SELECT pmid, CAST(floor(score * 1e6 + 0.5) AS BIGINT) AS score FROM scored")(
    lambda p: built(p).scores(list(TERMS)).select("pmid", micro(F.col("score")).alias("score"))
)
paper_query(
    "indexed_best",
    f""", {BM25} SELECT pmid, CAST(floor(score * 1e6 + 0.5) AS BIGINT) AS score, CAST(row_number() OVER (ORDER BY round(score, 9) DESC, pmid) AS INT) AS rank
  FROM scored QUALIFY rank <= 40""",
)(lambda p: built(p).best(list(TERMS), 40).select("pmid", micro(F.col("score")).alias("score"), "rank"))
paper_query(
    "indexed_terms", f", {STREAM} SELECT term, count(*) AS papers FROM (SELECT DISTINCT pmid, unnest(w) AS term FROM words) GROUP BY term"
)(lambda p: term_counts(built(p)))

# Remote services over the given tables: a client answers from a table of papers that is written for it


DATED = """dated AS (SELECT pmid, CASE WHEN i % 10 = 0 THEN NULL WHEN i % 10 = 1 THEN y WHEN i % 10 = 2 THEN y || '-' || m WHEN i % 3 = 0 THEN '2024-03-05'
  ELSE y || '-' || m || '-' || lpad(CAST(i % 28 + 1 AS VARCHAR), 2, '0') END AS date_published
  FROM (SELECT pmid, CAST(pmid AS BIGINT) AS i, CAST(2020 + CAST(pmid AS BIGINT) % 5 AS VARCHAR) AS y, lpad(CAST(CAST(pmid AS BIGINT) % 12 + 1 AS VARCHAR), 2, '0') AS m FROM papers))"""


def service(papers: DataFrame) -> dict[str, str]:
    """Options of the remote sources for a service that holds ``papers``: a third of them on one day, some without a whole
    date, and a cap of a tenth of all."""
    i = F.col("pmid").cast("long")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    year, month = (2020 + i % 5).cast("string"), two(i % 12 + 1)
    date = F.when(i % 10 == 0, None).when(i % 10 == 1, year).when(i % 10 == 2, F.concat_ws("-", year, month)).when(i % 3 == 0, "2024-03-05")
    rows = papers.select("pmid", "title", date.otherwise(F.concat_ws("-", year, month, two(i % 28 + 1))).alias("date_published"))
    spark = papers.sparkSession
    path = shared.folder(spark, "service")
    # By date, so that a request for a day reads the row groups of that day.
    rows = rows.repartitionByRange("date_published", "pmid").sortWithinPartitions("date_published", "pmid")
    cap = max(10, shared.written(spark, rows, path).count() // 10)
    remote.register(spark)
    client = {"client": "paperloom.sources.offline:Papers", "papers": path, "requests_per_second": "100000"}
    return client | {"cap": str(cap), "page_size": str(cap // 2), "first_year": "2021", "last_year": "2024"}


paper_query("remote_papers", "SELECT pmid FROM papers")(
    lambda p: p.sparkSession.read.format("corpus_search").options(query="q", max_results="1000000000", **service(p)).load()
)
paper_query("remote_papers_cursor", f", {DATED} SELECT pmid AS id FROM dated WHERE date_published LIKE '2024%'")(
    lambda p: p.sparkSession.read.format("corpus_cursor").options(query="(q) AND 2024[pdat]", max_results="1000000000", **service(p)).load()
)


@paper_query("remote_updates", f", {DATED} SELECT pmid FROM dated WHERE length(date_published) = 10 AND date_published > '2022-06-30'")
def _updates(p: DataFrame) -> DataFrame:
    """All days after one, streamed and written, the query being started twice from its checkpoint."""
    spark, options = p.sparkSession, service(p)
    sink, marks = (shared.folder(spark, x) for x in ("updates", "updates-checkpoint"))
    for _ in range(2):
        rows = spark.readStream.format("corpus_updates").options(query="q", after="2022/06/30", **options).load()
        writer = rows.writeStream.format("parquet").option("checkpointLocation", marks).option("path", sink)
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("pmid string").parquet(sink)


# First hits: sources that have several texts, works or entries for one key


paper_query(
    "fulltext_first_hit",
    """, own AS (SELECT *, CAST(pmid AS BIGINT) AS i FROM papers),
a AS (SELECT 'PMC' || (i % 200) AS pmcid, arg_min(title, (i, title)) AS text FROM own WHERE title <> '' AND i % 2 = 0 GROUP BY 1),
b AS (SELECT lower(doi) AS doi, min(title) AS text FROM own WHERE title <> '' AND doi <> '' GROUP BY 1)
SELECT o.pmid, coalesce(a.text, b.text) AS full_text, CASE WHEN a.text IS NOT NULL THEN 'pmcid' WHEN b.text IS NOT NULL THEN 'doi' END AS origin
FROM own o LEFT JOIN a ON a.pmcid = 'PMC' || o.i LEFT JOIN b ON b.doi = lower(o.doi)""",
)(
    lambda p: fulltext.waterfall(
        p.select("pmid", F.concat(F.lit("PMC"), "pmid").alias("pmcid"), F.upper("doi").alias("doi")),
        p.filter(F.col("pmid").cast("long") % 2 == 0).select(
            F.concat(F.lit("PMC"), (F.col("pmid").cast("long") % 200).cast("string")).alias("pmcid"), F.col("title").alias("text"), F.col("pmid").cast("long").alias("rank")
        ),
        p.select("doi", F.col("title").alias("text")),
    ).select("pmid", "full_text", "origin")
)
paper_query(
    "enrich_repeated_works",
    """, w AS (SELECT lower(doi) AS doi, max(cited_by_count * 1000 + CAST(pmid AS BIGINT) % 1000) AS cited FROM papers WHERE doi <> '' GROUP BY 1)
SELECT p.pmid, coalesce(w.cited, p.cited_by_count) AS cited_by_count, w.cited IS NOT NULL OR p.openalex_retrieved AS openalex_retrieved FROM papers p LEFT JOIN w ON lower(p.doi) = w.doi""",
)(
    lambda p: corpus.enrich(
        p.select("pmid", "doi", "cited_by_count", "openalex_retrieved", F.lit(None).cast("double").alias("citation_normalized_percentile"), F.lit(None).cast("double").alias("fwci"), F.lit(None).cast("string").alias("oa_url")),
        p.select(
            F.concat(F.lit("https://doi.org/"), F.upper("doi")).alias("doi"), (F.col("cited_by_count") * 1000 + F.col("pmid").cast("long") % 1000).alias("cited_by_count"),
            F.lit(None).cast("double").alias("percentile"), F.lit(None).cast("double").alias("fwci"), F.lit(None).cast("string").alias("oa_url"),
        ),
    ).select("pmid", "cited_by_count", "openalex_retrieved")
)
