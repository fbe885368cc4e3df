"""Papers, works and sections made of the driver's tables, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEAD = "\\documentclass[12pt]{minimal}\n\\usepackage{amsmath} \\begin{document}$$\\alpha$$ \\multirow $5   and "

SQL = r"""
papers AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS pmid,
    CASE WHEN d.doc_id % 7 = 0 THEN NULL ELSE concat('10.5555/', md5(d.text)) END AS doi,
    substring(d.text, 1, 80) AS title,
    CASE WHEN d.doc_id % 11 = 0 THEN '' ELSE d.text END AS abstract,
    CASE WHEN d.n_chars >= 1000 THEN d.text END AS full_text,
    coalesce(l.quality = 1, false) AS is_full_text_pmc,
    l.toxic IS NOT NULL AS openalex_retrieved,
    CAST(d.n_chars % 100 AS BIGINT) AS cited_by_count,
    CAST(d.doc_id % 8 + 1 AS BIGINT) AS query_id,
    concat('2024-01-', CAST(d.doc_id % 5 + 10 AS VARCHAR), 'T00:00:00') AS collection_date,
    CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE CAST(1990 + d.doc_id % 35 AS VARCHAR) END AS year,
    CASE WHEN d.doc_id % 3 = 0 THEN 'PPR' WHEN d.doc_id % 3 = 1 THEN 'MED' ELSE 'PMC' END AS source,
    concat('Journal of ', d.lang) AS journal,
    list_filter(list_slice(string_split(substring(d.text, 1, 80), ' '), 1, 3), lambda x: x <> '') AS mesh_terms,
    list_filter(list_slice(string_split(substring(d.text, 1, 80), ' '), 2, 5), lambda x: x <> '') AS authors
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
works AS (
  SELECT 'https://doi.org/' || upper(doi) AS doi, CAST(pmid AS BIGINT) % 50 AS cited_by_count,
    CASE WHEN CAST(pmid AS BIGINT) % 4 = 0 THEN NULL ELSE CAST(pmid AS BIGINT) % 10 / 2.0 END AS fwci,
    CASE WHEN CAST(pmid AS BIGINT) % 5 = 0 THEN NULL ELSE 'https://oa.example/' || pmid END AS oa_url
  FROM (SELECT min(CAST(pmid AS BIGINT)) AS n, CAST(min(CAST(pmid AS BIGINT)) AS VARCHAR) AS pmid, doi FROM papers WHERE doi IS NOT NULL AND openalex_retrieved GROUP BY doi)),
latex AS (
  SELECT CAST(doc_id AS VARCHAR) AS pmid, '\documentclass[12pt]{minimal}' || chr(10) || '\usepackage{amsmath} \begin{document}$$\alpha$$ \multirow $5   and '
    || substring(text, 1, 80) || chr(10) || '-' || chr(10) || ' * ' || chr(10) || chr(9) || text || chr(10) || '\foo{bar} \baz qux' || chr(10)
    || CASE WHEN doc_id % 2 = 0 THEN '## ' ELSE '' END || 'References' || chr(10) || '[1] ' || substring(text, 1, 80) AS text
  FROM documents),
sections AS (
  SELECT CAST(conv_id AS VARCHAR) AS pmid, CAST(turn AS INTEGER) AS pos,
    CASE WHEN turn = 0 THEN 'Abstract' WHEN turn % 4 = 1 THEN 'Introduction ' || CAST(turn AS VARCHAR) WHEN turn % 4 = 2 THEN 'Funding ' || CAST(turn AS VARCHAR) ELSE 'Note ' || CAST(turn AS VARCHAR) END AS name,
    text AS content
  FROM conversations)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, lab = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    i, words = F.col("doc_id"), F.split(F.substring("text", 1, 80), " ")
    some = lambda a, n: F.filter(F.slice(words, a, n), lambda x: x != "")
    return d.join(lab, "doc_id", "left").select(
        i.cast("string").alias("pmid"), F.when(
            i % 7 != 0, F.concat(F.lit("10.5555/"), F.md5("text"))
        ).alias("doi"), F.substring("text", 1, 80).alias("title"),
        F.when(i % 11 == 0, "").otherwise(F.col("text")).alias("abstract"), F.when(
            F.col("n_chars") >= 1000, F.col("text")
        ).alias("full_text"),
        F.coalesce(
            F.col("quality") == 1, F.lit(False)
        ).alias("is_full_text_pmc"), F.col("toxic").isNotNull().alias("openalex_retrieved"), (F.col("n_chars") % 100).cast("long").alias("cited_by_count"),
        (i % 8 + 1).cast("long").alias("query_id"), F.concat(
            F.lit("2024-01-"), (i % 5 + 10).cast("string"), F.lit("T00:00:00")
        ).alias("collection_date"),
        F.when(
            i % 13 != 0, (1990 + i % 35).cast("string")
        ).alias("year"), F.when(i % 3 == 0, "PPR").when(i % 3 == 1, "MED").otherwise("PMC").alias("source"),
        F.concat(
            F.lit("Journal of "), "lang"
        ).alias("journal"), some(1, 3).alias("mesh_terms"), some(2, 4).alias("authors"),
    )


def works(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = papers(spark, sf_dir).filter("doi is not null and openalex_retrieved").groupBy("doi").agg(
        F.min(F.col("pmid").cast("long")).alias("n")
    )
    n = F.col("n")
    return p.select(
        F.concat(
            F.lit("https://doi.org/"), F.upper("doi")
        ).alias("doi"), (n % 50).alias("cited_by_count"), F.when(n % 4 != 0, (n % 10) / 2.0).alias("fwci"),
        F.lit(None).cast("double").alias("percentile"), F.when(
            n % 5 != 0, F.concat(F.lit("https://oa.example/"), n.cast("string"))
        ).alias("oa_url"),
    )


def latex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pmid, text): every document's whole text behind a LaTeX head and before a list of references."""
    title = F.substring("text", 1, 80)
    heading = F.when(F.col("doc_id") % 2 == 0, "## ").otherwise("")
    whole = F.concat(
        F.lit(HEAD),
        title,
        F.lit("\n-\n * \n\t"),
        "text",
        F.lit("\n\\foo{bar} \\baz qux\n"),
        heading,
        F.lit("References\n[1] "),
        title,
    )
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("pmid"), whole.alias("text"))


def section_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, n = F.col("turn"), F.col("turn").cast("string")
    name = F.when(t == 0, "Abstract").when(
        t % 4 == 1, F.concat(F.lit("Introduction "), n)
    ).when(t % 4 == 2, F.concat(F.lit("Funding "), n)).otherwise(F.concat(F.lit("Note "), n))
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("pmid"),
        t.cast("int").alias("pos"),
        name.alias("name"),
        F.col("text").alias("content"),
    )


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pmid, sections): each conversation as an article's ordered sections."""
    return section_rows(spark, sf_dir).groupBy("pmid").agg(
        F.array_sort(F.collect_list(F.struct("pos", "name", "content"))).alias("sections")
    )
