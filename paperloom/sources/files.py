"""Sources and sinks of files: DOI lists, configurations, query catalogues, XML, PDF pages; JSON and text exports."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import shared
from paperloom.functions.falsy import wstrip
from paperloom.operators import corpus

#: Defaults of a collection's configuration.
DEFAULTS = {
    "queries": [], "queries_suffix": "", "query_run_name": "", "use_suffix": False, "max_results": 60_000, "check_num": 60_000,
    "test_db": False, "output_dir": None, "description": "",
}


def doi_list(spark: SparkSession, path: str, skip_comments: bool = True) -> DataFrame:
    rows = spark.read.text(path).select(wstrip(F.col("value")).alias("doi")).filter("doi <> ''")
    return rows.filter(~F.col("doi").startswith("#")) if skip_comments else rows


def config(spark: SparkSession, path: str) -> dict:
    """One collection's settings, a single small JSON object."""
    text = "\n".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect())
    return DEFAULTS | json.loads(text)


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(id, name, query): one row for each query, nested lists flattened; entries without text are kept as null."""
    kind = "queries array<struct<id:string,name:string,query:string,description:string,queries:array<string>>>"
    rows = spark.read.schema(kind).json(path, multiLine=True).select(F.explode("queries").alias("q"))
    return rows.select("q.id", "q.name", F.explode_outer(F.coalesce("q.queries", F.array("q.query"))).alias("query"))


def xml_records(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """(xml): each record of an XML file as text, by Spark's splitting of the file at ``tag``."""
    rows = spark.read.text(path, lineSep=f"</{tag}>").filter(F.contains("value", F.lit(f"<{tag}")))
    return rows.select(F.concat(F.regexp_extract("value", rf"(?s)<{tag}[ >].*", 0), F.lit(f"</{tag}>")).alias("xml"))


def write_array(df: DataFrame, path: str, indent: bool = False) -> None:
    """One JSON array in one folder of part files that, read in order, are the array: no row passes through the driver.

    Rows are written once, with their task's number, so that the first row of all can open the array."""
    spark = df.sparkSession
    options = {"ignoreNullFields": "false"} | ({"pretty": "true"} if indent else {})
    rows = df.select(F.to_json(F.struct("*"), options).alias("j"), F.monotonically_increasing_id().alias("k"))
    rows = shared.written(spark, rows, shared.folder(spark, "array"))
    told = rows.agg(F.min("k"), F.count_distinct(F.shiftright("k", 33))).first()
    first, tasks = told[0], told[1]
    opening = F.when(F.col("k") == F.lit(first), F.lit("[")).otherwise(",")
    lines = rows.select("k", F.concat(opening, "j").alias("value"))
    end = spark.createDataFrame([(2**62, "[]" if first is None else "]")], "k long, value string")
    lines.unionByName(end).repartitionByRange(
        max(1, tasks), "k"
    ).sortWithinPartitions("k").select("value").write.mode("overwrite").text(path)


def write_runs(
    papers: DataFrame,
    path: str,
    query: str | None = None,
    description: str = "",
    dois: DataFrame | None = None,
    size: int = 1_000,
) -> None:
    """A run's artefacts: what was asked for, ids, checkpoints of ``size`` papers, all papers, with and without full text,
    statistics; a run from DOIs adds their list and the ids found for them."""
    spark = papers.sparkSession
    info = spark.range(1).select(
        F.lit(query).alias("query"),
        F.lit(description).alias("description"),
        F.current_timestamp().cast("string").alias("date"),
    )
    info.write.mode("overwrite").json(f"{path}/query_info")
    papers.select("pmid").write.mode("overwrite").text(f"{path}/pmid_list")
    number = corpus.batches(papers.select("pmid").distinct(), size)
    papers.join(number, "pmid").write.mode("overwrite").partitionBy("batch").json(f"{path}/papers_checkpoint")
    papers.write.mode("overwrite").json(f"{path}/papers_all")
    papers.filter("is_full_text_pmc").write.mode("overwrite").json(f"{path}/papers_with_fulltext")
    papers.filter(
        "not coalesce(is_full_text_pmc, false)"
    ).write.mode("overwrite").json(f"{path}/papers_without_fulltext")
    flag = F.coalesce("is_full_text_pmc", F.lit(False))
    told = papers.agg(
        F.count("*").alias("total"),
        F.count_if(flag).alias("with_full_text"),
        F.count_if(~flag).alias("without_full_text"),
    )
    told.write.mode("overwrite").json(f"{path}/statistics")
    if dois is not None:
        dois.select("doi").write.mode("overwrite").text(f"{path}/doi_list")
        corpus.doi_lookup(dois, papers)[0].write.mode("overwrite").json(f"{path}/doi_to_pmid_mapping")


def write_titles(found: DataFrame, path: str) -> None:
    """Results of a title lookup (title, doi): lines title:doi, and DOIs alone."""
    rows = found.filter("doi is not null")
    rows.select(F.concat_ws(":", "title", "doi").alias("value")).write.mode("overwrite").text(f"{path}/title_doi")
    rows.select(F.col("doi").alias("value")).write.mode("overwrite").text(f"{path}/doi")


def output_folders(base: str, test: bool = False) -> dict[str, str]:
    """Where a run's data, checkpoints, logs and store go below ``base``; a test has a store of its own."""
    base = base.rstrip("/")
    return {
        "base": base,
        "data": f"{base}/data",
        "checkpoints": f"{base}/checkpoints",
        "logs": f"{base}/logs",
        "store": f"{base}/{'test_store' if test else 'store'}",
    }


def tee_log(name: str, path: str):
    """A logger that writes to the console and to a file on the driver; a second call for a name adds nothing."""
    import logging

    log = logging.getLogger(name)
    if not log.handlers:
        log.setLevel(logging.INFO)
        for handler in (logging.StreamHandler(), logging.FileHandler(path, encoding="utf-8")):
            handler.setFormatter(logging.Formatter("%(asctime)s %(message)s"))
            log.addHandler(handler)
    return log


def pdf_pages(spark: SparkSession, path: str) -> DataFrame:
    """(path, pages) of PDF files: the text of each page, by whichever PDF library the workers have."""

    @F.pandas_udf("array<string>")
    def pages(content: pd.Series) -> pd.Series:
        import io

        try:
            from pypdf import PdfReader
        except ImportError as missing:
            raise RuntimeError("pdf_pages needs the library pypdf on the workers") from missing
        return content.map(lambda raw: [p.extract_text() or "" for p in PdfReader(io.BytesIO(raw)).pages])

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select(
        "path", pages("content").alias("pages")
    )


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)
