"""Duplicate DOIs: groups, reports and the three ways to resolve them, by aggregates that tasks begin on their own
rows: a DOI that many rows share costs each task one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.functions.falsy import filled, truthy


def with_doi(papers: DataFrame) -> DataFrame:
    return papers.filter(filled(F.col("doi")))


def groups(papers: DataFrame) -> DataFrame:
    """(doi, n) of DOIs that more than one row has."""
    return with_doi(papers).groupBy("doi").agg(F.count("*").alias("n")).filter("n > 1")


def firsts(papers: DataFrame, fulltext_first: bool = False) -> DataFrame:
    """(doi, pmid, n): the preferred row of each DOI, and how many have it. The latest is preferred, of these the least pmid;
    before that, if asked for, those with full text.

    Two aggregates, the first by DOI, full text and date: tasks shuffle a row for each of their groups, so a DOI that a
    third of all rows share is as cheap as another.
    """
    full = F.coalesce("is_full_text_pmc", F.lit(False)) if fulltext_first else F.lit(True)
    rows = with_doi(papers).select("doi", full.alias("f"), F.col("collection_date").alias("d"), "pmid")
    # A null date comes last, a null pmid first: structs order nulls before all else.
    by_date = rows.groupBy("doi", "f", "d").agg(F.min(F.struct("pmid")).alias("p"), F.count("*").alias("k"))
    best = by_date.groupBy("doi").agg(F.max_by("p", F.struct("f", "d")).alias("p"), F.sum("k").alias("n"))
    return best.select("doi", "p.pmid", "n")


def plan(papers: DataFrame, fulltext_first: bool = False) -> DataFrame:
    """(doi, pmid, action) of every row of a duplicate group: what applying the strategy would do."""
    first = firsts(papers, fulltext_first).filter("n > 1").select("doi", F.col("pmid").alias("_first"))
    return with_doi(papers).select("doi", "pmid").join(first, "doi").select(
        "doi", "pmid", F.when(F.col("pmid").eqNullSafe(F.col("_first")), "keep").otherwise("delete").alias("action")
    )


def keep_one(papers: DataFrame, fulltext_first: bool = False) -> DataFrame:
    """The store without the rows that the plan deletes; rows without DOI stay. Rows are met by pmid, never by DOI."""
    kept = firsts(papers, fulltext_first).select(F.col("pmid").alias("_kept"))
    rows = with_doi(papers).join(kept, F.col("pmid").eqNullSafe(F.col("_kept")), "left_semi")
    return rows.unionByName(papers.filter(~filled(F.col("doi"))))


def merge_groups(papers: DataFrame) -> DataFrame:
    """Each group's most recent row, its falsy values filled from the next rows in order. Lists count as stored text, so
    an empty list is a value. Rows without DOI pass.

    Which row gives which value is found on flags alone, as in ``firsts`` in two aggregates, by date and by DOI. Then only
    rows that give a value are fetched, by pmid: a group, however large, has at most one for each column, and rows that
    are alone with their DOI pass as they are.
    """
    other = [f for f in papers.schema if f.name not in ("pmid", "doi", "collection_date")]

    def good(f: T.StructField):
        c = F.col(f.name)
        full = c.isNotNull() if isinstance(f.dataType, (T.ArrayType, T.StructType)) else truthy(c, f.dataType)
        return F.coalesce(full, F.lit(False))

    flags = with_doi(papers).select(
        "doi", F.col("collection_date").alias("d"), F.struct("pmid").alias("row"),
        *(good(f).alias(f"g{k}") for k, f in enumerate(other)),
    )
    by_date = flags.groupBy("doi", "d").agg(
        F.count("*").alias("n"), F.min("row").alias("row"),
        *(F.min(F.when(F.col(f"g{k}"), F.col("row"))).alias(f"g{k}") for k in range(len(other))),
    )
    date = F.struct("d")
    # Where no row of a group has a value, its first row's stands.
    first = F.max_by("row", date)
    giver = lambda k: F.coalesce(F.max_by(f"g{k}", F.when(F.col(f"g{k}").isNotNull(), date)), first)
    groups_ = by_date.groupBy("doi").agg(
        F.sum("n").alias("_n"), first.alias("_first"), F.array(*(giver(k) for k in range(len(other)))).alias("_givers")
    )
    asked = groups_.select("_n", "_first", "_givers", F.explode(F.array_distinct(F.concat(F.array("_first"), "_givers"))).alias("_giver"))
    rows = with_doi(papers).join(asked, F.col("pmid").eqNullSafe(F.col("_giver.pmid")))
    alone = rows.filter("_n = 1").select(*papers.columns)
    # A value in an array of its own: a null that a row gives differs from the rows that don't give it.
    given = lambda k, f: F.when(F.get("_givers", F.lit(k)) == F.col("_giver"), F.array(f.name))
    is_first = F.col("_giver") == F.col("_first")
    merged = rows.filter("_n > 1").groupBy("doi").agg(
        F.max("_first")["pmid"].alias("pmid"),
        F.max(F.when(is_first, F.col("collection_date"))).alias("collection_date"),
        *(F.get(F.first(given(k, f), ignorenulls=True), F.lit(0)).alias(f.name) for k, f in enumerate(other)),
    )
    return merged.select(*papers.columns).unionByName(alone).unionByName(papers.filter(~filled(F.col("doi"))))


def report(papers: DataFrame) -> DataFrame:
    """One row: papers, with and without DOI, duplicate groups and the rows in them."""
    known = papers.select(filled(F.col("doi")).alias("has"), F.when(filled(F.col("doi")), F.col("doi")).alias("doi"))
    per = known.groupBy("has", "doi").agg(F.count("*").alias("n"))
    dup = F.col("has") & (F.col("n") > 1)
    return per.agg(
        F.sum("n").alias("total_papers"), F.sum(F.when(F.col("has"), F.col("n")).otherwise(0)).alias("with_doi"), F.sum(
            F.when(~F.col("has"), F.col("n")).otherwise(0)
        ).alias("without_doi"),
        F.sum(dup.cast("long")).alias("duplicate_groups"), F.sum(
            F.when(dup, F.col("n")).otherwise(0)
        ).alias("duplicate_rows"),
    )


def export_groups(papers: DataFrame) -> DataFrame:
    """(doi, count, papers): a row for each group, for JSON."""
    rows = with_doi(papers).join(groups(papers), "doi")
    return rows.groupBy("doi").agg(
        F.count("*").alias("count"),
        F.sort_array(F.collect_list(F.struct("pmid", "title", "collection_date", "is_full_text_pmc"))).alias("papers"),
    )
