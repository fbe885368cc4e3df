"""Which row of a store each incoming row belongs to, as if the rows came one after another.

A sequential merge looks a row up by DOI first and by pmid second, in a store that has changed with every row before. All
that changes there for a lookup is which row answers to a DOI: a DOI that the store doesn't have is *taken* by the row of
the first incoming pmid that has no DOI of its own by then, be it in the store or new. So of the pairs (pmid, DOI) in order,
the taking ones are a greedy matching: a pair takes its DOI if neither its pmid nor its DOI is in a taking pair before.

Greedy matchings need no order of steps to be followed: a pair that comes first among the pairs left of its pmid and of its
DOI takes, and all pairs with either leave. Each round is two aggregates by key, summed before they are shuffled, so a DOI
that a third of all rows share costs a row a task, and nothing collects a group. Rounds go on until no pair is left; a
chain of pmids and DOIs whose order runs along it takes a round for each link, others a few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import shared
from paperloom.functions.falsy import filled


def taken(spark: SparkSession, pairs: DataFrame) -> DataFrame:
    """(doi, pmid, seq) of the pairs (pmid, doi, seq) that take their DOI, in the order of ``seq``."""
    work = shared.folder(spark, "matching")
    left = shared.written(spark, pairs.groupBy("pmid", "doi").agg(F.min("seq").alias("seq")), f"{work}/pairs")
    out, step = None, 0
    while not left.isEmpty():
        step += 1
        first = lambda key: left.groupBy(key).agg(F.min("seq").alias("first")).select(F.col(key), "first")  # noqa: E731, B023
        a, b = first("pmid").withColumnRenamed("first", "by_pmid"), first("doi").withColumnRenamed("first", "by_doi")
        won = left.join(a, "pmid").join(b, "doi").filter((F.col("seq") == F.col("by_pmid")) & (F.col("seq") == F.col("by_doi")))
        won = shared.written(spark, won.select("doi", "pmid", "seq"), f"{work}/won{step}")
        rest = left.join(won.select("pmid"), "pmid", "left_anti").join(won.select("doi"), "doi", "left_anti")
        left = shared.written(spark, rest.select("pmid", "doi", "seq"), f"{work}/left{step}")
        out = won if out is None else out.unionByName(won)
    return left.select("doi", "pmid", "seq") if out is None else out


def places(spark: SparkSession, rows: DataFrame, store: DataFrame) -> DataFrame:
    """``rows`` (pmid, doi, seq) with ``place``, the pmid of the row each ends in, and ``there``, whether the store has it.

    Of several rows of the store with a DOI the one of the least pmid answers to it. ``seq`` is any orderable column.
    """
    own = F.when(filled(F.col("doi")), F.col("doi"))
    # Keys alone, written once: each side is read several times.
    work = shared.folder(spark, "places")
    rows = shared.written(spark, rows.withColumn("doi", own), f"{work}/rows")
    keys = shared.written(spark, store.select("pmid", own.alias("doi")), f"{work}/keys")
    held = keys.filter("doi is not null").groupBy("doi").agg(F.min("pmid").alias("held"))
    # Pairs that could take: a DOI that the store lacks, and a pmid whose row, if there is one, has no DOI.
    bound = keys.filter("doi is not null").select("pmid")
    open_pairs = rows.filter("doi is not null").join(held, "doi", "left_anti").join(bound, "pmid", "left_anti")
    got = taken(spark, open_pairs).select("doi", F.col("pmid").alias("taker"), F.col("seq").alias("since"))
    found = rows.join(held, "doi", "left").join(got, "doi", "left")
    place = F.coalesce("held", F.when(F.col("seq") > F.col("since"), F.col("taker")), "pmid")
    found = found.select("pmid", "doi", "seq", place.alias("place"))
    known = keys.select(F.col("pmid").alias("place"), F.lit(True).alias("there")).distinct()
    return found.join(known, "place", "left").select("pmid", "doi", "seq", "place", F.coalesce("there", F.lit(False)).alias("there"))
