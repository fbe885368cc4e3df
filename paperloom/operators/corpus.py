"""Lookups, classification, enrichment, merging and statistics of papers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from paperloom import shared
from paperloom.functions import merge
from paperloom.functions.falsy import filled, wstrip
from paperloom.functions.text import clean_abstract, clean_comprehensive, doi_key, ellipsis
from paperloom.operators import matching


def upsert(existing: DataFrame, new: DataFrame, key: str = "pmid", seq: str = "ingest_seq") -> DataFrame:
    """Whole rows by key, the highest seq wins; rows with a null key are refused."""
    rows = existing.unionByName(new).filter(F.col(key).isNotNull())
    # max_by keeps one row for each key and task before the shuffle; a window would move them all.
    columns = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(
        F.max_by(F.struct(*columns), seq).alias("r")
    ).select(key, "r.*").select(*existing.columns)


def needs_enrichment(abstract: Column, full_text: Column) -> Column:
    return ~filled(abstract) | ~filled(full_text) | (wstrip(F.coalesce(abstract, F.lit(""))) == "")


def classify(candidates: DataFrame, store: DataFrame, skip_existing: bool = False) -> DataFrame:
    """(id, action) of candidate ids, matched by pmid first and DOI second: new, enrich or skip."""
    state = needs_enrichment(F.col("abstract"), F.col("full_text"))
    known = store.select("pmid", F.when(filled(F.col("doi")), F.col("doi")).alias("doi"), state.alias("needs"))
    by_pmid = known.select(F.col("pmid").alias("id"), F.col("needs").alias("by_pmid"))
    by_doi = known.filter("doi is not null").groupBy(F.col("doi").alias("id")).agg(
        F.min_by("needs", "pmid").alias("by_doi")
    )
    found = candidates.select("id").join(by_pmid, "id", "left").join(by_doi, "id", "left").withColumn(
        "needs", F.coalesce("by_pmid", "by_doi")
    )
    enrich = F.lit("skip") if skip_existing else F.lit("enrich")
    return found.select(
        "id", F.when(F.col("needs").isNull(), "new").when(F.col("needs"), enrich).otherwise("skip").alias("action")
    )


def enrich(papers: DataFrame, works: DataFrame) -> DataFrame:
    """Citation data by DOI in any case. Matched metrics overwrite, also with null; an address only if there is one. Of
    several works of a DOI the one most often cited counts, then the greatest of the other values."""
    values = F.struct(*(F.col(c).alias(f"_{c}") for c in ("cited_by_count", "percentile", "fwci", "oa_url")))
    side = works.select(doi_key(F.col("doi")).alias("_key"), values.alias("_v")).filter("_key is not null")
    side = side.groupBy("_key").agg(F.max("_v").alias("_v")).select("_key", "_v.*", F.lit(True).alias("_hit"))
    rows = papers.withColumn("_key", F.when(filled(F.col("doi")), doi_key(F.col("doi")))).join(side, "_key", "left")
    hit = F.col("_hit").isNotNull()
    out = {
        "cited_by_count": F.when(hit, F.col("_cited_by_count")).otherwise(F.col("cited_by_count")),
        "citation_normalized_percentile": F.when(hit, F.col("_percentile")).otherwise(
            F.col("citation_normalized_percentile")
        ),
        "fwci": F.when(hit, F.col("_fwci")).otherwise(F.col("fwci")),
        "oa_url": F.when(hit & filled(F.col("_oa_url")), F.col("_oa_url")).otherwise(F.col("oa_url")),
        "openalex_retrieved": hit | F.coalesce("openalex_retrieved", F.lit(False)),
    }
    return rows.withColumns(out).select(*papers.columns)


def doi_lookup(dois: DataFrame, papers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found: doi, pmid — the first by pmid; not found: doi)."""
    side = papers.filter(filled(F.col("doi"))).groupBy(
        doi_key(F.col("doi")).alias("_key")
    ).agg(F.min("pmid").alias("pmid"))
    asked = dois.select("doi", doi_key(F.col("doi")).alias("_key")).distinct()
    return asked.join(side, "_key").select("doi", "pmid"), asked.join(side, "_key", "left_anti").select("doi")


def missing(requested: DataFrame, returned: DataFrame, key: str = "pmid") -> DataFrame:
    return requested.select(key).join(returned.select(key), key, "left_anti")


def merge_stores(source: DataFrame, target: DataFrame, order_by: tuple[str, ...] = ("pmid",)) -> DataFrame:
    """target with source merged in, by DOI first and pmid second; ``action`` says what happened to each row.

    The result is that of a merge of one source row after another, in the order of ``order_by`` (rows that it doesn't tell
    apart come in the order of their hashes): ``matching`` says by keys alone which row each belongs to, and rows of one
    place are folded in order and merged once. Source rows without pmid have their DOI for one, as hits have; rows without
    either are no papers and aren't merged.
    """
    source = source.withColumn("pmid", F.coalesce(F.nullif("pmid", F.lit("")), "doi")).filter(filled(F.col("pmid")))
    columns = {f.name: f.dataType for f in target.schema}
    source = source.withColumn("_seq", F.struct(*order_by, F.xxhash64(*columns).alias("_hash"))).select(*columns, "_seq")
    spark = source.sparkSession
    keys = source.select("pmid", "doi", F.col("_seq").alias("seq")).distinct()
    place = matching.places(spark, keys, target).select("pmid", F.col("seq").alias("_seq"), "place", "there")
    rows = source.join(place, ["pmid", "_seq"])
    hit = F.max(F.when(F.col("there"), F.col("place"))).alias("hit")
    one = rows.groupBy("place").agg(hit, *(folded(n, k).alias(n) for n, k in columns.items()))
    pairs = target.select(F.struct(*columns).alias("a")).join(
        one.filter("hit is not null").select("hit", F.struct(*columns).alias("b")), F.col("a.pmid") == F.col("hit"), "left"
    )
    alone = F.col("hit").isNull()
    new = [F.when(alone, F.col(f"a.{n}")).otherwise(c).alias(n) for n, c in zip(columns, merge.records(pairs, columns))]
    merged = pairs.select(*new, F.when(alone, "kept").otherwise("merged").alias("action"))
    added = one.filter("hit is null").select(*columns, F.lit("added").alias("action"))
    return merged.unionByName(added)


def folded(name: str, kind) -> Column:
    """The aggregate that a merge of a group's rows in the order of ``_seq``, one into the next, leaves of a column. What
    is one row stays as it is."""
    c, seq = F.col(name), F.col("_seq")
    first, good = F.min_by(c, seq), merge.truthy(c, kind)
    if name in ("pmid", *merge.EXISTING_ONLY):
        return first
    if name in merge.LISTS:
        empty = F.array().cast("array<string>")
        parts = F.array_sort(F.collect_list(F.struct("_seq", F.coalesce(c, empty).alias("v"))))
        all_of = F.aggregate(F.transform(parts, lambda s: s["v"]), F.lit(None).cast("array<string>"), lambda a, b: F.when(a.isNull(), b).otherwise(merge.lists(a, b)))
        return F.when(F.count("*") == 1, first).otherwise(all_of)
    if name in merge.LONGEST:
        best = F.min_by(F.when(good, c), F.when(good, F.struct((-F.length(c)).alias("size"), "_seq")))
    elif kind.typeName() == "boolean":
        best = F.max(F.coalesce(c, F.lit(False)))
    elif kind.typeName() in ("array", "struct", "map"):
        best = F.coalesce(F.min_by(c, F.when(good, seq)), F.max_by(c, seq))
    else:
        best = F.min_by(c, F.when(good, seq))
    return F.when(F.count("*") == 1, first).otherwise(best)


def store_statistics(papers: DataFrame, failed: DataFrame) -> DataFrame:
    flag = lambda c, v, name: F.count_if(F.col(c) == v).alias(name)
    one = papers.agg(
        F.count("*").alias("total_papers"),
        flag("is_full_text_pmc", True, "with_full_text"),
        flag("is_full_text_pmc", False, "without_full_text"),
        flag("openalex_retrieved", True, "with_openalex"),
    )
    return one.join(failed.agg(F.count("*").alias("failed_dois")), F.lit(True))


def hit_statistics(hits: DataFrame) -> DataFrame:
    has = lambda c: F.count_if(filled(F.col(c))).alias(f"with_{c}")
    return hits.agg(
        F.count("*").alias("total"),
        has("doi"),
        has("pmid"),
        has("abstract"),
        F.count_if("is_preprint").alias("preprints"),
        F.count_if(~F.col("is_preprint")).alias("published"),
        F.sum(F.coalesce("cited_by_count", F.lit(0))).alias("total_citations"),
    )


def year_histogram(hits: DataFrame) -> DataFrame:
    return hits.groupBy(F.coalesce("year", F.lit("Unknown")).alias("year")).agg(F.count("*").alias("n"))


def coverage(papers: DataFrame, columns: list[str]) -> DataFrame:
    return papers.agg(
        *(
            F.round(
                F.avg(F.coalesce(F.col(c) != "", F.lit(False)).cast("int")), 6
            ).alias(f"{c}_coverage") for c in columns
        )
    )


def reclean(papers: DataFrame) -> DataFrame:
    """(pmid, abstract, full_text) of the rows that cleaning changes."""
    a, t = clean_abstract(F.col("abstract")), clean_comprehensive(F.col("full_text"))
    rows = papers.select("pmid", "abstract", "full_text", a.alias("new_abstract"), t.alias("new_text"))
    return rows.filter(
        ~F.col("abstract").eqNullSafe(F.col("new_abstract")) | ~F.col("full_text").eqNullSafe(F.col("new_text"))
    ).select("pmid", F.col("new_abstract").alias("abstract"), F.col("new_text").alias("full_text"))


def reclean_counts(papers: DataFrame) -> DataFrame:
    """One row: how many papers cleaning would change and how many it would leave."""
    a, t = clean_abstract(F.col("abstract")), clean_comprehensive(F.col("full_text"))
    same = F.col("abstract").eqNullSafe(a) & F.col("full_text").eqNullSafe(t)
    return papers.agg(F.count_if(~same).alias("modified"), F.count_if(same).alias("unchanged"))


def relevance(papers: DataFrame, words: list[str]) -> DataFrame:
    """``papers`` with ``score``: how often the words (letters and numbers, in any case) stand in title, twice, and abstract."""
    terms = F.array(*(F.lit(w.lower()) for w in words))
    parts = lambda c: F.split(F.lower(F.coalesce(F.col(c), F.lit(""))), r"[^\p{L}\p{N}]+")
    count = lambda c: F.size(F.filter(parts(c), lambda w: F.array_contains(terms, w)))
    return papers.withColumn("score", (2 * count("title") + count("abstract")).cast("long"))


def append_report(before: DataFrame, after: DataFrame, new: DataFrame, samples: int = 5) -> DataFrame:
    """One row on an append: rows before and after, ids that were new and that were there, and the first keys before."""
    keys = before.select("pmid").orderBy("pmid").limit(samples)
    told = new.select("pmid").distinct().join(before.select("pmid", F.lit(True).alias("there")), "pmid", "left")
    counts = told.agg(
        F.count_if(F.col("there").isNull()).alias("added"), F.count_if(F.col("there").isNotNull()).alias("known")
    )
    size = lambda df, name: df.agg(F.count("*").alias(name))
    sample = keys.agg(F.array_sort(F.collect_list("pmid")).alias("sample"))
    return size(before, "before").join(
        size(after, "after"), F.lit(True)
    ).join(counts, F.lit(True)).join(sample, F.lit(True))


def failed_export(papers: DataFrame) -> DataFrame:
    """What papers without full text are exported with."""
    rows = papers.filter(F.coalesce(~F.col("is_full_text_pmc"), F.lit(False)))
    return rows.select(
        "pmid",
        "doi",
        "title",
        F.array_join(F.slice("authors", 1, 3), "; ").alias("authors"),
        ellipsis(F.col("abstract"), 200).alias("abstract"),
        F.concat_ws(
            " | ",
            F.coalesce(F.nullif("doi", F.lit("")), F.lit("NO_DOI")),
            "pmid",
            F.coalesce(F.substring(F.nullif("title", F.lit("")), 1, 80), F.lit("NO_TITLE")),
        ).alias("line"),
    )


def numbered(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` with ``number``, from 0 in the order of ``by``, without a window over all rows: ranges of ``by`` are written
    with their part's number, numbered apart and offset by the counts of the parts before."""
    spark = rows.sparkSession
    parted = rows.repartitionByRange(by).sortWithinPartitions(by).withColumn("_part", F.spark_partition_id())
    parted = shared.written(spark, parted, shared.folder(spark, "numbered"))
    counts = parted.groupBy("_part").agg(F.count("*").alias("n"))
    # One row for each task of the write above.
    upto = F.sum("n").over(W.Window.orderBy("_part").rowsBetween(W.Window.unboundedPreceding, -1))
    before = counts.select(F.col("_part").alias("_p"), F.coalesce(upto, F.lit(0)).alias("_base"))
    within = parted.withColumn("_rn", F.row_number().over(W.Window.partitionBy("_part").orderBy(by)))
    out = within.join(before, F.col("_part") == F.col("_p"))
    return out.select(*rows.columns, (F.col("_base") + F.col("_rn") - 1).cast("long").alias("number"))


def batches(ids: DataFrame, size: int, key: str = "pmid") -> DataFrame:
    """(key, batch): ids in order, ``size`` to a batch."""
    return numbered(ids.select(key), key).select(key, F.floor(F.col("number") / size).cast("long").alias("batch"))


def guard(ids: DataFrame, check_num: int) -> DataFrame:
    """The ids, if they are fewer than ``check_num``."""
    if ids.limit(check_num).count() >= check_num:
        raise ValueError(f"{check_num} ids or more; narrow the query or raise check_num")
    return ids


def changes(existing: DataFrame, merged: DataFrame) -> DataFrame:
    """(pmid, changes): what a merge added to each row or made longer."""
    a, b = existing.alias("a"), merged.alias("b")
    length = lambda c: F.coalesce(F.length(c), F.lit(0))
    notes = []
    for name in ("abstract", "full_text"):
        x, y = F.col(f"a.{name}"), F.col(f"b.{name}")
        notes.append(
            F.when(~filled(x) & filled(y), F.lit(f"{name} added")).when(
                length(y) > length(x), F.concat(F.lit(f"{name} longer by "), (length(y) - length(x)).cast("string"))
            )
        )
    for name in ("authors", "keywords", "mesh_terms"):
        if name in existing.columns:
            more = F.coalesce(F.size(f"b.{name}"), F.lit(0)) - F.coalesce(F.size(f"a.{name}"), F.lit(0))
            notes.append(F.when(more > 0, F.concat(F.lit(f"{name} grew by "), more.cast("string"))))
    rows = a.join(b, F.col("a.pmid") == F.col("b.pmid")).select(
        F.col("a.pmid").alias("pmid"), F.filter(F.array(*notes), lambda x: x.isNotNull()).alias("changes")
    )
    return rows.filter(F.size("changes") > 0)


def reclean_preview(papers: DataFrame, samples: int = 3, chars: int = 500) -> DataFrame:
    """The first characters of some texts before and after cleaning."""
    text = F.col("full_text")
    rows = papers.filter(filled(text)).orderBy("pmid").limit(samples)
    return rows.select(
        "pmid",
        F.substring(text, 1, chars).alias("before"),
        F.substring(clean_comprehensive(text), 1, chars).alias("after"),
        F.length(text).alias("chars_before"),
        F.length(clean_comprehensive(text)).alias("chars_after"),
    )


def run_summary(run: DataFrame) -> str:
    """A run's row as text, with its duration and the share of full texts."""
    r = run.first()
    done = r["total_processed"] or 0
    percent = f"{100 * r['with_full_text'] / done:.1f} %" if done else "-"
    seconds = run.sparkSession.range(1).select(
        F.expr(f"timestampdiff(SECOND, timestamp'{r['start_time']}', timestamp'{r['end_time']}')")
    ).first()[0] if r["start_time"] and r["end_time"] else None
    names = (
        "query",
        "total_found",
        "total_processed",
        "with_full_text",
        "without_full_text",
        "with_openalex",
        "failed_pubmed",
        "failed_openalex",
    )
    return "\n".join(
        [
            *(f"{n.replace('_', ' ')}: {r[n]}" for n in names),
            f"full text: {percent}",
            f"seconds: {'-' if seconds is None else seconds}",
        ]
    )
