"""Document fingerprints of closed syncmers (operator 8), in DataFrame functions only.

A text is a sequence of units: words, with words of more than ``UNIT`` characters cut into stretches of ``UNIT``, so
that text without spaces works too. A run of ``K`` units is an anchor if the smallest hash among its inner runs of
``S`` units lies at either edge. Whether a run is an anchor depends on nothing outside it, so an edit moves only the
anchors it touches, and anchors of two texts can be matched by value and place. About 2 / (K - S + 1) of all runs are
anchors, and no K - S + 1 runs in a row lack one. The fingerprint lists the anchors' hashes (32 bits) in order of place, 8
hex digits each. Likeness is the Jaccard index of two fingerprints' anchors.

Neighbours in ascending id are found in ranges of ids: a range's rows meet in one task, together with the first rows of
the next range (guests). No row's text moves more than once, but for one row in each range. An id that many rows share, or
null, is cut into ranges by the hash of the text, so these rows are spread like others.

Defined results: null text is empty and has an empty fingerprint; a text of fewer than K units has one anchor, the hash
of all of them; two empty fingerprints have likeness 1, one against another 0; rows of equal ids follow one another by
the hash of their texts; null ids come first; a single row is its own neighbour; an empty table gives an empty result;
very long texts are fingerprinted whole; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from paperloom.llm import common

UNIT = 16
K = 7
S = 2
RANGES = 2  # for each shuffle partition


def with_anchors(df: DataFrame, text: str, out: str, places: bool = False) -> DataFrame:
    """Adds ``out``: the hashes of the anchors of column ``text``, in order (array<bigint>); with ``places``
    as array<struct<unit, hash>>, with the units at which anchors begin."""
    u, h, m, n = f"{out}_u", f"{out}_h", f"{out}_m", f"{out}_n"
    size = F.size(u)
    df = df.withColumn(u, F.regexp_extract_all(F.col(text), F.lit(rf"[^\x20\x09-\x0D]{{1,{UNIT}}}"), F.lit(0)))
    df = df.withColumn(h, F.transform(u, lambda x: F.xxhash64(x)))
    # Inner runs of S = 2 units, and minima over 2, 4 and K - S + 1 = 6 of them, by doubling.
    one = lambda c, skip, span: F.slice(c, skip + 1, F.greatest(F.size(c) - span, F.lit(0)))
    pair = lambda c, gap, f: F.zip_with(one(c, 0, gap), one(c, gap, gap), f)
    least = lambda a, b: F.least(a, b)
    df = df.withColumn(m, pair(F.col(h), 1, lambda a, b: F.xxhash64(a, b)))
    df = df.withColumn(f"{n}2", pair(F.col(m), 1, least))
    df = df.withColumn(f"{n}4", pair(F.col(f"{n}2"), 2, least))
    df = df.withColumn(n, pair(F.col(f"{n}4"), 2, least))
    at = lambda c, i: F.get(F.col(c), i)
    closed = lambda x, i: (x == at(m, i)) | (x == at(m, i + K - S))
    whole = lambda i: F.xxhash64(at(m, i), at(m, i + 2), at(m, i + 4), at(h, i + 6))
    told = lambda i, x: F.struct(i.cast("int").alias("unit"), x.alias("hash")) if places else x
    anchors = F.filter(F.transform(n, lambda x, i: F.when(closed(x, i), told(i, whole(i)))), lambda x: x.isNotNull())
    alone = F.array(told(F.lit(0), F.xxhash64(F.array_join(u, " "))))
    none = F.array().cast("array<struct<unit:int,hash:bigint>>" if places else "array<bigint>")
    short = F.when(size > 0, alone).otherwise(none)
    return df.withColumn(out, F.when(size >= K, anchors).otherwise(short)).drop(u, h, m, n, f"{n}2", f"{n}4")


def anchor_places(df: DataFrame, text: str = "text") -> DataFrame:
    """(all columns, places): the anchors with the unit at which each begins, array<struct<unit, hash>>, for matching."""
    return with_anchors(df, text, "places", places=True)


def likeness(a: str, b: str) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def written(anchors: str) -> Column:
    return F.array_join(F.transform(anchors, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


LEAST = -(2**63)


def cuts(at: list[int]) -> list[tuple[int, int]]:
    """Bounds (key, tie) of ranges from keys at equal ranks. A key that comes c times is cut into c ranges by its ties."""
    out = []
    for k in sorted(set(at)):
        c = at.count(k)
        out += [(k, LEAST + j * (2**64 // c)) for j in range(c)]
    return out


def range_of(bounds: list[tuple[int, int]]) -> Column:
    """How many of the sorted bounds are at most a row's (key, tie), from 0. Few keys have more than one bound."""
    keys = F.array(*(F.lit(k) for k, _ in bounds)).cast("array<bigint>")
    place = F.size(F.filter(keys, lambda b: b <= F.col("key")))
    for k in sorted({k for k, t in bounds if t != LEAST}):
        ties = F.array(*(F.lit(t) for b, t in bounds if b == k)).cast("array<bigint>")
        place -= F.when(F.col("key") == k, F.size(F.filter(ties, lambda t: t > F.col("tie")))).otherwise(0)
    return place - 1


def in_ranges(docs: DataFrame, ranges: int) -> DataFrame:
    """(doc_id, text, tie, range, guest): every row in the range of its id, and each range's first rows, once more, as
    guests of the range before (the first range's: of the last), to be ordered after that range's own."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), common.text_of(docs).alias("text"))
    key = F.coalesce("doc_id", F.lit(LEAST))
    steps = [i / ranges for i in range(ranges)]
    found = rows.agg(F.percentile_approx(key, steps, 20 * ranges).alias("at"), F.min(key).alias("least")).first()
    bounds = cuts([found["least"], *found["at"][1:]]) if found["at"] else [(0, LEAST)]
    rows = rows.withColumn("key", key).withColumn("tie", F.xxhash64("text"))
    shared = sorted({k for k, t in bounds if t != LEAST})
    if shared:
        # Of the ranges that ties cut, those with rows count, each from its first row on: one row for each range.
        some = rows.filter(F.col("key").isin(*shared)).groupBy(range_of(bounds).alias("r")).agg(F.min(F.struct("key", "tie")).alias("f"))
        firsts = {(r["f"]["key"], r["f"]["tie"]) for r in some.collect()}
        bounds = sorted({(k, t) for k, t in bounds if k not in shared} | firsts)
    rows = rows.withColumn("range", range_of(bounds))
    opens = F.array_contains(F.array(*(F.lit(k) for k, _ in bounds if k not in shared)).cast("array<bigint>"), F.col("key"))
    for k in shared:
        opens |= (F.col("key") == k) & F.col("tie").isin(*(t for b, t in bounds if b == k))
    used = len(bounds)
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.pmod(F.col("range") - 1, F.lit(used)).alias("range"), F.lit(True).alias("guest"))
    places = F.when(opens, F.array(own, guest)).otherwise(F.array(own))
    rows = rows.select("doc_id", "text", "tie", "key", F.explode(places).alias("p"))
    return rows.select("doc_id", "text", "tie", "key", "p.range", "p.guest")


def with_neighbours(docs: DataFrame, ranges: int) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fp, edited, following): anchors of each text, of its edited text and of the next text."""
    order = W.Window.partitionBy("range").orderBy("guest", "key", "tie")
    rows = in_ranges(docs, ranges).withColumn("following_text", F.lead("text").over(order))
    n = F.length("text")
    q = F.floor(n / 4).cast("int")
    edited = F.when(F.col("guest"), F.lit("")).otherwise(F.concat(F.substring("text", F.lit(1), n - q), F.substring(F.coalesce("following_text", F.lit("")), F.lit(1), q)))
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited_text", edited).drop("following_text")
    rows = with_anchors(with_anchors(rows, "text", "fp"), "edited_text", "edited")
    # What is written is what is compared.
    low = lambda c: F.transform(c, lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF)))
    rows = rows.withColumn("fp", low("fp")).withColumn("edited", low("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited_text").cast("binary"), 256)).drop("text", "edited_text")
    return rows.withColumn("following", F.lead("fp").over(order)).filter(~F.col("guest"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: fingerprints of all ``documents`` and of their edited texts."""
    rows = with_neighbours(spark.read.parquet(f"{sf_dir}/documents.parquet"), RANGES * common.partitions(spark))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", written("fp").alias("fingerprint"), written("edited").alias("edited_fingerprint"),
        likeness("fp", "edited").alias("near_edited"), likeness("fp", "following").alias("near_next"),
    )
