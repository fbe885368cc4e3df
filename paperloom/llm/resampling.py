"""Target-distribution importance resampling over hashed word n-grams (operator 11).

Documents are resampled towards a target corpus without being compared with it one by one: both corpora are counted in
``BUCKETS`` buckets of hashed n-grams, a bucket's gain is the scaled logarithm of how much more frequent it is in the
target, and a document's weight is the sum of gains over its n-grams. Gumbel noise from a hash of the id turns the top
of the scores into a draw without replacement, in proportion to the weights' exponentials.

Scoring is free of explodes: higher-order functions make a document's array of buckets, and an aggregate over
``element_at`` of a literal array of gains sums it up, so a document stays one row and nothing of it is shuffled. What
shuffles are totals: at most ``BUCKETS`` rows a task, summed before. Words are found and hashed once: the arrays are
written (about two bytes a word) for the totals and the weights, and go when the scores are written, from which the
ranges are sampled and dealt. The draw takes the K best of all by ranges: scores
are written in ranges of (score, id), each range is numbered apart, and its first number comes from the counts of the
ranges before, so no task sees more than its range.

Defined results: a null text has no words, thus no n-grams and weight 0; a text of fewer words than an n-gram needs has
none of that length; very long texts are counted whole. Rows of equal ids are rows of their own with the same noise;
those of equal score and id follow one another in any order; a null id is hashed as an empty one and comes last among
equal scores. Without target texts all counts of the target are 0. An empty table gives an empty result. Other columns
are ignored by ``scores`` and pass through ``resampled``, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from paperloom.llm import common

BUCKETS = 10_000
PERCENT = 10
LEAST_WORDS = 20
SEED = 2024
#: Words: runs of ASCII digits, letters and anything beyond ASCII; only A-Z is put into lower case.
FEATURE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(FEATURE_WORD), F.lit(0))


def buckets(found: Column, longest: int = 1, n_buckets: int = BUCKETS) -> Column:
    """The bucket, from 1, of each run of 1 to ``longest`` words of the array ``found``."""
    place = lambda s: (F.crc32(s.cast("binary")) % n_buckets + 1).cast("int")
    each, run = [F.transform(found, place)], found
    for n in range(2, longest + 1):
        # Runs of n words are those of n - 1 with the word behind them: slices and zips take the array's length, once each.
        left = F.greatest(F.size(found) - (n - 1), F.lit(0))
        run = F.zip_with(F.slice(run, F.lit(1), left), F.slice(found, F.lit(n), left), lambda a, b: F.concat(a, F.lit(" "), b))
        each.append(F.transform(run, place))
    return each[0] if len(each) == 1 else F.concat(*each)


def hashed(docs: DataFrame, longest: int = 1, n_buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, own): each document's array of buckets."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), words(common.text_of(docs)).alias("found"))
    return rows.select("doc_id", F.size("found").cast("long").alias("n_words"), buckets(F.col("found"), longest, n_buckets).alias("own"))


def totals(own: DataFrame, n_buckets: int = BUCKETS) -> list[int]:
    """How many n-grams of all arrays ``own`` each bucket holds. At most ``n_buckets`` rows leave each task or reach the driver."""
    out = [0] * n_buckets
    for r in own.select(F.explode("own").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).collect():
        out[r["bucket"] - 1] = r["n"]
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln(p_target / p_source)) of each bucket, both smoothed by one."""
    k, s, t = len(source), sum(source), sum(target)
    return [math.floor(1000 * math.log(float(b + 1) * float(s + k) / (float(a + 1) * float(t + k)))) for a, b in zip(source, target)]


def literal(values: list[int]) -> Column:
    """An array that folds to one literal when the plan is made."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)) of a uniform u from the id's hash."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(told.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def scored(rows: DataFrame, gain: list[int], seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row of ``hashed``, by one pass without a shuffle."""
    weight = F.aggregate("own", F.lit(0).cast("long"), lambda sum, b: sum + F.element_at(literal(gain), b))
    rows = rows.select("doc_id", "n_words", F.size("own").cast("long").alias("n_features"), weight.alias("weight"))
    return rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def drawn(spark: SparkSession, rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``rows`` of (doc_id, n_words, score) with ``rank``, from 1, of the best ``percent`` of those with enough words."""
    enough = F.col("n_words") >= least_words
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # Rows that can't be drawn make a range of their own order: they come behind all others and are never numbered.
    behind = F.when(enough, F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("doc_id"), F.lit(1024)))
    parts = rows.withColumn("behind", behind).repartitionByRange(common.partitions(spark), "behind", *order)
    work = common.work_dir(spark, "resampling")
    parts = common.cut(spark, parts.sortWithinPartitions("behind", *order).withColumn("part", F.spark_partition_id()), f"{work}/ranges")
    # One row for each task of the write above.
    counts = {r["part"]: r["n"] for r in parts.filter("behind = 0").groupBy("part").agg(F.count("*").alias("n")).collect()}
    most, before, base = percent * sum(counts.values()) // 100, 0, {}
    for p in sorted(counts):
        if before < most:
            base[p] = before
        before += counts[p]
    first = F.element_at(F.from_json(F.lit("{" + ",".join(f'"{p}":{n}' for p, n in base.items()) + "}"), "map<string,bigint>"), F.col("part").cast("string"))
    some = parts.filter(F.col("part").isin(*base) & (F.col("behind") == 0))
    own = F.row_number().over(W.Window.partitionBy("part").orderBy(*order))
    some = some.withColumn("rank", first + own)
    some = some.withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    rest = parts.filter(~F.col("part").isin(*base) | (F.col("behind") > 0)).withColumn("rank", F.lit(None).cast("long"))
    return some.unionByName(rest).drop("behind", "part")


def scores(
    spark: SparkSession, docs: DataFrame, target: DataFrame, longest: int = 1, n_buckets: int = BUCKETS, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``docs`` by its likeness to ``target`` (text)."""
    work = common.work_dir(spark, "resampling")
    rows = common.cut(spark, hashed(docs, longest, n_buckets), f"{work}/buckets")
    wanted = target.select(buckets(words(common.text_of(target)), longest, n_buckets).alias("own"))
    told = common.cut(spark, scored(rows, gains(totals(rows, n_buckets), totals(wanted, n_buckets))), f"{work}/scores")
    common.drop(spark, f"{work}/buckets")
    return drawn(spark, told, percent)


def resampled(spark: SparkSession, docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns. The draw is by id: rows of an id that is drawn stay."""
    ranks = scores(spark, docs, target, percent=percent).filter("rank is not null").select(F.col("doc_id").alias("_drawn_id")).distinct()
    return docs.join(ranks, docs["doc_id"].cast("long").eqNullSafe(ranks["_drawn_id"]), "left_semi")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the best tenth of ``documents`` by noisy likeness to ``benchmark``; features are single words."""
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    out = scores(spark, docs.select("doc_id", "text"), target.select("text"))
    return out.select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))


#: crc32 is made of a table of 256 entries by its rule; each distinct word is hashed once.
SQL = f"""WITH RECURSIVE steps(i, k, v) AS (
  SELECT i, 0, CAST(i AS BIGINT) FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END FROM steps WHERE k < 8),
entries AS (SELECT list(v ORDER BY i) AS e FROM steps WHERE k = 8),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
vocabulary AS (SELECT DISTINCT unnest(w) AS word FROM (SELECT w FROM d UNION ALL SELECT w FROM b)),
bytes AS (SELECT word, hex(encode(word)) AS h FROM vocabulary),
crc AS (SELECT word, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(h), 2), lambda i: CAST('0x' || h[i:i + 1] AS BIGINT))),
  lambda c, x: xor(c >> 8, e[CAST((xor(c, x) & 255) + 1 AS BIGINT)]))) % {BUCKETS} AS bucket FROM bytes, entries),
dw AS (SELECT doc_id, unnest(w) AS word FROM d),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN crc USING (word) GROUP BY 1),
t AS (SELECT bucket, count(*) AS n FROM (SELECT unnest(w) AS word FROM b) JOIN crc USING (word) GROUP BY 1),
gain AS (SELECT k AS bucket, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * (coalesce((SELECT sum(n) FROM s), 0) + {BUCKETS})::DOUBLE
  / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * (coalesce((SELECT sum(n) FROM t), 0) + {BUCKETS})::DOUBLE))) AS BIGINT) AS g FROM range({BUCKETS}) r(k) LEFT JOIN s ON s.bucket = k LEFT JOIN t ON t.bucket = k),
weights AS (SELECT doc_id, CAST(sum(g) AS BIGINT) AS weight FROM dw JOIN crc USING (word) JOIN gain USING (bucket) GROUP BY 1),
scored AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('{SEED}:' || d.doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= {LEAST_WORDS})
SELECT s.doc_id, n_features, weight, score, CASE WHEN r <= {PERCENT} * n // 100 THEN r END AS rank FROM scored s LEFT JOIN ranked USING (doc_id)"""
