"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree (operator 3).

Each source's documents are put into a hash order and their words into one stream, which is cut into equal blocks. A
source's quota is the whole number of blocks that meets its target: whole passes over all blocks, then a last part. The
tree splits the output shards in two again and again and draws how many blocks of each source go left from a multivariate
hypergeometric law, so every shard gets a random mix while each source's quota is kept exactly. A node's draw is seeded by
its place, so any subtree can be drawn anew alone. The leaves number a source's draws shard by shard; in each pass a
seeded permutation of the source's blocks says which block a draw takes, so shards' blocks are disjoint and the last,
partial pass takes blocks from all over the source. A shard shuffles its blocks' documents locally by a hash (``place``).

Only sums for each source (the weights that a user gives are one for each source, too) and runs of draws (one for each
source, pass and shard) are made on the driver; the draws themselves are a table, which documents' pieces join by source
and block. Prefix sums over a source run in two levels of hash ranges (at most 2**``MOST_BITS``), so a source that holds a
third of all rows is spread over as many tasks as any other rows.

Defined results: null text has no words and is taken 0 words; null is a source of its own, the last; rows with equal or
null ids count each on their own; repeated rows and very long texts are pieces of as many blocks as they cover; an empty
table or one without words gives targets of 0; other columns are ignored (``mixed_documents`` passes them through,
whatever their names).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from paperloom.llm import common

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
CAP = 2
BLOCK_WORDS = 65_536
LEAST_BLOCKS = 1_024
#: Blocks of all sources together, beside LEAST_BLOCKS for each; beyond, blocks get larger.
MOST_BLOCKS = 1 << 28
RANGE_ROWS = 1_024
MOST_BITS = 20
SHARDS = 64
SEED = 20_111


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, percent: int = SHARE_PERCENT, cap: int = CAP) -> dict:
    """Target words of each source: shares by weight, none above cap times its size, the excess reshared by weight."""
    order = sorted(sizes, key=lambda s: (s[0] is None, (s[0] or "").encode("utf-8", "surrogatepass")))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size, left = dict(order), percent * sum(n for _, n in order) / 100
    out: dict = {}
    free = [s for s, _ in order]
    while free:
        total = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / total > cap * size[s]]
        if not above:
            out |= {s: left * weight[s] / total for s in free}
            break
        out |= {s: float(cap * size[s]) for s in above}
        left -= sum(cap * size[s] for s in above)
        free = [s for s in free if s not in set(above)]
    return out


def split(quotas: list[int], shards: int, seed: int = SEED) -> list[list[int]]:
    """How many blocks of each source each shard takes. Shards differ by a block at most; columns sum to the quotas."""
    import numpy as np

    out = [[0] * len(quotas) for _ in range(shards)]
    todo = [(0, shards, np.array(quotas, dtype=np.int64))]
    total = int(sum(quotas))
    upto = [total * k // shards for k in range(shards + 1)]
    while todo:
        a, b, q = todo.pop()
        if b - a == 1:
            out[a] = q.tolist()
            continue
        m = (a + b) // 2
        rng = np.random.default_rng([seed, a, b])
        left = rng.multivariate_hypergeometric(q, upto[m] - upto[a], method="marginals") if q.sum() else q * 0
        todo += [(a, m, left), (m, b, q - left)]
    return out


def runs(blocks: list[int], quotas: list[int], shards: int, seed: int = SEED) -> list[tuple]:
    """(source, pass, shard, lo, hi, factor, shift): draws [lo, hi) of a pass over a source's blocks go to a shard; draw i
    takes block (factor * i + shift) mod blocks. The factor shares no divisor with blocks, so each pass is a permutation."""
    import numpy as np

    out, ends = [], [0] * len(quotas)
    maps: dict[tuple[int, int], tuple[int, int]] = {}
    for shard, own in enumerate(split(quotas, shards, seed)):
        for s, n in enumerate(own):
            at, end, k = ends[s], ends[s] + n, blocks[s]
            ends[s] = end
            while at < end:
                p = at // k
                upto = min(end, (p + 1) * k)
                if (s, p) not in maps:
                    rng = np.random.default_rng([seed, s, p])
                    factor = next(f for f in iter(lambda: int(rng.integers(1, k + 1)), 0) if math.gcd(f, k) == 1)
                    maps[s, p] = factor, int(rng.integers(0, k))
                out.append((s, p, shard, at - p * k, upto - p * k, *maps[s, p]))
                at = upto
    return out


def drawn(spark: SparkSession, blocks: list[int], quotas: list[int], shards: int) -> DataFrame:
    """(no, pass, block, shard): which shard takes a block of source ``no`` in a pass."""
    rows = [(*r, blocks[r[0]]) for r in runs(blocks, quotas, shards)]
    names = "no int, pass int, shard int, lo long, hi long, factor long, shift long, blocks long"
    each = spark.createDataFrame(rows, names).withColumn("i", F.explode(F.sequence("lo", F.col("hi") - 1)))
    # Below 2**28 blocks and a source's least, products fit 64 bits.
    block = F.pmod(F.col("factor") * F.col("i") + F.col("shift"), F.col("blocks"))
    return each.select("no", "pass", block.alias("block"), "shard")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words of each whole text."""
    size = F.regexp_count(common.text_of(docs), F.lit(common.WORD)).cast("long")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"), size.alias("size"))


def streamed(rows: DataFrame, n_rows: int) -> DataFrame:
    """Adds ``start``: the words of its source before a document in the source's hash order. ``rows`` has a stable uid."""
    bits = min(MOST_BITS, max(0, math.ceil(math.log2(max(1, n_rows / RANGE_ROWS)))))
    key = F.xxhash64(F.lit(SEED), F.coalesce("doc_id", "uid"), "source", "size")
    part = F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")
    rows = rows.withColumn("h", key).withColumn("part", part)
    sums = rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
    before = W.Window.partitionBy("source").orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("words").over(before), F.lit(0))
    sums = sums.select(F.col("source").alias("s"), F.col("part").alias("p"), base.alias("base"))
    within = W.Window.partitionBy("source", "part").orderBy("h", "uid").rowsBetween(W.Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    met = rows.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    return met.withColumn("start", F.col("base") + F.col("inner")).drop("s", "p", "base", "inner", "part")


def mix(
    spark: SparkSession, docs: DataFrame, work: str, shards: int | None = None, whole: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces).

    documents: uid, doc_id, source, size, source_size, target. pieces: uid, pass, block, shard, place and the words
    [from_word, to_word) of the document that this piece holds. Blocks may cut documents, so a source's words meet its
    target to within half a block; with ``whole`` a document belongs to the block of its first word and stays whole.
    """
    shards = shards or common.partitions(spark)
    rows = common.cut(spark, sized(docs).withColumn("uid", F.monotonically_increasing_id()), f"{work}/sizes")
    sums = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("n")).collect()
    totals = [(r["source"], r["words"], r["n"]) for r in sums]
    totals.sort(key=lambda s: (s[0] is None, (s[0] or "").encode("utf-8", "surrogatepass")))
    goal = targets([(s, w) for s, w, _ in totals])
    block_words = max(BLOCK_WORDS, -(-sum(w for _, w, _ in totals) // MOST_BLOCKS))
    blocks = [max(1, min(w, max(LEAST_BLOCKS, -(-w // block_words)))) for _, w, _ in totals]
    quotas = [round(k * goal[s] / w) if w else 0 for (s, w, _), k in zip(totals, blocks)]
    sources = spark.createDataFrame(
        [(i, s, w, float(goal[s]), k) for i, ((s, w, _), k) in enumerate(zip(totals, blocks))],
        "no int, s string, source_size long, target double, blocks long",
    )
    n_rows = sum(n for *_, n in totals)
    placed = streamed(rows, n_rows).join(sources, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    documents = placed.select("uid", "doc_id", "source", "size", "source_size", "target")
    # Block k of a source holds the words from k * source_size div blocks up to the next block's first, so word x is in
    # block ((x + 1) * blocks - 1) div source_size. Decimals keep the products exact at any size.
    big = lambda c: F.col(c).cast("decimal(19,0)") if isinstance(c, str) else c.cast("decimal(19,0)")
    div = lambda a, b: F.call_function("div", a, b).cast("long")
    inside = lambda word: div((big(word) + 1) * big("blocks") - 1, big("source_size"))
    block_of = lambda word: F.greatest(F.lit(0), F.least(F.col("blocks") - 1, inside(word)))
    edge = lambda block: div(big(block) * big("source_size"), big("blocks"))
    some = placed.filter("source_size > 0")
    some = some if whole else some.filter("size > 0")
    some = some.withColumn("first", block_of(F.col("start")))
    some = some.withColumn("last", F.col("first") if whole else block_of(F.col("start") + F.col("size") - 1))
    some = some.withColumn("block", F.explode(F.sequence("first", "last")))
    some = some.join(drawn(spark, blocks, quotas, shards), ["no", "block"])
    from_word = F.lit(0).cast("long") if whole else F.greatest(F.col("start"), edge(F.col("block"))) - F.col("start")
    to_word = F.col("size") if whole else F.least(F.col("start") + F.col("size"), edge(F.col("block") + 1)) - F.col("start")
    pieces = some.select(
        "uid", "doc_id", "source", "pass", "block", "shard",
        F.xxhash64(F.lit(SEED), "h", "uid", "pass", "block").alias("place"),
        from_word.alias("from_word"), to_word.alias("to_word"),
    )
    return documents, pieces


def taken(documents: DataFrame, pieces: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, shards) of every document; ``shards`` lists shard:words."""
    words = pieces.groupBy("uid", "shard").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("words"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("shard", "words"))), lambda x: F.concat_ws(":", x["shard"], x["words"]))
    words = words.groupBy("uid").agg(F.sum("words").alias("words"), F.array_join(listed, ",").alias("shards"))
    columns = ("doc_id", "source", "size", "source_size", "target")
    none = F.lit(0).cast("long")
    out = documents.join(words, "uid", "left")
    return out.select(*columns, F.coalesce("words", none).alias("taken"), F.coalesce("shards", F.lit("")).alias("shards"))


def mixed_documents(spark: SparkSession, docs: DataFrame, work: str) -> DataFrame:
    """The mix as documents, whole and as often as it takes them, dealt to its shards in their shuffled order.

    Columns are those of ``docs``. Texts move once: rows are numbered as they are read, from one written copy.
    """
    shards = common.partitions(spark)
    # Other columns travel in a struct, so that no name can clash.
    others = F.struct(F.lit(0).alias("_none"), *(docs[f"`{c}`"] for c in docs.columns if c != "text"))
    own = docs.select(F.monotonically_increasing_id().alias("row"), "text", docs["source"].cast("string").alias("source"), others.alias("rest"))
    own = common.cut(spark, own, f"{work}/rows", "zstd")
    _, pieces = mix(spark, own.select(F.col("row").alias("doc_id"), "text", "source"), work, shards, whole=True)
    chosen = pieces.select(F.col("doc_id").alias("row"), "shard", "place")
    out = own.drop("source").join(chosen, "row").repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "place")
    return out.select(*(F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: what the mix takes of each of all ``documents``."""
    work = common.work_dir(spark, "mixing")
    return taken(*mix(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), work, SHARDS))
