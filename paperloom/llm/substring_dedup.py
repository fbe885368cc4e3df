"""Substring dedup by hashed lines and parts of lines (operator 5).

A line is a unit; a line of more than ``PART`` words is cut into parts before words whose pair hash is the least among
``REACH`` pairs to either side within the line. Such cuts depend on nearby words only, so a passage that stands in
other surroundings, or in a line with edits, is cut the same way but for its ends. Units are normalised (A-Z in lower
case, white space as one separator), and their 128-bit digests are grouped over all documents. The occurrence of lowest rank
(document id, then row, then place) stays and every other goes. What goes is told by its offsets in the original text, in
code points. A part of a line of less than ``SHORT`` words says too little by itself ("The", before a cut): its digest takes
in the neighbours within its line, so it goes with the passage it belongs to.

Thresholds are options: ``least`` spares whole lines of fewer words (their digests then take in the lines before and
behind, so lists and verse are still found as other passages are), and ``run_words`` parts of lines that don't lie in a run
of so many repeated words of one document. With ``least=3, run_words=24`` a passage of over 50 words in lines of its own
still goes; within longer lines about one passage of 51 words in a hundred has no run left.

Digests are counted before they are shuffled and joined back only where they repeat, so a line that a third of all
documents share costs one row for each task and an even split of its occurrences.

Defined results: null and empty texts have no units; a very long text gives as many units as others of its length
together; rows of an equal id or without one are rows of their own, ranked by their hashes (null ids first), and lose only
what repeats in themselves or another row; wholly equal rows are one after another, so all but the first lose their units;
an empty table gives an empty result; other columns are ignored (``removed`` passes them through, and a column of the name
``removed_spans`` gives way to its own).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from paperloom.llm import common

PART = 16
REACH = 4
LEAST = 1
SHORT = 3
RUN_WORDS = 1
WORDS = 200_000
LONGEST = 256
BEHIND = 0x94D049BB133111EB

UNITS = "doc_id long, unit int, start int, end int, words int, line boolean, d1 long, d2 long, row long, head int, parts int"


def _mixers():
    import numpy as np

    rng = np.random.default_rng(7_919)
    return [rng.integers(1, 2**63, LONGEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]


def _turned(d):
    """Digests as their neighbours take them in."""
    d = d ^ (d >> type(d[0])(29))
    return d * type(d[0])(0xBF58476D1CE4E5B9)


class Units:
    """Units of a text, as arrays: (start, end, words, is a whole line, two halves of the digest, first unit of its line,
    units of its line)."""

    def __init__(self, least: int = LEAST):
        import numpy as np
        import xxhash

        self.least = least
        self.np, self.hash, self.memo, self.mixers = np, xxhash.xxh3_64_intdigest, {}, _mixers()
        self.space = np.zeros(256, dtype=bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True

    def __call__(self, text: str | None):
        np, memo = self.np, self.memo
        zero = np.uint64(0)
        raw = (text or "").encode("utf-8", "surrogatepass").lower()
        words = raw.split()
        if not words:
            return None
        new = set(words).difference(memo)
        if new:
            if len(memo) + len(new) > WORDS:
                memo.clear()
                new = set(words)
            memo.update((w, self.hash(w)) for w in new)
        h = np.array(list(map(memo.__getitem__, words)), dtype=np.uint64)
        b = np.frombuffer(raw, np.uint8)
        shown = ~self.space[b]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], shown, [False]]).astype(np.int8)))
        first, last = edge[0::2], edge[1::2]
        if len(raw) == len(text):
            a, z = first, last
        else:
            at = np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80)])
            a, z = at[first], at[last]
        line = np.concatenate([[0], np.cumsum(b == 10)])[first]
        n = len(words)
        new_line = np.concatenate([[True], line[1:] != line[:-1]])
        start_of = np.flatnonzero(new_line)
        length = np.diff(np.append(start_of, n))
        long_line = np.repeat(length > PART, length)
        pair = h.copy()
        pair[1:] ^= h[:-1] * np.uint64(0x9E3779B97F4A7C15)
        pair ^= pair >> np.uint64(32)
        pair *= np.uint64(0xD6E8FEB86659FD93)
        cut = long_line & ~new_line
        for d in range(1, REACH + 1):
            if d >= n:
                break
            apart = line[d:] != line[:-d]
            # A line's first word has no pair within the line, so it isn't held against.
            cut[d:] &= (pair[d:] < pair[:-d]) | apart | new_line[:-d]
            cut[:-d] &= (pair[:-d] < pair[d:]) | apart
        begins = np.flatnonzero(new_line | cut)
        size = np.diff(np.append(begins, n))
        place = np.arange(n) - np.repeat(begins, size)
        step, turn = place % LONGEST, (place // LONGEST).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (h ^ (h >> np.uint64(31))) + turn
        d1, d2 = (np.add.reduceat(x * m[step], begins) + size.astype(np.uint64) for m in self.mixers)
        ends = np.append(begins[1:], n) - 1
        opens = new_line[begins]
        closes = np.append(opens[1:], True)
        whole = opens & closes
        short = size < np.where(whole, self.least, max(self.least, SHORT))
        if short.any():
            # Of the neighbours within the line, or around a whole short line.
            before, behind = short & (whole | ~opens), short & (whole | ~closes)
            d1, d2 = (d + np.where(before, _turned(np.append(zero, d[:-1])), zero) + np.where(behind, _turned(np.append(d[1:], zero)) * BEHIND, zero) for d in (d1, d2))
        heads = np.flatnonzero(opens)
        parts = np.diff(np.append(heads, len(begins)))
        return a[begins], z[ends], size, whole, d1, d2, np.repeat(heads, parts), np.repeat(parts, parts)


def units(docs: DataFrame, row: Column, least: int = LEAST) -> DataFrame:
    """UNITS of every row of ``docs``; ``row`` is a number that no other row has, also where ids repeat or are null."""
    import pyarrow as pa

    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int32()) for c in ("unit", "start", "end", "words")), ("line", pa.bool_()), ("d1", pa.int64()), ("d2", pa.int64()), ("row", pa.int64()), ("head", pa.int32()), ("parts", pa.int32())])

    def run(batches):
        import numpy as np

        cut = Units(least)
        for b in batches:
            for i in range(0, b.num_rows, 500):
                some = b.slice(i, 500)
                found = [(k, r, u) for k, r, t in zip(some.column("doc_id").to_pylist(), some.column("row").to_pylist(), some.column("text")) if (u := cut(t.as_py()))]
                if not found:
                    continue
                each = pa.array(np.repeat(np.arange(len(found)), [len(u[0]) for _, _, u in found]))
                ids, row = (pa.array([f[c] for f in found], pa.int64()).take(each) for c in range(2))
                start, end, size, whole, d1, d2, head, parts = (np.concatenate([u[c] for _, _, u in found]) for c in range(8))
                unit = np.concatenate([np.arange(len(u[0])) for _, _, u in found])
                whole, d1, d2 = pa.array(whole), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(x.astype(np.int32)) for x in (unit, start, end, size)), whole, d1, d2, row, *(pa.array(x.astype(np.int32)) for x in (head, parts))], schema=schema)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), row.alias("row")).mapInArrow(common.task(run), UNITS)


def gone(found: DataFrame, lines: bool, least: int, run_words: int) -> DataFrame:
    """UNITS that go, with ``kept``, the occurrence that stays (doc_id, row, unit), of the written UNITS ``found``."""
    # Digests that occur once are most of them: they are counted on 16 bytes each, and only others' units move again.
    rank = F.struct("doc_id", "row", "unit")
    first = found.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min(rank).alias("kept")).filter("n > 1")
    again = found.join(first.drop("n"), ["d1", "d2"]).filter(rank != F.col("kept"))
    if run_words <= 1 and least <= 1:
        return again
    # Runs of repeated units of one row; one other unit between two of them doesn't end a run.
    of = W.Window.partitionBy("row").orderBy("head", "unit")
    apart = F.coalesce(F.col("unit") - F.lag("unit").over(of) > 2, F.lit(True))
    again = again.withColumn("opens", apart.cast("int"))
    again = again.withColumn("run", F.sum("opens").over(of.rowsBetween(W.Window.unboundedPreceding, 0)))
    again = again.withColumn("run_words", F.sum("words").over(W.Window.partitionBy("row", "run")))
    goes = F.col("run_words") >= run_words
    if lines:
        # A line of several parts has more than PART words; it repeats if all its parts do.
        again = again.withColumn("found_parts", F.count("*").over(W.Window.partitionBy("row", "head")))
        goes |= (F.col("found_parts") == F.col("parts")) & (~F.col("line") | (F.col("words") >= least))
    return again.filter(goes)


def repeats(
    spark: SparkSession, docs: DataFrame, work: str, lines: bool = True, least: int = LEAST, run_words: int = RUN_WORDS
) -> DataFrame:
    """Every occurrence that goes: doc_id, unit, start, end, words, line, and what stays (kept_doc_id, kept_unit)."""
    found = common.cut(spark, units(docs, F.monotonically_increasing_id(), least), f"{work}/units")
    out = gone(found, lines, least, run_words)
    kept = (F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.unit").alias("kept_unit"))
    return out.select("doc_id", "unit", "start", "end", "words", "line", *kept)


def removed(
    spark: SparkSession, docs: DataFrame, work: str, lines: bool = True, least: int = LEAST, run_words: int = RUN_WORDS
) -> DataFrame:
    """``docs`` without the repeats, and ``removed_spans``: the offsets of what went, array<struct<start, end>>.

    Rows are numbered in a written copy, so spans go back to their own row, whatever ids repeat or are null.
    """
    # Other columns travel in a struct, so that no name can clash.
    others = F.struct(F.lit(0).alias("_none"), *(docs[f"`{c}`"] for c in docs.columns if c not in ("text", "removed_spans")))
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text", others.alias("rest"), F.monotonically_increasing_id().alias("row"))
    own = common.cut(spark, own, f"{work}/rows")
    found = common.cut(spark, units(own, own["row"], least), f"{work}/units")
    spans = gone(found, lines, least, run_words).groupBy("row")
    spans = spans.agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    # Between and behind the spans; all pieces' places come from the spans, so no piece waits for another.
    empty = F.array().cast("array<struct<start:int,end:int>>")
    spans_of, n = F.col("spans"), F.size("spans")
    upto = lambda i: F.when(i == 0, 0).otherwise(F.get(spans_of, i - 1)["end"])
    before = F.transform(spans_of, lambda s, i: F.substring("text", upto(i) + 1, s["start"] - upto(i)))
    behind = F.substring("text", upto(n) + 1, F.length("text"))
    text = F.when(spans_of.isNull(), F.col("text")).otherwise(F.concat(F.array_join(before, ""), behind))
    out = own.join(spans, "row", "left")
    columns = [text.alias(c) if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns if c != "removed_spans"]
    return out.select(*columns, F.coalesce(spans_of, empty).alias("removed_spans"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: everything that substring dedup removes from ``documents``, by original offsets."""
    return repeats(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), common.work_dir(spark, "substring-dedup"))
