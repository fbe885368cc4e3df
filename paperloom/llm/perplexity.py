"""Quality classifier by an interpolated modified Kneser-Ney n-gram model (operator 6).

The model is of characters, order ``ORDER``: it needs no word list, so one model serves all languages and any script. It
is trained on trusted texts (``labels`` with quality 1 and not toxic), whole; one in ``HELD_OUT`` of them, by a hash of
their ids, is held out, so that thresholds come from texts that the model hasn't seen. Counts are summed within each task,
then by n-gram over all shards. Lower orders use continuation counts; each order has its three discounts from its counts
of counts. Every n-gram that any document holds gets its interpolated probability from joins of the count tables, order
by order.

Texts are never shuffled, but for the trusted ones that training needs, and no task reads the whole model. Each task that
reads documents tells its distinct n-grams with its number (split); these rows join the probabilities once, and are
written by split, so the task that scores the same documents reads a table of just its own n-grams. Were the documents
dealt differently the second time, n-grams that a task's table lacks would come from the sorted shards of all
probabilities: that is slower, with the same result.

A document's score is its perplexity for each character, less an allowance for short texts, whose mean surprisal strays
by some nats over the root of their length: perplexity * exp(-``SHORT`` / sqrt(n_chars)). It is kept if its score is at most
the ``QUANTILE`` of held-out documents' scores in its language; languages with fewer than ``LEAST_HELD`` held-out documents
use the quantile over all of them.

Defined results: null and empty texts have null perplexity and aren't kept; without any trusted text all perplexities
are those of the empty model (null) and nothing is kept; null is a language of its own; rows of equal ids are scored each
on their own, and trusted if their id is; a very long text is scored in runs that are summed; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import common
from paperloom.llm.ngram_join import bitmap, cell, marked

ORDER = 5
QUANTILE = 0.99
SHORT = 1.5
HELD_OUT = 4
LEAST_HELD = 20
RUN_CHARS = 1_000_000
#: Distinct n-grams that a task counts before it passes the counts on.
TOGETHER = 2_000_000
#: Splits whose tables share a folder.
PER_FOLDER = 64
#: Stands before a text; a control character that ends a heading in no format.
PAD = "\x02"


def _keys(points):
    """64-bit keys of the ORDER-grams that end at each of ``points`` but the first ORDER - 1."""
    import numpy as np

    n = len(points) - ORDER + 1
    x = np.zeros(n, dtype=np.uint64)
    for i in range(ORDER):
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x += points[i : i + n]
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x.view(np.int64)


def _runs(batches):
    """(rows, points, of): runs of texts as one array of code points, each text behind ORDER - 1 pads. ``of`` has the row
    of each n-gram, -1 for those that span two texts. A very long text is spread over several runs."""
    import numpy as np

    pads = np.full(ORDER - 1, ord(PAD), dtype=np.uint32)
    rows, parts, of, held = [], [], [], 0

    def done():
        return rows, np.concatenate(parts), np.concatenate(of)[ORDER - 1 :]

    for b in batches:
        names = [n for n in b.schema.names if n != "text"]
        columns = [b.column(n).to_pylist() for n in names]
        for i, t in enumerate(b.column("text")):
            text = t.as_py() or ""
            points = np.concatenate([pads, np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")])
            row = tuple(c[i] for c in columns)
            at = 0
            while True:
                piece = points[at : at + RUN_CHARS + ORDER - 1]
                mark = np.full(len(piece), len(rows), dtype=np.int64)
                mark[: ORDER - 1] = -1
                rows.append(row)
                parts.append(piece)
                of.append(mark)
                held += len(piece)
                at += RUN_CHARS
                if held >= RUN_CHARS:
                    yield done()
                    rows, parts, of, held = [], [], [], 0
                if at + ORDER - 1 >= len(points):
                    break
    if rows:
        yield done()


def grams(docs: DataFrame) -> DataFrame:
    """(split, key, gram, n): n-grams of ``docs`` (text), counted within each task, whose number is ``split``."""
    import pyarrow as pa

    schema = pa.schema([("split", pa.int32()), ("key", pa.int64()), ("gram", pa.string()), ("n", pa.int64())])

    def run(batches):
        import numpy as np
        from pyspark import TaskContext

        split = TaskContext.get().partitionId()

        def batch(keys, points, counts):
            text = points.tobytes().decode("utf-32-le", "surrogatepass")
            words = [text[i : i + ORDER] for i in range(0, len(text), ORDER)]
            splits = np.full(len(keys), split, dtype=np.int32)
            return pa.RecordBatch.from_arrays([pa.array(splits), pa.array(keys), pa.array(words, pa.string()), pa.array(counts)], schema=schema)

        def some(keys, points, counts):
            for i in range(0, len(keys), 100_000):
                yield batch(keys[i : i + 100_000], points[i : i + 100_000], counts[i : i + 100_000])

        keys, points, counts = np.empty(0, np.int64), np.empty((0, ORDER), np.uint32), np.empty(0, np.int64)
        for _, p, of in _runs(batches):
            k = _keys(p)
            at = np.flatnonzero(of >= 0)
            order = at[np.argsort(k[at])]
            s = k[order]
            if not len(s):
                continue
            first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
            own, n = s[first], np.diff(np.append(first, len(s)))
            place = np.searchsorted(keys, own)
            known = np.zeros(len(own), dtype=bool)
            inside = place < len(keys)
            known[inside] = keys[place[inside]] == own[inside]
            counts[place[known]] += n[known]
            new = ~known
            if new.any():
                start = order[first[new]]
                keys = np.insert(keys, place[new], own[new])
                counts = np.insert(counts, place[new], n[new])
                points = np.insert(points, place[new], p[start[:, None] + np.arange(ORDER)], axis=0)
            if len(keys) > TOGETHER:
                yield from some(keys, points, counts)
                keys, points, counts = keys[:0], points[:0], counts[:0]
        yield from some(keys, points, counts)

    return docs.select(docs["text"].cast("string").alias("text")).mapInArrow(common.task(run), "split int, key long, gram string, n long")


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """D1, D2 and D3+ of modified Kneser-Ney from the counts of counts of one order."""
    r = counts.agg(*(F.count_if(F.col("c") == i).alias(f"n{i}") for i in range(1, 5))).first()
    n1, n2, n3, n4 = (r[f"n{i}"] for i in range(1, 5))
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2 - 3 * y * n3 / n2)
    return tuple(min(max(x, 0.05), i + 0.95) for i, x in enumerate(d))


def probabilities(spark: SparkSession, counts: DataFrame, wanted: DataFrame, work: str) -> DataFrame:
    """(key, logp) of the n-grams ``wanted`` (key, gram) by the model of ``counts`` (gram, c)."""
    tables = {ORDER: common.cut(spark, counts, f"{work}/count{ORDER}")}
    for k in range(ORDER - 1, 0, -1):
        shorter = tables[k + 1].groupBy(F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("c"))
        tables[k] = common.cut(spark, shorter, f"{work}/count{k}")
    asked = {ORDER: wanted.select("gram").distinct()}
    for k in range(ORDER - 1, 0, -1):
        asked[k] = asked[k + 1].select(F.substring("gram", 2, k).alias("gram")).distinct()
    p = None
    for k in range(1, ORDER + 1):
        d = discounts(tables[k])
        off = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        contexts = tables[k].groupBy(F.substring("gram", 1, k - 1).alias("context") if k > 1 else F.lit("").alias("context")).agg(F.sum("c").alias("total"), F.sum(F.least(off, F.col("c"))).alias("left"), F.count("*").alias("kinds"))
        rows = asked[k].withColumn("context", F.substring("gram", 1, k - 1) if k > 1 else F.lit("")).join(tables[k], "gram", "left").join(contexts, "context", "left")
        own = F.greatest(F.coalesce("c", F.lit(0)) - F.when(F.col("c").isNull(), 0.0).otherwise(off), F.lit(0.0)) / F.col("total")
        if k == 1:
            # What discounts free is spread over the known characters and one for all others.
            p = rows.select("gram", (own + F.col("left") / F.col("total") / (F.col("kinds") + 1)).alias("p"))
        else:
            lower = p.select(F.col("gram").alias("suffix"), F.col("p").alias("q"))
            rows = rows.withColumn("suffix", F.substring("gram", 2, k - 1)).join(lower, "suffix")
            p = rows.select("gram", F.when(F.col("total").isNull(), F.col("q")).otherwise(own + F.col("left") / F.col("total") * F.col("q")).alias("p"))
        p = common.cut(spark, p, f"{work}/p{k}")
        # Tables of lower orders have served.
        common.drop(spark, f"{work}/count{k}")
        common.drop(spark, f"{work}/p{k - 1}")
    return wanted.join(p, "gram").select("key", F.log("p").alias("logp"))


def by_split(spark: SparkSession, asked: DataFrame, table: DataFrame, path: str) -> None:
    """Write (split, key, logp) of each split's own n-grams, sorted, in folders of PER_FOLDER splits."""
    rows = asked.select("split", "key").join(table, "key").withColumn("folder", F.floor(F.col("split") / PER_FOLDER).cast("int"))
    rows = rows.repartitionByRange(common.partitions(spark), "split").sortWithinPartitions("folder", "split", "key")
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy("folder").parquet(path)


def _own_table(path: str, split: int):
    """(keys, logp), sorted, of one split; empty if there is none."""
    import numpy as np
    import pyarrow.parquet as pq
    from pyarrow import fs as pafs

    fs, base = common.open_fs(f"{path}/folder={split // PER_FOLDER}")
    if fs.get_file_info(base).type == pafs.FileType.NotFound:
        return np.empty(0, np.int64), np.empty(0, np.float64)
    t = pq.read_table(base, filesystem=fs, columns=["key", "logp"], filters=[("split", "=", split)], partitioning=None)
    keys, logp = t.column("key").to_numpy(), t.column("logp").to_numpy()
    order = np.argsort(keys, kind="stable")
    return keys[order], logp[order]


def _look_up(s, keys, logp, found) -> None:
    """Put into ``found`` the values of those of the sorted keys ``s`` that a sorted table has."""
    import numpy as np

    if len(keys) and len(s):
        a, b = np.searchsorted(s, keys[0]), np.searchsorted(s, keys[-1], side="right")
        if a < b:
            place = np.searchsorted(keys, s[a:b])
            hit = keys[place] == s[a:b]
            found[a:b][hit] = logp[place[hit]]


def scores(spark: SparkSession, docs: DataFrame, path: str, own_path: str) -> DataFrame:
    """(doc_id, lang, n_chars, perplexity) of ``docs`` by the splits' tables at ``own_path``, else by the shards of
    (key, logp) at ``path``."""
    import pyarrow as pa

    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("row", pa.int64()), ("n", pa.int64()), ("sum", pa.float64())])

    def run(batches):
        import numpy as np
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs
        from pyspark import TaskContext

        split = TaskContext.get().partitionId()
        keys, logp = _own_table(own_path, split)
        row, last = (split << 40) - 1, object()
        for rows, p, of in _runs(batches):
            k = _keys(p)
            at = np.flatnonzero(of >= 0)
            order = at[np.argsort(k[at])]
            s, found = k[order], np.full(len(order), np.inf)
            _look_up(s, keys, logp, found)
            missing = np.flatnonzero(np.isinf(found))
            if len(missing):
                fs, base = common.open_fs(path)
                left, more = s[missing], np.full(len(missing), np.inf)
                for f in fs.get_file_info(pafs.FileSelector(base)):
                    if f.path.endswith(".parquet") and f.size:
                        t = pq.read_table(f.path, filesystem=fs)
                        _look_up(left, t.column("key").to_numpy(), t.column("logp").to_numpy(), more)
                found[missing] = more
            assert not np.isinf(found).any(), "an n-gram that the tables lack"
            total = np.bincount(of[order], weights=found, minlength=len(rows))
            count = np.bincount(of[order], minlength=len(rows))
            ids = []
            for r in rows:
                if r is not last:
                    row += 1
                last = r
                ids.append(row)
            columns = (pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array(ids, pa.int64()))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(count, pa.int64()), pa.array(total, pa.float64())], schema=schema)

    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["lang"].cast("string").alias("lang"), docs["text"].cast("string").alias("text"))
    parts = own.mapInArrow(common.task(run), "doc_id long, lang string, row long, n long, sum double")
    # A very long text has a row for each run that held a part of it.
    whole = parts.groupBy("doc_id", "lang", "row").agg(F.sum("n").alias("n_chars"), F.sum("sum").alias("sum"))
    mean = F.when((F.col("n_chars") > 0) & ~F.isnan("sum"), F.exp(-F.col("sum") / F.col("n_chars")))
    return whole.select("doc_id", "lang", "n_chars", mean.alias("perplexity"))


def trusted_texts(spark: SparkSession, docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(text) of documents whose id is in ``trusted`` (doc_id); a bitmap of bounded size keeps most others from moving."""
    bits = bitmap(spark, trusted, "doc_id")

    @F.pandas_udf("boolean")
    def perhaps(cells: pd.Series) -> pd.Series:
        return pd.Series(marked(bits.value, cells.to_numpy()))

    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    return own.filter(perhaps(cell("doc_id"))).join(trusted, "doc_id", "left_semi")


def trusted_ids(trusted: DataFrame) -> DataFrame:
    return trusted.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct()


def classify(spark: SparkSession, docs: DataFrame, trusted: DataFrame, work: str, quantile: float = QUANTILE) -> DataFrame:
    """(doc_id, lang, n_chars, perplexity, score, threshold, kept) of every row of ``docs``."""
    trusted_rows, trusted = trusted, common.cut(spark, trusted_ids(trusted), f"{work}/trusted")
    held = F.pmod(F.xxhash64(F.lit("held out"), "doc_id"), F.lit(HELD_OUT)) == 0
    counts = grams(trusted_texts(spark, docs, trusted.filter(~held))).groupBy("gram").agg(F.sum("n").alias("c"))
    counts = common.cut(spark, counts, f"{work}/counts")
    # The same columns as in scores(), so that the documents are dealt to tasks in the same way.
    texts = docs.select("doc_id", "lang", "text")
    asked = common.cut(spark, grams(texts).select("split", "key", "gram"), f"{work}/asked", "zstd")
    wanted = common.cut(spark, asked.select("key", "gram").distinct(), f"{work}/wanted")
    table = probabilities(spark, counts, wanted, work)
    table = table.repartitionByRange(max(1, common.partitions(spark) // 8), "key").sortWithinPartitions("key")
    table = common.cut(spark, table, f"{work}/logp")
    for done in (f"p{ORDER}", "wanted", "counts"):
        common.drop(spark, f"{work}/{done}")
    by_split(spark, asked, table, f"{work}/own")
    rows = common.cut(spark, scores(spark, texts, f"{work}/logp", f"{work}/own"), common.work_dir(spark, "perplexity-scores"))
    common.drop(spark, work)
    trusted = trusted_ids(trusted_rows)
    rows = rows.withColumn("score", F.col("perplexity") * F.exp(-SHORT / F.sqrt("n_chars")))
    known = rows.join(trusted.filter(held), "doc_id", "left_semi").filter("score is not null")
    most = lambda: F.percentile_approx("score", F.lit(quantile), F.lit(100_000))
    by_lang = known.groupBy(F.col("lang").alias("of")).agg(F.when(F.count("*") >= LEAST_HELD, most()).alias("own"))
    overall = known.agg(most().alias("t")).first()["t"]
    out = rows.join(by_lang, F.col("lang").eqNullSafe(F.col("of")), "left")
    threshold = F.coalesce("own", F.lit(overall).cast("double"))
    return out.select("doc_id", "lang", "n_chars", "perplexity", "score", threshold.alias("threshold"), F.coalesce(F.col("score") <= threshold, F.lit(False)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: perplexity and verdict of all ``documents``; ``labels`` name the trusted ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1 and toxic = 0")
    return classify(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), labels.select("doc_id"), common.work_dir(spark, "perplexity"))
