"""N-gram Jaccard join with set-relation skipping (operator 10).

Sets are the distinct word n-grams of whole texts, as 64-bit hashes. The join is exact: no link is lost and none is
guessed.

Index. n-grams are ordered by (frequent, hash), and each set lists its first |x| - ceil(t |x|) + 1 of them, of which
two linked sets share one. Lists hold (size, position) with each set. Lists are read in blocks sorted by size; an entry
is skipped against another if sizes or positions bound the overlap below the threshold, and a block ends where sizes
do. Lists of more than ``LIST`` sets are dealt to pairs of blocks, so no task holds a whole frequent list.

Answers from answers. Equal sets are one set. Each set is first held against the first set of its lists only (its hub);
a set that links to a hub takes over the hub's answers, and so on through components. Only entries that this leaves in
different components of a list are held against each other. A group of many near copies so costs a few checks a copy.

Checks. A parity bitmap of each set (1 to 4 bits an n-gram) bounds the symmetric difference of two sets from below, and
pairs over the limit are dropped. Pairs that are left are compared by their whole sets, made anew from the texts of
just these documents.

Defined results: null or empty texts and texts without words have an empty set and link with nothing; a text of fewer
than n words is one n-gram; each row counts on its own, also with an equal id; rows without id have a null component and
link nothing; very long texts are sets like others; an empty table gives an empty result; other columns are ignored
(``one_of_each`` passes them through, and judges each row by its own text, whatever ids repeat or are null).
64-bit hashes of n-grams may collide: within a pair of texts of 100,000 words that has a chance of one in a billion.
"""

from __future__ import annotations

import itertools

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import common
from paperloom.llm.graph import components

#: Lists that are longer than this count as frequent; at most FREQUENT n-grams do (8 bytes each are broadcast).
COMMON, FREQUENT = 16, 1 << 20
LIST = 8_000
#: Entries that are held against one another at a time, besides those of one unfinished block.
TOGETHER = 20_000
WORDS = 200_000
#: Bits of the bitmap that tells which documents' sets are read again.
ID_BITS = 23


class Shingler:
    """Sorted distinct 64-bit hashes of the word n-grams of a text, A-Z in lower case."""

    def __init__(self, n: int):
        import numpy as np
        import xxhash

        self.n, self.np, self.hash, self.memo = n, np, xxhash.xxh3_64_intdigest, {}

    def __call__(self, text: str | None):
        np, memo = self.np, self.memo
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        if len(words) < self.n:
            return np.array([self.hash(b" ".join(words), seed=self.n)], dtype=np.uint64)
        new = set(words).difference(memo)
        if new:
            if len(memo) + len(new) > WORDS:
                memo.clear()
                new = set(words)
            memo.update((w, self.hash(w)) for w in new)
        h = np.array(list(map(memo.__getitem__, words)), dtype=np.uint64)
        k = len(h) - self.n + 1
        x = h[:k].copy()
        for i in range(1, self.n):
            x ^= x >> np.uint64(29)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            x += h[i : i + k]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(29)
        x.sort()
        return x[np.append(True, x[1:] != x[:-1])]


def prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1 if size else 0


def prefix(tokens, percent: int, frequent):
    """The first n-grams in the order of (frequent, hash)."""
    import numpy as np

    p = prefix_length(len(tokens), percent)
    if not len(frequent) or not p:
        return tokens[:p]

    def often(x):
        at = np.searchsorted(frequent, x)
        at[at == len(frequent)] = 0
        return frequent[at] == x

    some = tokens[: 3 * p]
    rare = some[~often(some)]
    if len(rare) < p:
        mark = often(tokens)
        rare = np.concatenate([tokens[~mark], tokens[mark]])
    return rare[:p]


def parities(tokens, percent: int) -> bytes:
    """Parity of the number of n-grams in each of b cells.

    b is the power of two from 20 to 40 times the differences that a linked pair may have for each of its n-grams: then
    few of these fall together, and pairs a few hundredths below the threshold are told apart.
    """
    import numpy as np

    least = 20 * len(tokens) * (100 - percent) // (100 + percent)
    b = max(64, 1 << max(0, least - 1).bit_length())
    cells = (tokens >> np.uint64(17)) & np.uint64(b - 1)
    return np.packbits((np.bincount(cells.astype(np.int64), minlength=b) & 1).astype(np.uint8), bitorder="little").tobytes()


def apart(x: int, bx: int, y: int, by: int) -> int:
    """Cells in which two bitmaps (of bx and by bits) differ, the larger folded to the smaller."""
    while bx > by:
        bx //= 2
        x = (x >> bx) ^ (x & ((1 << bx) - 1))
    while by > bx:
        by //= 2
        y = (y >> by) ^ (y & ((1 << by) - 1))
    return (x ^ y).bit_count()


def overlap_needed(total, percent: int):
    """Least intersection of two sets of ``total`` elements together."""
    return -(-percent * total // (100 + percent))


def features(docs: DataFrame, n: int, percent: int, frequent=None) -> DataFrame:
    """(doc_id, size, sig, tokens, bits) of each row; with ``frequent`` None only tokens, in the order of hashes."""
    import pyarrow as pa

    first = frequent is None
    schema = pa.schema([("tokens", pa.list_(pa.int64()))] if first else [("doc_id", pa.int64()), ("size", pa.int64()), ("sig", pa.binary()), ("tokens", pa.list_(pa.int64())), ("bits", pa.binary())])

    def run(batches):
        import numpy as np
        import xxhash

        shingle, often = Shingler(n), np.empty(0, dtype=np.uint64) if first else frequent.value
        for b in batches:
            for i in range(0, b.num_rows, 500):
                some = b.slice(i, 500)
                sets = [shingle(t.as_py()) for t in some.column("text")]
                lists = [prefix(s, percent, often) for s in sets]
                offsets = pa.array(np.cumsum([0, *map(len, lists)]), pa.int32())
                tokens = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(lists).view(np.int64)))
                if first:
                    yield pa.RecordBatch.from_arrays([tokens], schema=schema)
                    continue
                sigs = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(list(map(len, sets)), pa.int64()), pa.array(sigs, pa.binary()), tokens, pa.array([parities(s, percent) if len(s) else b"" for s in sets], pa.binary())], schema=schema)

    kind = "tokens array<long>" if first else "doc_id long, size long, sig binary, tokens array<long>, bits binary"
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(common.task(run), kind)


def close_enough(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose bitmaps allow a link. ``sets``: (node, size, bits)."""
    import pyarrow as pa

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            out_a, out_b = [], []
            for a, b, sa, sb, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "sa", "sb", "xa", "xb"))):
                if apart(int.from_bytes(x, "little"), 8 * len(x), int.from_bytes(y, "little"), 8 * len(y)) <= sa + sb - 2 * overlap_needed(sa + sb, percent):
                    out_a.append(a)
                    out_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], schema=schema)

    side = lambda k: sets.select(F.col("node").alias(k), F.col("size").alias(f"s{k}"), F.col("bits").alias(f"x{k}"))
    met = pairs.join(side("b"), "b").join(side("a"), "a")
    return met.select("a", "b", "sa", "sb", "xa", "xb").mapInArrow(common.task(run), "a long, b long")


def cell(c: str):
    """The cell of an id in a bitmap of ids."""
    return F.shiftrightunsigned(F.xxhash64(F.col(c)), 64 - ID_BITS)


def bitmap(spark: SparkSession, ids: DataFrame, column: str):
    """A broadcast bitmap of 2**ID_BITS bits (1 MB) that has the cell of every id, whatever their number."""
    import numpy as np

    rows = ids.select(cell(column).alias("c")).groupBy(F.shiftright("c", 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("c").bitwiseAND(F.lit(63)).cast("int"))).alias("m")).collect()
    table = np.zeros(1 << (ID_BITS - 6), dtype=np.int64)
    for r in rows:
        table[r["w"]] = r["m"]
    return spark.sparkContext.broadcast(table.tobytes())


def marked(table, cells):
    import numpy as np

    words = np.frombuffer(table, dtype=np.uint64)
    cells = np.asarray(cells, dtype=np.int64)
    return ((words[cells >> 6] >> (cells & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def sets_of(spark: SparkSession, docs: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """(node, grams) of the documents in ``nodes``. A bitmap of their ids, of bounded size, keeps others from moving."""
    import pyarrow as pa

    bits = bitmap(spark, nodes, "node")

    def run(batches):
        import numpy as np

        shingle = Shingler(n)
        for b in batches:
            keep = np.flatnonzero(marked(bits.value, b.column("cell").to_numpy(zero_copy_only=False)))
            for i in range(0, len(keep), 500):
                some = b.take(pa.array(keep[i : i + 500]))
                yield pa.record_batch({"node": some.column("doc_id"), "grams": pa.array([shingle(t.as_py()).tobytes() for t in some.column("text")], pa.binary())})

    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).filter("doc_id is not null")
    found = own.withColumn("cell", cell("doc_id")).mapInArrow(common.task(run), "node long, grams binary")
    return found.join(nodes, "node", "left_semi")


def heads_of(spark: SparkSession, rows: DataFrame, first: DataFrame) -> DataFrame:
    """Rows of non-empty sets that aren't copies of a set with a smaller id, as (node, size, tokens, bits).

    Copies are found on (id, signature) alone. A bitmap of their ids lets all other rows stay where they are.
    """
    some = rows.filter("size > 0 and doc_id is not null")
    copies = some.select("doc_id", "sig").join(first, "sig").filter("doc_id <> node").select("doc_id", "sig")
    bits = bitmap(spark, copies, "doc_id")

    @F.pandas_udf("boolean")
    def perhaps(cells: pd.Series) -> pd.Series:
        return pd.Series(marked(bits.value, cells.to_numpy()))

    flagged = some.withColumn("perhaps", perhaps(cell("doc_id")))
    sure = flagged.filter(~F.col("perhaps"))
    checked = flagged.filter("perhaps").join(copies, ["doc_id", "sig"], "left_anti").select(*sure.columns)
    return sure.unionByName(checked).select(F.col("doc_id").alias("node"), "size", "tokens", "bits")


def linked(spark: SparkSession, docs: DataFrame, pairs: DataFrame, n: int, percent: int, work: str) -> DataFrame:
    """The pairs (a, b) that are links by their whole sets; ``pairs`` is written."""
    import pyarrow as pa

    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = common.cut(spark, sets_of(spark, docs, nodes, n), f"{work}/sets")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        import numpy as np

        for batch in batches:
            out = []
            for a, b, x, y in zip(*(batch.column(c) for c in ("a", "b", "xa", "xb"))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    out.append((a.as_py(), b.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in (0, 1)], schema=schema)

    side = lambda k: sets.select(F.col("node").alias(k), F.col("grams").alias(f"x{k}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "xa", "xb").mapInArrow(common.task(run), "a long, b long")


def in_lists(entries: DataFrame, percent: int, parts: int) -> DataFrame:
    """Pairs (a, b) of entries of a list that lie in different components and that sizes, positions and bitmaps allow.

    ``entries``: token, n (length of its list), node, component, size, pos, bits.
    """
    import pyarrow as pa

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / LIST)).cast("int")
    rows = entries.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("token", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "component", "size", "pos", "bits")
    rows = rows.repartition(parts, "token", "lo", "hi").sortWithinPartitions("token", "lo", "hi", "size", "node")

    def held(t):
        import numpy as np

        num = lambda c: t.column(c).to_numpy(zero_copy_only=False)
        token, lo, hi, own, node, comp, size, pos = map(num, ("token", "lo", "hi", "own", "node", "component", "size", "pos"))
        bits = None
        out_a, out_b = [], []
        i = np.arange(len(token) - 1)
        d = 1
        while len(i):
            j = i + d
            # Sizes ascend within a block, so an entry that is too large for i ends i's turn.
            live = (token[i] == token[j]) & (lo[i] == lo[j]) & (hi[i] == hi[j]) & (100 * size[i] >= percent * size[j])
            i = i[live]
            j = i + d
            total = size[i] + size[j]
            need = overlap_needed(total, percent)
            good = (comp[i] != comp[j]) & ((lo[i] == hi[i]) | (own[i] != own[j])) & (np.minimum(size[i] - pos[i], size[j] - pos[j]) >= need)
            if good.any():
                if bits is None:
                    raw = t.column("bits").to_pylist()
                    bits = [(int.from_bytes(x, "little"), 8 * len(x)) for x in raw]
                for p, q, most in zip(i[good].tolist(), j[good].tolist(), (total - 2 * need)[good].tolist()):
                    if apart(*bits[p], *bits[q]) <= most:
                        x, y = int(node[p]), int(node[q])
                        out_a.append(min(x, y))
                        out_b.append(max(x, y))
            d += 1
            i = i[i + d < len(token)]
        pairs = sorted(set(zip(out_a, out_b)))
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], schema=schema)

    def run(batches):
        import numpy as np

        kept, more = None, []
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                more.append(batch)
                if sum(b.num_rows for b in more) < TOGETHER:
                    continue
            if not more:
                break
            t = pa.Table.from_batches(more)
            more = []
            t = t if kept is None else pa.concat_tables([kept, t])
            if not t.num_rows:
                continue
            last = t.slice(t.num_rows - 1)
            same = np.ones(t.num_rows, dtype=bool)
            for c in ("token", "lo", "hi"):
                same &= t.column(c).to_numpy() == last.column(c)[0].as_py()
            k = int(np.flatnonzero(same)[0])
            kept = t.slice(k).combine_chunks()
            if k:
                yield held(t.slice(0, k).combine_chunks())
        if kept is not None:
            yield held(kept)

    return rows.mapInArrow(common.task(run), "a long, b long")


def join(spark: SparkSession, docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    import numpy as np

    work, parts = common.work_dir(spark, "ngram-join"), common.partitions(spark)
    # Which n-grams are frequent among the first ones of sets. This sets the order only, not the result.
    counts = features(docs, n, percent).select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") > COMMON)
    counts = common.cut(spark, counts, f"{work}/frequent")
    often = counts.orderBy(F.desc("n"), "token").limit(FREQUENT).select("token").toArrow().column("token")
    frequent = spark.sparkContext.broadcast(np.sort(often.to_numpy().astype(np.int64).view(np.uint64)))
    rows = common.cut(spark, features(docs, n, percent, frequent), f"{work}/features")
    # Equal sets are one node, named by their smallest id.
    some = rows.filter("size > 0 and doc_id is not null")
    first = common.cut(spark, some.groupBy("sig").agg(F.min("doc_id").alias("node")), f"{work}/first")
    heads = heads_of(spark, rows, first)
    sets = heads.select("node", "size", "bits")
    posted = heads.select("node", F.posexplode("tokens").alias("pos", "token"), F.col("size").cast("int").alias("size"))
    counts = posted.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1")
    lists = common.cut(spark, posted.join(counts, "token"), f"{work}/lists")
    hubs = lists.groupBy("token").agg(F.min(F.struct("node", "size", "pos")).alias("hub"))
    # Every entry against its list's first one.
    total = F.col("size") + F.col("hub.size")
    need = F.ceil(F.lit(percent) * total / (100 + percent))
    allowed = (F.lit(100) * F.least("size", "hub.size") >= F.lit(percent) * F.greatest("size", "hub.size")) & (F.least(F.col("size") - F.col("pos"), F.col("hub.size") - F.col("hub.pos")) >= need)
    stars = lists.join(hubs, "token").filter("node > hub.node").filter(allowed).select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct()
    stars = common.cut(spark, close_enough(stars, sets, percent), f"{work}/stars")
    edges = common.cut(spark, linked(spark, docs, stars, n, percent, f"{work}/star-sets"), f"{work}/edges")
    labels = components(spark, edges, f"{work}/star-components")
    # What hubs have not explained: entries of a list in different components. A list of two holds its hub and one other,
    # a pair that has been checked.
    named = lists.filter("n > 2").select("token", "n", "node", "size", "pos").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = named.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("token")
    entries = named.join(mixed, "token", "left_semi").join(sets.select("node", "bits"), "node")
    rest = common.cut(spark, in_lists(entries, percent, parts).distinct(), f"{work}/rest")
    known = stars.select("a", "b")
    rest = common.cut(spark, rest.join(known, ["a", "b"], "left_anti"), f"{work}/rest-new")
    more = common.cut(spark, linked(spark, docs, rest, n, percent, f"{work}/rest-sets"), f"{work}/more")
    final = components(spark, edges.unionByName(more), f"{work}/components") if not more.isEmpty() else labels
    out = rows.select("doc_id", F.col("size").alias("n_shingles"), "sig").join(first, "sig", "left").join(final, "node", "left")
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")).alias("component_id"))
    out = common.cut(spark, out, common.work_dir(spark, "ngram-components"))
    common.drop(spark, work)
    return out


def one_of_each(spark: SparkSession, docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near copies: one row of each component stays, that of the smallest id (null last).

    Where ids are unique, as a look at the ids alone tells, they name the rows. Otherwise rows are numbered in a written
    copy, so repeated rows, rows without id and rows that share an id are each judged by their own text. Rows without words
    stay.
    """
    ids = docs.select(docs["doc_id"].cast("long").alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    if ids.filter("id is null or n > 1").isEmpty():
        found = join(spark, docs, n, percent).filter("doc_id <> component_id").select(F.col("doc_id").alias("_copy"))
        # Columns by their own tables, so a column of the name _copy is another one.
        return docs.join(found, docs["doc_id"].cast("long") == found["_copy"], "left_anti").select(*docs.columns)
    work = common.work_dir(spark, "one-of-each")
    # Other columns travel in a struct, so that no name can clash.
    others = F.struct(F.lit(0).alias("_none"), *(docs[f"`{c}`"] for c in docs.columns if c != "text"))
    own = docs.select(F.monotonically_increasing_id().alias("row"), docs["doc_id"].cast("long").alias("id"), docs["text"].alias("text"), others.alias("rest"))
    own = common.cut(spark, own, f"{work}/rows", "zstd")
    found = join(spark, own.select(F.col("row").alias("doc_id"), "text"), n, percent)
    found = found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("component"))
    # A component of one row has no other to give way to: only components that another row names are looked at.
    groups = found.filter("row <> component").select("component").distinct()
    named = found.join(groups, "component", "left_semi")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    first = named.join(own.select("row", "id"), "row").groupBy("component").agg(F.min(rank).alias("first"))
    gone = named.join(first, "component").filter(F.col("row") != F.col("first.row")).select("row")
    gone = common.cut(spark, gone, f"{work}/gone")
    return own.join(gone, "row", "left_anti").select(*(F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: components of all ``documents`` by 3-word shingles at a Jaccard index of 0.9."""
    return join(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), 3, 90)


#: All pairs that share a shingle, and components by walking links.
SQL = """WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM w),
sizes AS (SELECT doc_id, len(g) AS n FROM sets),
grams AS (SELECT doc_id, unnest(g) AS gram FROM sets),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM met JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
reach(a, b) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, r.c AS component_id FROM sizes s JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON s.doc_id = r.a"""
