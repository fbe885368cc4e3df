"""Source divergence audit: how each source's words depart from those of other sources of its language (operator 13).

Each language keeps the terms that at least ``LEAST_DOCS`` of its documents hold. A group (lang, source) gives each kept
term a smoothed share p in parts of 10**9, and the divergence of an ordered pair of groups is the sum of
f(p, q) = (p - q)**2 div q over *all* kept terms, those that neither group holds included. Summing that term by term takes
terms x groups**2 steps, nearly all of them over absent terms. Terms are split by how many groups hold them:

* Heavy terms, in more than ``heavy`` groups, are laid out as dense tiles (terms of a block x groups of a tile, absent ones
  included) and summed by numpy, one pair of tiles a group of rows.
* Light terms are summed as if neither group held them, ``light terms x f(none, none)``, which needs no rows. Corrections
  for terms that one of the two holds come from a histogram of each group's counts, f(p(count), q(none)) - f(none, none).
  Corrections for terms that both hold come from the pairs within a posting, at most heavy * (heavy - 1) for a term, which a
  task adds up by pair of groups before anything leaves it.

All four parts are whole numbers of 64 bits, so the sum doesn't depend on their order: it is exact.

Counts of terms are put together in each task before they shuffle, terms of a language spread by hash, and a block of
heavy terms holds a bounded number of cells, so neither a language nor a source nor a term that most documents share is
one task's work. Groups of a language are numbered; tiles are ``TILE`` groups wide.

Defined results: null text, lang and source are ''; a text without terms counts for its group only, a group without terms
has p = 1 + 10**9 div V for each term; without kept terms (V = 0) pairs have the value 0 and there is no part ``term``;
rows of equal or null ids and repeated rows count each; very long texts are counted whole; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from paperloom.llm import common

LEAST_DOCS = 3
UNIT = 1_000_000_000
TOP = 200
HEAVY = 16
TILE = 128
#: Cells of a dense tile, counts that a task holds before it passes them on, pairs within postings and bytes of text that
#: it takes at once.
CELLS = 1 << 16
HELD = 2_000_000
PAIRS = 1 << 18
PIECE = 1 << 23
TERM = rb"[A-Za-z\x80-\xff]+"

COUNTS = "lang string, source string, term string, n long, docs long"
SUMS = "lang string, a int, b int, value long"


def _words(texts, groups):
    """(terms, codes, groups, n, docs) of texts and their groups: occurrences of each term in each group and documents that
    hold it, ``codes`` being places in ``terms``. Words are found and numbered by columns, none is a Python object."""
    import numpy as np
    import pyarrow as pa

    # Bytes of characters beyond ASCII are all above 127, so terms are runs of bytes; only A-Z change case.
    every = bytes(range(256))
    others = re.sub(TERM, b"", every)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2].slice(at[0], at[-1] - at[0]).to_pybytes() if at[-1] > at[0] else b""
    at = at - at[0]
    inside = np.frombuffer(data.translate(bytes(b not in others for b in every)), bool)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    # Texts lie side by side: a word ends with its text.
    edges = at[:-1][at[:-1] < len(data)]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    start = np.flatnonzero(first)
    doc = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(start, at)))
    ends = np.concatenate([[0], np.cumsum(np.flatnonzero(last) + 1 - start)]).astype(np.int64)
    letters = pa.py_buffer(data.translate(every.lower(), others))
    words = pa.Array.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(ends), letters])
    words = words.dictionary_encode()
    # Documents of a group are made neighbours, so one sort by term and document serves both counts.
    order = np.argsort(groups, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    keys = words.indices.to_numpy().astype(np.int64) << 32 | place[doc]
    keys.sort()
    once = np.flatnonzero(np.diff(keys, prepend=-1))
    n = np.diff(once, append=len(keys))
    keys = keys[once]
    return words.dictionary, *_added(keys >> 32, groups[order[keys & 0xFFFFFFFF]], n, np.ones(len(n), np.int64))


def _added(codes, groups, n, docs):
    """Neighbouring rows of one term and group put together."""
    import numpy as np

    new = np.flatnonzero((np.diff(codes, prepend=-1) != 0) | (np.diff(groups, prepend=-1) != 0))
    n, docs = (np.add.reduceat(x, new) if len(new) else x for x in (n, docs))
    return codes[new], groups[new], n, docs


def _united(parts):
    """Several results of ``_words`` as one."""
    import numpy as np
    import pyarrow as pa

    named = [pa.DictionaryArray.from_arrays(pa.array(codes, pa.int32()), terms) for terms, codes, *_ in parts]
    named = pa.chunked_array(named).unify_dictionaries()
    codes = np.concatenate([c.indices.to_numpy() for c in named.chunks]).astype(np.int64)
    groups, n, docs = (np.concatenate([p[k] for p in parts]) for k in (2, 3, 4))
    order = np.argsort(codes << 32 | groups)
    return named.chunk(0).dictionary, *_added(*(x[order] for x in (codes, groups, n, docs)))


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group and documents that hold it."""
    import pyarrow as pa

    schema = pa.schema([(c, pa.string()) for c in ("lang", "source", "term")] + [(c, pa.int64()) for c in ("n", "docs")])

    def run(batches):
        import numpy as np

        number: dict = {}
        held: list = []

        def flush():
            terms, codes, groups, n, docs = held.pop()
            names = [pa.array(x, pa.string()) for x in zip(*number)] if number else []
            for i in range(0, len(codes), 50_000):
                some = slice(i, i + 50_000)
                columns = [c.take(pa.array(groups[some])) for c in names]
                columns += [terms.take(pa.array(codes[some])).cast(pa.string()), pa.array(n[some]), pa.array(docs[some])]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

        for b in batches:
            keys = zip(b.column("lang").to_pylist(), b.column("source").to_pylist())
            groups = np.array([number.setdefault(k, len(number)) for k in keys], np.int64)
            texts = b.column("text").cast(pa.large_binary())
            sizes = np.cumsum(pa.compute.binary_length(texts).to_numpy())
            cuts = [*np.flatnonzero(np.diff(sizes // PIECE, prepend=0)).tolist(), len(texts)]
            for i, j in zip([0, *cuts], cuts):
                if i < j:
                    held.append(_words(texts.slice(i, j - i), groups[i:j]))
            if sum(len(p[1]) for p in held) > HELD:
                held[:] = [_united(held)]
                # Little came together: what is held is passed on.
                if len(held[0][1]) > HELD // 2:
                    yield from flush()
        if held:
            held[:] = [_united(held)]
            yield from flush()

    named = lambda c: F.coalesce(docs[c].cast("string"), F.lit("")).alias(c)
    rows = docs.select(*map(named, ("text", "lang", "source"))).mapInArrow(common.task(run), COUNTS)
    # Dealt by term: tasks have put theirs together, and what is told of a term needs no other exchange.
    rows = rows.repartition("lang", "term")
    return rows.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + v)), exact beyond 64 bits."""
    big = lambda c: c.cast("decimal(20,0)")
    whole = F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * big(n + 1), big(total + v))
    return F.when(v > 0, 1 + whole.cast("long"))


def departure(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


class Tables:
    """Written tables: ``rows`` (lang, term, source, n, in_lang, spread, lead), one a group and kept term it holds, of which
    one a term is its lead, and ``groups``
    (lang, source, no, total, lang_total, v, width): a group's number within its language and sums of counts."""

    def __init__(self, spark: SparkSession, docs: DataFrame, work: str, least_docs: int = LEAST_DOCS):
        # A term has a row a group at most.
        term = W.Window.partitionBy("lang", "term")
        whole = {"in_docs": F.sum("docs"), "in_lang": F.sum("n"), "spread": F.count("*"), "_least": F.min("source")}
        rows = counted(docs).select("*", *(c.over(term).alias(name) for name, c in whole.items()))
        rows = rows.filter(F.col("in_docs") >= least_docs).withColumn("lead", F.col("source") == F.col("_least"))
        self.rows = common.cut(spark, rows.drop("docs", "in_docs", "_least"), f"{work}/rows", "zstd")
        named = lambda c: F.coalesce(docs[c].cast("string"), F.lit("")).alias(c)
        every = docs.select(named("lang"), named("source")).distinct()
        totals = self.rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        sizes = self.rows.filter("lead").groupBy("lang")
        sizes = sizes.agg(F.count("*").alias("v"), F.sum("in_lang").alias("lang_total"))
        of = W.Window.partitionBy("lang")
        zero = F.lit(0).cast("long")
        groups = every.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
        groups = groups.select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("total", "lang_total", "v")))
        groups = groups.withColumn("no", F.row_number().over(of.orderBy("source")) - 1).withColumn("width", F.count("*").over(of).cast("int"))
        self.groups = common.cut(spark, groups, f"{work}/groups")


def top_terms(t: Tables, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a group has most above its language."""
    rows = t.rows.join(t.groups, ["lang", "source"])
    p, q = share(F.col("n"), F.col("total"), F.col("v")), share(F.col("in_lang"), F.col("lang_total"), F.col("v"))
    rows = rows.withColumn("p", p).withColumn("q", q).filter("p > q")
    rows = rows.select("lang", "source", F.col("term").alias("item"), departure(F.col("p"), F.col("q")).alias("value"))
    # A group's best come from the best of its spread parts: a task keeps at most ``top`` rows of each before it shuffles.
    order = [F.desc("value"), F.asc("item")]
    within = W.Window.partitionBy("lang", "source").orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= top)


def _f(p, q):
    d = p - q
    return d * d // q


def dense(rows: DataFrame) -> DataFrame:
    """SUMS over the rows of ``tiled``: blocks of terms by pairs of tiles. A group without a term has its share of none."""

    def run(key, frame):
        import numpy as np
        import pandas as pd

        lang, _, i, j = key
        # Rows of absent terms have the number -1.
        number, terms = pd.factorize(frame["term"])
        tiles, nos, shares = (frame[c].to_numpy(np.int64) for c in ("tile", "no", "p"))

        def tile(which):
            none, some = np.flatnonzero(which & (number < 0)), np.flatnonzero(which & (number >= 0))
            none = none[np.argsort(nos[none])]
            groups, none_p = nos[none], shares[none]
            out = np.tile(none_p, (len(terms), 1))
            out[number[some], np.searchsorted(groups, nos[some])] = shares[some]
            return groups, none_p, out

        a, none_p, p = left = tile(tiles == i)
        b, none_q, q = left if i == j else tile(tiles == j)
        values = np.stack([_f(p[:, [k]], q).sum(axis=0) for k in range(len(a))])
        # Terms of the block that no group of the two tiles holds.
        values += (int(frame["terms"].max()) - len(terms)) * _f(none_p[:, None], none_q[None, :])
        x, y = np.repeat(a, len(b)), np.tile(b, len(a))
        other = x != y
        return pd.DataFrame({"lang": lang, "a": x[other], "b": y[other], "value": values.ravel()[other]})

    return rows.groupBy("lang", "block", "i", "j").applyInPandas(run, SUMS)


def tiled(rows: DataFrame, groups: DataFrame, heavy: int) -> DataFrame:
    """(lang, block, i, j, tile, no, term, p, terms): each heavy row once for each pair of tiles it takes part in, and for
    each block and pair the shares that the tiles' groups give to absent terms (term is null) and the block's terms."""
    own = rows.filter(F.col("spread") > heavy)
    # Blocks of a language hold about CELLS cells of one tile each.
    distinct = own.filter("lead").select("lang", "term")
    n_terms = distinct.groupBy("lang").agg(F.count("*").alias("n_terms"))
    blocks = F.ceil(F.col("n_terms") * F.least("width", F.lit(TILE)) / F.lit(CELLS)).cast("int")
    sized = groups.join(n_terms, "lang").withColumn("blocks", blocks).withColumn("tile", F.floor(F.col("no") / TILE).cast("int"))
    tiles = F.ceil(F.col("width") / TILE).cast("int")
    # A row of tile t stands in the pairs (t, x) and (x, t).
    other = F.sequence(F.lit(0), tiles - 1)
    pairs = F.array_distinct(F.concat(F.transform(other, lambda x: F.struct(F.col("tile").alias("i"), x.alias("j"))), F.transform(other, lambda x: F.struct(x.alias("i"), F.col("tile").alias("j")))))
    some = own.join(sized.select("lang", "source", "no", "total", "v", "blocks", "tile", "width"), ["lang", "source"])
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    nothing = F.lit(None).cast("long")
    some = some.withColumn("block", block).withColumn("p", share(F.col("n"), F.col("total"), F.col("v"))).withColumn("terms", nothing)
    in_block = distinct.join(sized.select("lang", "blocks").distinct(), "lang").groupBy("lang", block.alias("block")).agg(F.count("*").alias("terms"))
    absent = sized.join(in_block, "lang")
    absent = absent.withColumn("p", share(F.lit(0).cast("long"), F.col("total"), F.col("v"))).withColumn("term", F.lit(None).cast("string"))
    columns = ("lang", "block", "x.i", "x.j", "tile", "no", "term", "p", "terms")
    both = [df.withColumn("x", F.explode(pairs)).select(*columns) for df in (some, absent)]
    return both[0].unionByName(both[1])


def light(t: Tables, heavy: int) -> tuple[DataFrame, DataFrame]:
    """(SUMS from pairs within postings, histogram (lang, no, n, terms)) over light terms."""
    own = t.rows.filter(F.col("spread") <= heavy).join(t.groups.select("lang", "source", "no", "total", "v"), ["lang", "source"])
    own = own.withColumn("p", share(F.col("n"), F.col("total"), F.col("v"))).withColumn("none", share(F.lit(0).cast("long"), F.col("total"), F.col("v")))
    histogram = own.groupBy("lang", "no", "p").agg(F.count("*").alias("terms"))
    posting = F.collect_list(F.struct("no", "p", "none"))
    postings = own.filter("spread > 1").groupBy("lang", "term").agg(posting.alias("held")).select("lang", "held")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.int64())])
        sums: dict = {}

        def flush():
            for lang, own in sums.items():
                keys = np.fromiter(own, np.int64, len(own))
                arrays = [pa.array([lang] * len(own), pa.string()), pa.array((keys >> 32).astype(np.int32)), pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(np.fromiter(own.values(), np.int64, len(own)))]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            held = batch.column("held")
            at = held.offsets.to_numpy().astype(np.int64)
            flat = held.values
            no, p, none = (flat.field(c).to_numpy().astype(np.int64) for c in ("no", "p", "none"))
            size = np.diff(at)
            langs = batch.column("lang").dictionary_encode()
            code, names = langs.indices.to_numpy(), langs.dictionary.to_pylist()
            found = []
            for k in np.unique(size):
                # Postings of one length are a matrix; their pairs of places are one column operation.
                every = np.flatnonzero(size == k)
                for which in np.array_split(every, -(-len(every) * k * k // PAIRS)):
                    place = at[which][:, None] + np.arange(k)
                    g, x, z = no[place], p[place], none[place]
                    xa, xb, za, zb = x[:, :, None], x[:, None, :], z[:, :, None], z[:, None, :]
                    value = _f(xa, xb) - _f(xa, zb) - _f(za, xb) + _f(za, zb)
                    other = ~np.eye(k, dtype=bool)
                    at_lang = np.broadcast_to(code[which].astype(np.int64)[:, None, None], value.shape)[:, other]
                    pair = (g[:, :, None] << 32 | g[:, None, :])[:, other]
                    found.append((at_lang.ravel(), pair.ravel(), value[:, other].ravel()))
            if found:
                at_lang, pair, value = map(np.concatenate, zip(*found))
                order = np.lexsort((pair, at_lang))
                at_lang, pair = at_lang[order], pair[order]
                new = np.flatnonzero((np.diff(at_lang, prepend=-1) != 0) | (np.diff(pair, prepend=-1) != 0))
                total = np.add.reduceat(value[order], new) if len(new) else value
                for c, q, s in zip(at_lang[new].tolist(), pair[new].tolist(), total.tolist()):
                    own = sums.setdefault(names[c], {})
                    own[q] = own.get(q, 0) + s
            if sum(map(len, sums.values())) > HELD:
                yield from flush()
                sums.clear()
        yield from flush()

    return postings.mapInArrow(common.task(run), SUMS), histogram


def pairs(t: Tables, heavy: int = HEAVY) -> DataFrame:
    """(lang, source, item, value, rank) of every ordered pair of a language's groups."""
    met, histogram = light(t, heavy)
    sums = dense(tiled(t.rows, t.groups, heavy)).unionByName(met)
    # Every pair of groups of a language is a row of the result, so it is a row here, once.
    absent = share(F.lit(0).cast("long"), F.col("total"), F.col("v"))
    n_light = t.rows.filter(F.col("lead") & (F.col("spread") <= heavy)).groupBy("lang").agg(F.count("*").alias("n_light"))
    groups = t.groups.join(n_light, "lang", "left").select("lang", "source", "no", absent.alias("none"), F.coalesce("n_light", F.lit(0).cast("long")).alias("n_light"))
    a = groups.select("lang", F.col("no").alias("a"), F.col("source").alias("source"), F.col("none").alias("p"), "n_light")
    b = groups.select("lang", F.col("no").alias("b"), F.col("source").alias("item"), F.col("none").alias("q"))
    every = a.join(b, "lang").filter("a <> b")
    base = F.coalesce(F.col("n_light") * departure(F.col("p"), F.col("q")), F.lit(0).cast("long"))
    every = every.select("lang", "a", "b", "source", "item", base.alias("base"))
    # A light term that the one group holds and the other doesn't, by what the count gives: a few shares for each group.
    h = histogram.join(groups.select("lang", "no", "none"), ["lang", "no"])
    one = h.join(groups.select("lang", F.col("no").alias("other"), F.col("none").alias("q")), "lang").filter("no <> other")
    p, q, none = F.col("p"), F.col("q"), F.col("none")
    as_a = F.sum(F.col("terms") * (departure(p, q) - departure(none, q))).alias("as_a")
    as_b = F.sum(F.col("terms") * (departure(q, p) - departure(q, none))).alias("as_b")
    one = one.groupBy("lang", "no", "other").agg(as_a, as_b)
    sums = sums.unionByName(one.select("lang", F.col("no").alias("a"), F.col("other").alias("b"), F.col("as_a").alias("value")))
    sums = sums.unionByName(one.select("lang", F.col("other").alias("a"), F.col("no").alias("b"), F.col("as_b").alias("value")))
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    out = every.join(sums, ["lang", "a", "b"], "left")
    out = out.select("lang", "source", "item", (F.col("base") + F.coalesce("value", F.lit(0).cast("long"))).alias("value"))
    order = W.Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return out.withColumn("rank", F.row_number().over(order))


def audit(spark: SparkSession, docs: DataFrame, work: str, heavy: int = HEAVY, top: int = TOP, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank)."""
    t = Tables(spark, docs, work, least_docs)
    told = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), "rank")
    return told(pairs(t, heavy), "pair").unionByName(told(top_terms(t, top), "term"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: divergence of all sources of ``documents`` within their languages."""
    return audit(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), common.work_dir(spark, "divergence"))


_P = f"1 + {UNIT}::HUGEINT * ({{n}} + 1) // ({{total}} + v)"
SQL = f"""WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, doc_id, row_number() OVER () AS r,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
each AS (SELECT lang, source, r, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS in_lang FROM each GROUP BY 1, 2 HAVING count(DISTINCT r) >= {LEAST_DOCS}),
counts AS (SELECT lang, source, term, count(*) AS n FROM each SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, count(*) AS v, sum(in_lang) AS lang_total FROM kept GROUP BY 1),
groups AS (SELECT g.lang, g.source, coalesce(t.total, 0) AS total, v, lang_total FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY 1, 2) t USING (lang, source) LEFT JOIN sizes USING (lang)),
p AS (SELECT g.lang, g.source, k.term, k.in_lang, coalesce(c.n, 0) AS n, {_P.format(n="coalesce(c.n, 0)", total="total")} AS p, {_P.format(n="in_lang", total="lang_total")} AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= {TOP}"""
