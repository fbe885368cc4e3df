"""A positional inverted index over papers: words, phrases, prefixes, boolean queries and BM25 without reading the texts.

A paper is one stream of words (runs of letters and numbers): title, abstract, topics, authors, one behind another, so a
phrase may run from the title into the abstract, as it may in a search over both. Tables below one folder of the store:

* ``postings`` (term, block, pmid, positions, title_end, abstract_end, weight): one row a word and paper, in ranges of (term,
  block, pmid) and sorted, so a lookup reads the row groups of its terms only, and the list of a word that most papers have is
  spread over as many files as it fills. ``weight`` is BM25's part that doesn't depend on the query.
* ``terms`` (term, papers), sorted; ``blocks`` (term, block, best, papers), files sorted: the largest weight of a term in a block
  of papers, and how many of them hold it.
* ``papers`` (pmid, words, block) and ``totals`` (papers, mean): one row.

Boolean queries: each leaf with words becomes rows (pmid, leaf) by intersecting positions; leaves on other columns (dates,
topics, identifiers) are evaluated on the papers' own columns, and the tree joins both by pmid. Only a leaf whose words hold
other characters than letters and numbers (``covid-19``) is verified against the texts of the papers it has found.

The best k papers: blocks are ranked by the sum of their terms' best weights. The first blocks are scored whole; the k-th
score of these is a bound, and of the others only blocks whose sum reaches it are read. The result is exact.

Words are compared by their lower case (of the upper case, so ß finds ss). Null texts have no words; a null pmid isn't
indexed; of papers of one pmid one row each is indexed.
"""

from __future__ import annotations

import math
from itertools import accumulate, chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import shared
from paperloom.sources import querylang

K1, B = 1.2, 0.75
BLOCK_PAPERS = 1_024
#: Blocks that a top-k query scores before it has a bound.
FIRST_BLOCKS = 16
#: Fields of the search language that the stream answers: (first word, end) by columns of a posting.
STREAM = {"title": (None, "title_end"), "tiab": (None, "abstract_end"), "abstract": ("title_end", "abstract_end"), "all": (None, None)}
POSTING = "term string, pmid string, positions array<int>, title_end int, abstract_end int, words int"


def folded(word: str) -> str:
    return word.lower().upper().lower()


def streams(papers: DataFrame) -> DataFrame:
    """POSTING rows of (pmid, title, abstract, mesh_terms, authors)."""
    import pyarrow as pa

    kinds = [("term", pa.string()), ("pmid", pa.string()), ("positions", pa.list_(pa.int32())), *((c, pa.int32()) for c in ("title_end", "abstract_end", "words"))]
    schema = pa.schema(kinds)

    def run(batches):
        import re

        find, fold = re.compile(r"[^\W_]+").findall, {}

        def made(out):
            terms, pmids, sizes, places, *ends = out
            offsets = pa.array(list(accumulate(sizes, initial=0)), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(places, pa.int32()))
            columns = [pa.array(terms, pa.string()), pa.array(pmids, pa.string()), lists, *(pa.array(c, pa.int32()) for c in ends)]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for b in batches:
            columns = [b.column(c).to_pylist() for c in ("pmid", "title", "abstract", "more")]
            out: list = [[] for _ in range(7)]
            for pmid, *texts in zip(*columns):
                at, ends, own = 0, [], {}
                for text in texts:
                    for w in find(text or ""):
                        if (term := fold.get(w)) is None:
                            if len(fold) > 100_000:
                                fold.clear()
                            term = fold[w] = folded(w)
                        if term in own:
                            own[term].append(at)
                        else:
                            own[term] = [at]
                        at += 1
                    ends.append(at)
                n = len(own)
                out[0] += own
                out[1] += [pmid] * n
                out[2] += map(len, own.values())
                out[3] += chain.from_iterable(own.values())
                for column, value in zip(out[4:], (ends[0], ends[1], at)):
                    column += [value] * n
                if len(out[0]) > 50_000:
                    yield made(out)
                    out = [[] for _ in range(7)]
            yield made(out)

    more = F.concat_ws(" ", F.array_join("mesh_terms", " "), F.array_join("authors", " "))
    rows = papers.filter("pmid is not null").select("pmid", "title", "abstract", more.alias("more"))
    return rows.mapInArrow(run, POSTING)


class TextIndex:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{name}")

    @classmethod
    def build(cls, papers: DataFrame, base: str) -> TextIndex:
        spark = papers.sparkSession
        index, parts = cls(spark, base), int(spark.conf.get("spark.sql.shuffle.partitions"))
        # By ids alone: texts are dealt only where a pmid repeats.
        ids = papers.filter("pmid is not null").groupBy("pmid").agg(F.count("*").alias("rows"))
        ids = shared.written(spark, ids, f"{base}/ids")
        once = papers if ids.filter("rows > 1").isEmpty() else papers.dropDuplicates(["pmid"])
        found = shared.written(spark, streams(once), f"{base}/streams")
        sizes = ids.select("pmid").join(found.groupBy("pmid").agg(F.max("words").alias("words")), "pmid", "left").na.fill(0, ["words"])
        # Written: of all postings, and read for the totals and for the papers.
        sizes = shared.written(spark, sizes, f"{base}/sizes")
        told = sizes.agg(F.count("*").alias("papers"), F.coalesce(F.avg("words"), F.lit(0.0)).alias("mean"))
        totals = shared.written(spark, told, f"{base}/totals").first()
        blocks = max(1, math.ceil(totals["papers"] / BLOCK_PAPERS))
        block = F.pmod(F.xxhash64("pmid"), F.lit(blocks)).cast("int")
        sizes.withColumn("block", block).write.mode("overwrite").parquet(f"{base}/papers")
        n, mean = F.size("positions").cast("double"), totals["mean"] or 1.0
        weight = n * (K1 + 1) / (n + K1 * (1 - B + B * F.col("words") / F.lit(mean)))
        order = ["term", "block", "pmid"]
        rows = found.withColumn("block", block).withColumn("weight", weight).drop("words")
        rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).write.mode("overwrite").option("parquet.block.size", 8 << 20).parquet(f"{base}/postings")
        postings = index.table("postings")
        best = postings.groupBy("term", "block").agg(F.max("weight").alias("best"), F.count("*").alias("papers"))
        best.sortWithinPartitions("term", "block").write.mode("overwrite").parquet(f"{base}/blocks")
        # A term's papers are those of its blocks, so the postings are read for both once.
        terms = index.table("blocks").groupBy("term").agg(F.sum("papers").alias("papers"))
        terms.repartitionByRange(parts, "term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{base}/terms")
        return index

    # Words, phrases, prefixes

    def leaf(self, number: int, text: str, field: str) -> DataFrame:
        """(pmid, leaf) of the papers that hold a word, phrase or prefix in a field of the stream."""
        words, wild = leaf_words(text)
        postings = self.table("postings")
        last = len(words) - 1
        begin, end = (F.lit(None) if c is None else F.col(c) for c in STREAM[field])
        begin = F.lit(0) if STREAM[field][0] is None else begin
        one = F.col("term").isin(*(words[:-1] if wild else words))
        wanted = (one | F.col("term").startswith(words[-1])) if wild else one
        place = [F.when(F.col("term").startswith(w) if wild and k == last else F.col("term") == w, F.lit(k)) for k, w in enumerate(words)]
        # A word's place in the phrase, and by it the place where the phrase would begin.
        rows = postings.filter(wanted).withColumn("k", F.explode(F.filter(F.array(*place), lambda k: k.isNotNull())))
        starts = F.transform("positions", lambda p: p - F.col("k"))
        inside = lambda s: (s >= begin) & (F.lit(True) if STREAM[field][1] is None else s + len(words) <= end)
        rows = rows.select("pmid", "k", F.filter(starts, inside).alias("starts")).filter(F.size("starts") > 0)
        if len(words) > 1:
            # Word by word: a paper's places so far with those of the next word. A place is never a row of its own.
            met = rows.filter("k = 0").select("pmid", "starts")
            for k in range(1, len(words)):
                after = rows.filter(F.col("k") == k).select("pmid", F.col("starts").alias("_after"))
                met = met.join(after, "pmid").select("pmid", F.array_intersect("starts", "_after").alias("starts"))
                met = met.filter(F.size("starts") > 0)
            rows = met
        return rows.select("pmid", F.lit(number).alias("leaf")).distinct()

    def search(self, papers: DataFrame, query: str) -> DataFrame:
        """The rows of ``papers`` that a boolean query finds: the same as by ``querylang.predicate``."""
        leaves: list[tuple[str, str]] = []
        known = frozenset(papers.columns)

        def walk(node):
            if node is None:
                return F.lit(True)
            op, a, b = node
            if op == "term":
                if b not in STREAM or not leaf_words(a)[0]:
                    return querylang.compiled(node, known)
                if (a, b) not in leaves:
                    leaves.append((a, b))
                return F.coalesce(F.array_contains("_leaves", leaves.index((a, b))), F.lit(False))
            left, right = F.lit(True) if a is None else walk(a), walk(b)
            return {"AND": left & right, "OR": left | right, "OR NOT": left | ~right}.get(op, left & ~right)

        condition = walk(querylang.parse(query))
        if not leaves:
            return papers.filter(condition)
        hits = None
        for k, (text, field) in enumerate(leaves):
            own = self.leaf(k, text, field)
            if not plain(text):
                # Signs within words, as in covid-19, stand between words of the stream: texts found are looked at.
                own = papers.join(own, "pmid").filter(querylang.compiled(("term", text, field), known)).select("pmid", "leaf").distinct()
            hits = own if hits is None else hits.unionByName(own)
        found = hits.groupBy("pmid").agg(F.collect_set("leaf").alias("_leaves"))
        # Papers without text columns meet what the leaves have found; texts aren't read for it.
        others = [c for c in papers.columns if c not in ("abstract", "full_text", "full_text_sections", "title")]
        passed = papers.select(*others).join(found, "pmid", "left").filter(condition).select("pmid")
        return papers.join(passed.distinct(), "pmid", "left_semi")

    # Relevance

    def _weighed(self, words: list[str]) -> tuple[list[str], DataFrame]:
        """Distinct folded words, and (term, idf) of those that there are."""
        terms = sorted({w for text in words for w in leaf_words(text)[0]})
        n = self.table("totals").first()["papers"]
        idf = F.log(1 + (F.lit(float(n)) - F.col("papers") + 0.5) / (F.col("papers") + 0.5))
        return terms, self.table("terms").filter(F.col("term").isin(*terms)).select("term", idf.alias("idf"))

    def scores(self, words: list[str], blocks: DataFrame | None = None) -> DataFrame:
        """(pmid, score) by BM25 of every paper with any of the words (of ``blocks``, if given)."""
        terms, idf = self._weighed(words)
        rows = self.table("postings").filter(F.col("term").isin(*terms))
        rows = rows if blocks is None else rows.join(blocks.select("block"), "block", "left_semi")
        # As many rows of idf as the query has words.
        rows = rows.select("term", "pmid", "weight").join(F.broadcast(idf), "term")
        parts = F.array_sort(F.collect_list(F.struct("term", (F.col("idf") * F.col("weight")).alias("s"))))
        total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x["s"])
        return rows.groupBy("pmid").agg(total.alias("score"))

    def best(self, words: list[str], k: int) -> DataFrame:
        """(pmid, score, rank) of the best k papers, by score to nine places and pmid."""
        terms, idf = self._weighed(words)
        bounds = self.table("blocks").drop("papers").filter(F.col("term").isin(*terms)).join(F.broadcast(idf), "term")
        bounds = bounds.groupBy("block").agg(F.sum(F.col("idf") * F.col("best")).alias("bound"))
        bounds = shared.written(self.spark, bounds, shared.folder(self.spark, "bounds"))
        first = bounds.orderBy(F.desc("bound"), "block").limit(FIRST_BLOCKS)
        rounded = F.round("score", 9).alias("score")
        some = self.scores(words, first).select("pmid", rounded)
        kth = some.orderBy(F.desc("score"), "pmid").limit(k).agg(F.count("*").alias("n"), F.min("score").alias("least")).first()
        left = bounds if kth["n"] < k else bounds.filter(F.col("bound") >= kth["least"] - 1e-6)
        order = [F.desc("score"), F.asc("pmid")]
        top = self.scores(words, left).select("pmid", rounded).orderBy(*order).limit(k)
        from pyspark.sql.window import Window

        # k rows, which a top-k report has in one place anyway.
        return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def leaf_words(text: str) -> tuple[list[str], bool]:
    """Folded words of a term of the search language, and whether its last one is a prefix."""
    import re

    text = text.strip()
    return [folded(w) for w in re.findall(r"[^\W_]+", text.rstrip("*").strip('"'))], text.endswith("*")


def plain(text: str) -> bool:
    """Whether a term's words are letters and numbers only, so that the stream's words decide."""
    return all(w.isalnum() and w.isascii() for w in text.strip().rstrip("*").strip('"').split())


def term_counts(index: TextIndex) -> DataFrame:
    """(term, papers): in how many papers each word stands."""
    return index.table("terms")


def parts_of(index: TextIndex, term: str) -> DataFrame:
    """(file, rows): how a word's list is spread over files."""
    name: Column = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return index.table("postings").filter(F.col("term") == term).groupBy(name.alias("file")).agg(F.count("*").alias("rows"))
