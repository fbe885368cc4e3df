"""Removal of repeated byte strings by Burrows-Wheeler transforms of shards of equal content (operator 12).

Every string of ``LENGTH`` bytes that also starts earlier (in a document of smaller id, or earlier in the same one) goes.
Suffixes of a whole corpus can't be sorted in one place, so they are dealt out such that equal strings meet:

1. A string's *anchor* is the leftmost of its GRAM-grams of least hash, a function of its bytes alone. Successive strings of
   a text share anchors, so a text has about one for every 35 bytes. Anchors that occur once can't belong to a repeated
   string; the others are found by one shuffle of 64-bit hashes, each task's repeats told apart before.
2. Around each anchor that is left, its *context*, the stretch of all strings that have this anchor, is cut out. Equal
   contexts of a task are put together, and contexts are dealt by anchor. A text that occurs in several documents sends its
   contexts once.
3. Each task sorts the suffixes of its contexts to a depth beyond ``LENGTH`` and takes their Burrows-Wheeler transform.
   Breadth-first backward extension finds the places where neighbouring suffixes' common prefix ends: those of length 0
   first, and from those of length l the ones of l + 1, by the last-to-first map of the first occurrence of each byte in
   the interval behind each place (``boundaries``). It stops at ``LENGTH``: what is not told apart by then are the
   intervals of strings that are equal over their whole length. In each, all but the earliest occurrence go.
4. Spans of a document are united over all its contexts, and cut out of its bytes.

An anchor with more than ``HOT`` occurrences is a passage that much of the corpus shares, perhaps in ever new
surroundings. Its strings are dealt one by one, by the hash of all their bytes, so the group of one key has one content,
and a task sends that once: no group grows with the number of surroundings.

Rows are named by their ids where these are unique, as a look at the ids alone tells; otherwise rows are ordered by (id,
null ids first, text) and numbered in a written copy.

Defined results: a null text is empty; texts shorter than ``LENGTH`` bytes lose nothing; matches never cross documents;
very long texts are cut into anchors by segments that overlap, with the same result; rows of equal ids or without one are
documents of their own in the order above, and of equal rows all but one lose their repeats; overlaps count, and strings
are judged on the input; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from paperloom.llm import common

LENGTH = 100
GRAM = 32
HOT = 1 << 16
SEGMENT = 1 << 20
#: Anchors and bytes of contexts that a task puts together before it passes them on, and bytes of contexts in a transform.
ANCHORS = 500_000
HELD = 16 << 20
BLOCK = 1 << 20
SHIFT = 24

ANCHOR = "hash long, key long, pos int, n int"
CONTEXT = "anchor long, context binary, row long, start int, end int"
SPAN = "row long, start int, end int"


class Anchors:
    """Anchors of texts that lie one behind another in a buffer."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        import numpy as np

        self.np, self.length, self.gram = np, length, gram
        self.table = np.random.default_rng(40_961).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers = {}
        base, step = 0x9E3779B97F4A7C15, 1
        while step < gram:
            self.powers[step] = np.uint64(base)
            base, step = base * base % 2**64, 2 * step

    def hashes(self, raw):
        """Of all grams of a buffer."""
        np = self.np
        h, step = self.table[raw], 1
        while step < self.gram:
            h = h[:-step] * self.powers[step] + h[step:]
            step *= 2
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        return h

    def __call__(self, raw, ends):
        """(place, first string, last string, hash) of each anchor, by place in the buffer. ``ends``: ends of texts."""
        np, width = self.np, self.length - self.gram + 1
        starts = np.concatenate([[0], ends[:-1]])
        cover = np.zeros(len(raw) + 1, np.int32)
        np.add.at(cover, np.maximum(starts, ends - self.length + 1), 1)
        np.add.at(cover, ends, -1)
        whole = np.cumsum(cover[:-1]) == 0
        out = [[np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]]
        for a in range(0, len(raw) - self.length + 1, SEGMENT):
            part = raw[a : a + SEGMENT + self.length - 1]
            h = self.hashes(part)
            low = (h >> np.uint64(SHIFT) << np.uint64(SHIFT)) | np.arange(len(h), dtype=np.uint64)
            size = 1
            while 2 * size <= width:
                low = np.minimum(low[:-size], low[size:])
                size *= 2
            if size < width:
                low = np.minimum(low[: len(low) - (width - size)], low[width - size :])
            at = (low & np.uint64((1 << SHIFT) - 1)).astype(np.int64)
            ok = whole[a : a + len(at)]
            opens = ok.copy()
            opens[1:] &= ~ok[:-1] | (at[1:] != at[:-1])
            closes = ok.copy()
            closes[:-1] &= ~ok[1:] | (at[1:] != at[:-1])
            first, last = np.flatnonzero(opens), np.flatnonzero(closes)
            p = at[first]
            out.append([p + a, first + a, last + a, h[p]])
        return [np.concatenate(x) for x in zip(*out)]


def _buffers(texts, most: int):
    """Ranges [a, b) of a text column, of about ``most`` bytes each, with their bytes and ends."""
    import numpy as np

    raws, a, size = [], 0, 0
    for k, t in enumerate(texts):
        raw = t.as_py().encode("utf-8", "replace")
        raws.append(raw)
        size += len(raw)
        if size >= most or k == len(texts) - 1:
            yield a, k + 1, raws, np.frombuffer(b"".join(raws), np.uint8), np.cumsum([len(r) for r in raws])
            raws, a, size = [], k + 1, 0


def rows_of(spark: SparkSession, docs: DataFrame, work: str) -> DataFrame:
    """(row, doc_id, text): ``row`` is unique, and in the order of documents."""
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), common.text_of(docs).alias("text"))
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.filter("doc_id is null or n > 1").isEmpty():
        return docs.select(F.col("doc_id").alias("row"), "doc_id", "text")
    order = ["doc_id", "tie", "way"]
    tied = docs.withColumn("tie", F.xxhash64("text")).withColumn("way", F.monotonically_increasing_id())
    own = tied.repartitionByRange(common.partitions(spark), *order).sortWithinPartitions(*order)
    return common.cut(spark, own.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), f"{work}/rows", "zstd")


def anchors(own: DataFrame, length: int, gram: int) -> DataFrame:
    """ANCHOR of (key, text). Of the places of an anchor in what a task holds, the first has their number ``n``."""
    import pyarrow as pa

    schema = pa.schema([("hash", pa.int64()), ("key", pa.int64()), ("pos", pa.int32()), ("n", pa.int32())])

    def run(batches):
        import numpy as np

        find = Anchors(length, gram)
        held: list = []
        seen: set = set()

        def flush():
            h, key, pos = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(h)
            h, key, pos = h[order], key[order], pos[order]
            new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            n = np.zeros(len(h), np.int32)
            n[new] = np.diff(np.append(new, len(h)))
            for i in range(0, len(h), 100_000):
                some = slice(i, i + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(h[some].view(np.int64)), pa.array(key[some]), pa.array(pos[some].astype(np.int32)), pa.array(n[some])], schema=schema)

        for b in batches:
            keys = b.column("key").to_numpy()
            # The places of a text that the task has met before would be the same ones.
            fresh = np.array([k not in seen and not seen.add(k) for k in keys.tolist()], bool)
            b, keys = b.filter(pa.array(fresh)), keys[fresh]
            for i, j, _, raw, ends in _buffers(b.column("text"), SEGMENT):
                p, _, _, h = find(raw, ends)
                which = np.searchsorted(ends, p, side="right")
                held.append((h, keys[i:j][which], p - np.concatenate([[0], ends])[which]))
            if sum(len(x[0]) for x in held) > ANCHORS:
                yield from flush()
                held.clear()
                seen.clear()
        if held:
            yield from flush()

    return own.select("key", "text").mapInArrow(common.task(run), ANCHOR)


def recurring(found: DataFrame) -> DataFrame:
    """(hash, key, pos) of the anchors that occur at two places of different texts or of one."""
    # What a task has found twice itself is known to recur; only one place of it, with any other task's, is compared.
    spread = F.when(F.col("n") > 0, F.lit(0)).otherwise(1 + F.pmod(F.col("key"), F.lit(1024)))
    place = F.xxhash64("key", "pos")
    of = W.Window.partitionBy("hash", "spread")
    rows = found.withColumn("spread", spread.cast("int")).withColumn("place", place)
    rows = rows.withColumn("some", F.min("place").over(of)).withColumn("other", F.max("place").over(of))
    return rows.filter("n <> 1 or some <> other").select("hash", "key", "pos")


def contexts(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """CONTEXT of (row, text, places). ``places``: 2 * pos of each wanted anchor, + 1 for a hot one. A row without context
    is a span that goes for sure: the task holds an earlier one of equal bytes."""
    import pyarrow as pa

    schema = pa.schema([("anchor", pa.int64()), ("context", pa.binary()), ("row", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches):
        import numpy as np
        import xxhash

        find = Anchors(length, gram)
        key, text, row, start = [], [], [], []
        size = 0

        def flush():
            code = pa.array(text, pa.binary()).dictionary_encode().indices.to_numpy()
            r, s = np.array(row, np.int64), np.array(start, np.int64)
            order = np.lexsort((s, r, code))
            first = np.zeros(len(code), bool)
            first[order[np.concatenate([[True], code[order][1:] != code[order][:-1]])]] = True
            ends = s + np.fromiter(map(len, text), np.int64, len(text))
            # What goes for sure needs no place with others: any will do.
            keys = np.where(first, np.array(key, np.uint64).view(np.int64), (r * 1_000_003 + s) * 0x9E3779B1)
            for i in range(0, len(code), 50_000):
                some = slice(i, i + 50_000)
                shown = pa.array([t if f else None for t, f in zip(text[some], first[some].tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(keys[some]), shown, pa.array(r[some]), pa.array(s[some].astype(np.int32)), pa.array(ends[some].astype(np.int32))], schema=schema)

        for b in batches:
            rows, wanted = b.column("row").to_pylist(), b.column("places")
            for i, j, raws, raw, ends in _buffers(b.column("text"), SEGMENT):
                p, first, last, h = find(raw, ends)
                begins = np.concatenate([[0], ends[:-1]])
                cuts = np.searchsorted(p, np.append(begins, len(raw)))
                for k in range(i, j):
                    own = slice(cuts[k - i], cuts[k - i + 1])
                    places = wanted[k].values.to_numpy()
                    is_hot = dict(zip((places >> 1).tolist(), (places & 1).tolist()))
                    base, doc, r = int(begins[k - i]), raws[k - i], rows[k]
                    for x, a, z, g in zip((p[own] - base).tolist(), (first[own] - base).tolist(), (last[own] - base).tolist(), h[own].tolist()):
                        hot = is_hot.get(x)
                        if hot is None:
                            continue
                        pieces = [(g, a, doc[a : z + length])] if not hot else [(xxhash.xxh3_64_intdigest(doc[s : s + length]), s, doc[s : s + length]) for s in range(a, z + 1)]
                        for g, s, t in pieces:
                            key.append(g)
                            text.append(t)
                            row.append(r)
                            start.append(s)
                            size += len(t)
                if size > HELD:
                    yield from flush()
                    for x in (key, text, row, start):
                        x.clear()
                    size = 0
        if text:
            yield from flush()

    return rows.select("row", "text", "places").mapInArrow(common.task(run), CONTEXT)


def sorted_suffixes(raw, depth: int):
    """Order of all rotations of a buffer by at least ``depth`` bytes: eight bytes first, then twice as many each round.
    Only those that are not yet told apart are sorted again; a rank is the first place of those that are equal so far."""
    import numpy as np

    n = len(raw)
    turned = np.concatenate([raw, raw[:8]]).astype(np.uint64)
    key = turned
    for step in (1, 2, 4):
        key = (key[:-step] << np.uint64(8 * step)) | key[step:]
    key = key[:n]
    order = np.argsort(key)
    met = key[order]
    new = np.concatenate([[True], met[1:] != met[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    step = 8
    while step < depth:
        alone = new & np.append(new[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        some = order[slots]
        key = rank[some] << 32 | rank[(some + step) % n]
        by = np.argsort(key)
        order[slots], met = some[by], key[by]
        fresh = np.concatenate([[True], met[1:] != met[:-1]])
        new[slots] = fresh
        rank[order[slots]] = slots[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        step *= 2
    return order


def boundaries(raw, order, length: int):
    """Whether each place of the sorted suffixes begins a new interval: its common prefix with the one before is shorter
    than ``length``. Breadth-first backward extension on the Burrows-Wheeler transform.

    Let a place of common prefix l lie between two suffixes. In the interval from it to the next known place, the first
    occurrence of each byte c in the transform is led by the last-to-first map to a suffix that begins with c, whose common
    prefix with the one before is at most l + 1. If that place isn't known by now, it is exactly l + 1.
    """
    import numpy as np

    n = len(raw)
    bwt = raw[order - 1]
    by_byte = np.argsort(bwt, kind="stable")
    to_first = np.empty(n, np.int64)
    to_first[by_byte] = np.arange(n)
    # The occurrence before of the same byte.
    heads = np.concatenate([[True], bwt[by_byte][1:] != bwt[by_byte][:-1]])
    earlier = np.empty(n, np.int64)
    earlier[by_byte[1:]] = by_byte[:-1]
    earlier[by_byte[heads]] = -1
    known = np.zeros(n, bool)
    fresh = np.flatnonzero(heads)  # common prefix 0: where first bytes change
    known[fresh] = True
    for _ in range(length - 1):
        if not len(fresh):
            break
        places = np.flatnonzero(known)
        after = np.searchsorted(places, fresh, side="right")
        size = np.append(places, n)[after] - fresh
        begin = np.repeat(fresh, size)
        inside = np.arange(len(begin)) - np.repeat(np.cumsum(size) - size, size) + begin
        target = to_first[inside[earlier[inside] < begin]]
        fresh = np.sort(target[~known[target]])
        known[fresh] = True
    return known


def repeated(texts: list[bytes], rank, length: int):
    """For each context, by runs of strings that start in an earlier one: (context, first start, last start). ``rank`` is
    the order of the contexts' earliest occurrences."""
    import numpy as np

    raw = np.frombuffer(b"\0" + b"\0".join(texts) + b"\0" * 8, np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = 1 + np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    order = sorted_suffixes(raw, length + 1)
    interval = np.cumsum(boundaries(raw, order, length)) - 1
    # Starts of whole strings: these hold no separator, others aren't looked at.
    owner = np.full(len(raw), -1, np.int64)
    n = size - length + 1
    strings = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    owner[strings] = np.repeat(np.arange(len(texts)), n)
    held = owner[order]
    some = np.flatnonzero(held >= 0)
    at, who, group = order[some], held[some], interval[some]
    firsts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    least = np.minimum.reduceat(rank[who], firsts)
    least = np.repeat(least, np.diff(np.append(firsts, len(some))))
    gone = np.zeros(len(raw) + 1, bool)
    gone[at[least < rank[who]]] = True
    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(np.int8)))
    a, z = edge[0::2], edge[1::2] - 1
    which = owner[a]
    return which, a - begin[which], z - begin[which]


def judged(found: DataFrame, parts: int, length: int) -> DataFrame:
    """SPAN of what goes, of CONTEXT rows."""
    import pyarrow as pa

    schema = pa.schema([("row", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])

    def spans(row, start, end):
        return pa.RecordBatch.from_arrays([pa.array(row), pa.array(start.astype("int32")), pa.array(end.astype("int32"))], schema=schema)

    def block(t):
        import numpy as np

        coded = t.column("context").combine_chunks().dictionary_encode()
        code, texts = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        row, start, end = (t.column(c).to_numpy() for c in ("row", "start", "end"))
        order = np.lexsort((start, row))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        rank = np.full(len(texts), len(order), np.int64)
        np.minimum.at(rank, code, place)
        # Every string of a context goes from all but the context's earliest occurrence; of that, what other contexts have.
        late = place > rank[code]
        yield spans(row[late], start[late], end[late])
        which, a, z = repeated(texts, rank, length)
        early = order[rank[which]]
        yield spans(row[early], start[early] + a, start[early] + z + length)

    def run(batches):
        import numpy as np

        held: list = []
        size = 0
        for b in batches:
            sure = b.column("context").is_null()
            if b.num_rows > b.column("context").null_count:
                own = b.filter(sure) if b.column("context").null_count else None
                rest = b.filter(pa.compute.invert(sure)) if own is not None else b
            else:
                own, rest = b, None
            if own is not None:
                yield pa.RecordBatch.from_arrays([own.column(c) for c in ("row", "start", "end")], schema=schema)
            if rest is None:
                continue
            held.append(rest)
            size += rest.column("context").nbytes
            if size >= BLOCK:
                # All contexts of an anchor belong into one block: the last anchor may go on.
                t = pa.Table.from_batches(held)
                keys = t.column("anchor").to_numpy()
                k = int(np.searchsorted(keys, keys[-1]))
                if k:
                    yield from block(t.slice(0, k))
                held = t.slice(k).combine_chunks().to_batches()
                size = sum(x.column("context").nbytes for x in held) if k else 0
        if held:
            yield from block(pa.Table.from_batches(held))

    def imported(batches):
        import pyarrow.compute  # noqa: F401

        return run(batches)

    dealt = found.repartition(parts, "anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(common.task(imported), SPAN)


def spans(spark: SparkSession, own: DataFrame, work: str, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(row, spans) of the rows of ``rows_of`` that lose anything: spans [start, end) in bytes, which may overlap."""
    long = own.filter(F.octet_length("text") >= length).withColumn("key", F.xxhash64("text"))
    places = common.cut(spark, recurring(anchors(long, length, gram)), f"{work}/places", "zstd")
    often = places.groupBy("hash").agg(F.count("*").alias("n")).filter(F.col("n") > hot).select("hash", F.lit(1).alias("hot"))
    often = common.cut(spark, often, f"{work}/hot")
    marked = places.join(often, "hash", "left").select("key", (F.col("pos").cast("long") * 2 + F.coalesce("hot", F.lit(0))).alias("place"))
    by_text = marked.groupBy("key").agg(F.collect_set("place").alias("places"))
    # A text goes through the shards once, for its first row; its later rows go whole.
    address = F.md5(F.col("text").cast("binary"))
    texts = common.cut(spark, long.select("row", "key", address.alias("address"), F.octet_length("text").alias("size")), f"{work}/texts", "zstd")
    first = texts.groupBy("address", "key").agg(F.min("row").alias("first"))
    copies = texts.join(first, ["address", "key"]).filter("row > first").select("row", F.lit(0).alias("start"), F.col("size").alias("end"))
    wanted = first.select("key", F.col("first").alias("row")).join(by_text, "key").select("row", "places")
    some = long.select("row", "text").join(wanted, "row").select("row", "text", "places")
    gone = judged(contexts(some, length, gram), common.partitions(spark), length).unionByName(copies)
    return gone.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


KEPT = "doc_id long, n_bytes long, removed_spans array<struct<start:int,end:int>>, kept binary"


def deduplicated(spark: SparkSession, docs: DataFrame, work: str, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, removed_spans, kept): what goes from each row of ``docs``, by its places in the UTF-8 bytes, and
    the bytes that stay."""
    import pyarrow as pa

    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed_spans", pa.list_(span)), ("kept", pa.binary())])

    def run(batches):
        import numpy as np

        for b in batches:
            size, starts, ends, at, kept = [], [], [], [0], []
            for text, found in zip(b.column("text"), b.column("spans")):
                raw = text.as_py().encode("utf-8", "replace")
                size.append(len(raw))
                if not found.is_valid:
                    kept.append(raw)
                    at.append(at[-1])
                    continue
                a, z = (found.values.field(k).to_numpy() for k in (0, 1))
                order = np.argsort(a, kind="stable")
                a, z = a[order], np.maximum.accumulate(z[order])
                # Spans that overlap or touch are one.
                opens = np.concatenate([[True], a[1:] > z[:-1]])
                a, z = a[opens], z[np.append(opens[1:], True)]
                starts.append(a)
                ends.append(z)
                at.append(at[-1] + len(a))
                kept.append(b"".join(raw[x:y] for x, y in zip([0, *z.tolist()], [*a.tolist(), len(raw)])))
            a, z = (pa.array(np.concatenate([np.zeros(0, np.int32), *x]), pa.int32()) for x in (starts, ends))
            listed = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays([a, z], fields=list(span)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(size, pa.int64()), listed, pa.array(kept, pa.binary())], schema=schema)

    own = rows_of(spark, docs, work)
    found = spans(spark, own, work, length, gram, hot)
    return own.join(found, "row", "left").select("doc_id", "text", "spans").mapInArrow(common.task(run), KEPT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: what is left of every text of ``documents`` without strings of 100 bytes that also start earlier."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = deduplicated(spark, docs, common.work_dir(spark, "suffix-dedup"))
    zero = F.lit(0).cast("long")
    n = F.aggregate("removed_spans", zero, lambda sum, s: sum + (s["end"] - s["start"]))
    return out.select("doc_id", "n_bytes", n.alias("n_removed"), F.size("removed_spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: All strings of 100 bytes by their digests, as hexadecimal texts.
SQL = f"""WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS raw, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, s, md5_number(h[2 * s + 1:2 * s + {2 * LENGTH}]) AS k FROM d, unnest(range(length(h) // 2 - {LENGTH} + 1)) t(s)),
f AS (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM w),
gone AS (SELECT doc_id, s, s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS gap FROM f WHERE r > 1),
runs AS (SELECT doc_id, s, sum(CASE WHEN gap <= {LENGTH} THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM gone),
spans AS (SELECT doc_id, min(s) AS a, max(s) + {LENGTH} AS b FROM runs GROUP BY doc_id, run),
cuts AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
told AS (SELECT c.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(h[2 * before + 1:2 * a], '' ORDER BY a) || any_value(h)[2 * max(b) + 1:] AS kept FROM cuts c JOIN d ON d.doc_id = c.doc_id GROUP BY c.doc_id)
SELECT d.doc_id, CAST(octet_length(raw) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(coalesce(unhex(kept), raw)) AS kept_sha256
FROM d LEFT JOIN told ON told.doc_id = d.doc_id"""
