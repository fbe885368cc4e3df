"""Best-fit packing by a grouping genetic algorithm on islands (operator 9).

Documents are encoded and cut into pieces of at most ``length`` tokens; a piece of full length is a sequence of its
own. The others are dealt by hash into blocks of about ``BLOCK`` pieces, so no task ever holds more than a block, and
every block is packed by ``ISLANDS`` populations with seeds of their own.

A solution is a list of bins, a bin the lengths of its documents; documents of equal length are alike until the end, so a
solution has its documents right if it has the right number of each length. Crossover injects a third of a parent's bins,
the well-filled ones first, whole; bins of the other parent whose documents are all left stay, the others are taken apart
(their documents are there twice, or displaced). Displaced documents first replace a shorter one where a bin then gets
fuller, and are then best-fitted. Mutation takes the emptiest bins and a few others apart in the same way. Fitness is the
number of bins, then the squared fill.

Each epoch evolves a kernel of ``KERNEL`` bins, the emptiest half and others drawn at random, so that a generation costs
little and the full bins of the rest stay. After it the best solution of every island migrates to the next island of its
block; the best of the last epoch is the block's packing. A search ends where a lower bound (Martello and Toth's L2) says
that no bin can be saved. Only (piece, length) rows and solutions move between tasks, never token ids.

Defined results: null text is empty, so its document is its end id alone; rows with equal or null ids and repeated rows are
packed each on their own; a very long text is cut into full pieces and one rest; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import common
from paperloom.llm.tokens import encoded

LENGTH = 1024
BLOCK = 8192
ISLANDS = 3
EPOCHS = 3
POPULATION = 5
#: Generations of an epoch; fewer if so many in a row save no bin.
GENERATIONS = 24
STALL = 6
KERNEL = 512

PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def cuts(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all full, the first perhaps shorter."""
    first = n % length or min(n, length)
    return [(0, first)] + [(s, length) for s in range(first, n, length)]


def pieces(docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH) -> DataFrame:
    """PIECES of every document; uid is unique."""
    import pyarrow as pa

    names = ("uid", "doc_id", "piece", "start", "length", "ids_crc32")
    schema = pa.schema([(n, pa.int32() if n == "piece" else pa.int64()) for n in names])

    def run(batches):
        from pyspark import TaskContext

        uid = TaskContext.get().partitionId() << 40
        out: list[tuple] = []
        for doc_id, raw in encoded(tokenizer, batches, end_id):
            for k, (s, n) in enumerate(cuts(len(raw) // 4, length)):
                out.append((uid, doc_id, k, s, n, zlib.crc32(raw[4 * s : 4 * (s + n)])))
                uid += 1
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return own.mapInArrow(common.task(run), PIECES)


class Pool:
    """Documents that are in no bin, by length: how many there are, and bit sets of their lengths and of what those leave."""

    def __init__(self, counts: list[int]):
        self.counts, self.length = counts, len(counts) - 1
        self.sizes = sum(1 << x for x, n in enumerate(counts) if n)
        self.rests = sum(1 << (self.length - x) for x, n in enumerate(counts) if n)

    def take(self, x: int) -> None:
        self.counts[x] -= 1
        if not self.counts[x]:
            self.sizes ^= 1 << x
            self.rests ^= 1 << (self.length - x)

    def give(self, x: int) -> None:
        if not self.counts[x]:
            self.sizes |= 1 << x
            self.rests |= 1 << (self.length - x)
        self.counts[x] += 1

    def longest(self, most: int) -> int:
        """The longest document of at most ``most``, or -1."""
        return (self.sizes & ((1 << (most + 1)) - 1)).bit_length() - 1

    def two(self, room: int, near: bool) -> tuple[int, int] | None:
        """Two documents that fill ``room`` exactly, as unlike as possible or as ``near`` to one another as possible."""
        both = self.sizes & (self.rests >> (self.length - room))
        if near:
            both &= (1 << (room // 2 + 1)) - 1
        x = both.bit_length() - 1
        if x < 1 or (2 * x == room and self.counts[x] < 2):
            return None
        return x, room - x


def counts_of(bins: list[list[int]], length: int) -> list[int]:
    out = [0] * (length + 1)
    for b in bins:
        for x in b:
            out[x] += 1
    return out


def replace(bins: list[list[int]], pool: Pool, rng, rounds: int) -> None:
    """Put longer documents of the pool in the place of shorter ones where bins have room, in place."""
    open_bins = [b for b in bins if sum(b) < pool.length]
    for _ in range(rounds):
        moved = False
        rng.shuffle(open_bins)
        for b in open_bins:
            room = pool.length - sum(b)
            gain, at = 0, None
            for i, x in enumerate(b):
                more = pool.longest(x + room) - x
                if more > gain:
                    gain, at = more, i
            if at is not None:
                pool.take(b[at] + gain)
                pool.give(b[at])
                b[at] += gain
                moved = True
        if not moved:
            break


def best_fit(bins: list[list[int]], pool: Pool, pairs: int = 0) -> list[list[int]]:
    """Put the pool's documents, longest first, into the fullest bins that hold them, in place; new bins are appended.

    A new bin that no single document fills up is filled by two if ``pairs`` is 1 (unlike ones) or 2 (near ones).
    """
    rooms: dict[int, list] = {}
    mask = 0
    for b in bins:
        if room := pool.length - sum(b):
            rooms.setdefault(room, []).append(b)
            mask |= 1 << room
    while pool.sizes:
        x = pool.sizes.bit_length() - 1
        pool.take(x)
        if fits := mask >> x:
            room = x + (fits & -fits).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
            b.append(x)
            room -= x
        else:
            b, room = [x], pool.length - x
            bins.append(b)
            if pairs and room and not pool.counts[room] and (two := pool.two(room, pairs == 2)):
                for y in two:
                    pool.take(y)
                b += two
                room = 0
        if room:
            rooms.setdefault(room, []).append(b)
            mask |= 1 << room
    return bins


def fitness(bins: list[list[int]]) -> tuple[int, int]:
    """(bins, minus the sum of squared fills): less is better."""
    return len(bins), -sum(sum(b) ** 2 for b in bins)


def crossover(a: list[list[int]], b: list[list[int]], counts: list[int], rng) -> list[list[int]]:
    """A child of a that holds about a third of b's bins, well-filled ones first, whole."""
    left = list(counts)
    noise = len(left) // 16

    def injected(bin_):
        for x in bin_:
            left[x] -= 1
        return list(bin_)

    child = [injected(x) for x in sorted(b, key=lambda x: -sum(x) - rng.random() * noise)[: max(1, len(b) // 3)]]
    for x in a:
        own = injected(x)
        if min(left[y] for y in x) < 0:
            for y in x:
                left[y] += 1
        else:
            child.append(own)
    pool = Pool(left)
    replace(child, pool, rng, 2)
    return best_fit(child, pool, rng.randrange(3))


def mutate(a: list[list[int]], length: int, rng) -> list[list[int]]:
    """Take the emptiest bins and a few others apart, and put what they held elsewhere."""
    order = sorted(range(len(a)), key=lambda i: sum(a[i]))
    gone = set(order[: rng.choice((2, 4, 8, 16, 32, 64))])
    gone |= {rng.randrange(len(a)) for _ in range(rng.choice((0, 2, 8, 32)))}
    pool = Pool(counts_of([a[i] for i in gone], length))
    child = [list(b) for i, b in enumerate(a) if i not in gone]
    replace(child, pool, rng, rng.choice((1, 4, 16)))
    return best_fit(child, pool, rng.randrange(3))


def bound(sizes, length: int) -> int:
    """No packing has fewer bins: the largest over t of those that documents longer than half a bin need by themselves, and
    what documents of at least t then can't put beside them."""
    import numpy as np

    n = np.bincount(np.asarray(sizes, dtype=np.int64), minlength=length + 1)
    count, words = np.cumsum(n), np.cumsum(n * np.arange(length + 1))
    half, t = length // 2, np.arange(length // 2 + 1)
    alone, more = count[length] - count[length - t], count[length - t] - count[half]
    beside = more * length - (words[length - t] - words[half])
    small = words[half] - np.where(t > 0, words[t - 1], 0)
    return int(np.max(alone + more + np.maximum(0, -(-(small - beside) // length))))


def evolve(sizes, population: list, seed: int, length: int = LENGTH, generations: int = GENERATIONS, size: int = POPULATION):
    """The best solution found for documents of ``sizes``. ``population`` may hold solutions of this and other islands."""
    import random

    rng = random.Random(seed)
    people = [p for p in population if p]
    came = len(people)
    if not people:
        counts = [0] * (length + 1)
        for x in sizes:
            counts[int(x)] += 1
        people = [best_fit([], Pool(list(counts)), pairs) for pairs in range(3)]
    people.sort(key=fitness)
    best, least = people[0], bound(sizes, length)
    if len(best) <= least:
        return best
    order = sorted(best, key=sum)
    rest = order[KERNEL // 2 :]
    rng.shuffle(rest)
    kernel, rest = order[: KERNEL // 2] + rest[: KERNEL // 2], rest[KERNEL // 2 :]
    counts = counts_of(kernel, length)
    # Of solutions that came from elsewhere, bins that the kernel's documents allow come in by crossover.
    ranked = [(fitness(kernel), kernel)]
    for other in people[1:came]:
        child = crossover(kernel, allowed(other, counts) or kernel, counts, rng)
        ranked.append((fitness(child), child))
    for pairs in range(max(0, size - len(ranked))):
        child = best_fit([], Pool(list(counts)), pairs) if pairs < 3 else mutate(kernel, length, rng)
        ranked.append((fitness(child), child))
    ranked.sort(key=lambda p: p[0])
    still = 0
    for _ in range(generations):
        top = ranked[0][0][0]
        if top + len(rest) <= least or still >= STALL:
            break
        i, j = rng.sample(range(len(ranked)), 2) if len(ranked) > 1 else (0, 0)
        for child in (crossover(ranked[i][1], ranked[j][1], counts, rng), mutate(ranked[rng.randrange(2) % len(ranked)][1], length, rng)):
            f = fitness(child)
            if all(f != g for g, _ in ranked):
                ranked.append((f, child))
        ranked.sort(key=lambda p: p[0])
        ranked = ranked[:size]
        still = 0 if ranked[0][0][0] < top else still + 1
    return rest + ranked[0][1]


def allowed(bins: list[list[int]], counts: list[int]) -> list[list[int]]:
    """Bins that ``counts`` have all documents of, the fullest first."""
    left, out = list(counts), []
    for b in sorted(bins, key=sum, reverse=True):
        for x in b:
            left[x] -= 1
        if min(left[x] for x in b) < 0:
            for x in b:
                left[x] += 1
        else:
            out.append(list(b))
    return out


def to_bytes(bins: list[list[int]]) -> bytes:
    import numpy as np

    return np.array([x for b in bins for x in (*b, 0)], dtype="<i4").tobytes()


def from_bytes(raw: bytes) -> list[list[int]]:
    import numpy as np

    flat = np.frombuffer(raw, "<i4")
    edges = np.flatnonzero(flat == 0).tolist()
    values = flat.tolist()
    return [values[a:b] for a, b in zip([0, *(e + 1 for e in edges)], edges)]


def seats(sizes, bins: list[list[int]]):
    """The bin of each document of ``sizes``; of equal lengths the first documents take the first bins."""
    import numpy as np

    lengths = np.array([x for b in bins for x in b], dtype=np.int64)
    of = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
    out = np.empty(len(lengths), dtype=np.int64)
    out[np.argsort(sizes, kind="stable")] = of[np.argsort(lengths, kind="stable")]
    return out


def pack(spark: SparkSession, rows: DataFrame, work: str, length: int = LENGTH) -> DataFrame:
    """PIECES without uid, with sequence_id and offset. Reads ``rows`` (pieces already written) more than once."""
    import numpy as np
    import pandas as pd

    full = rows.filter(F.col("length") == length)
    small = rows.filter(F.col("length") < length)
    blocks = max(1, -(-small.count() // BLOCK))
    small = small.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("long"))
    sizes = small.select("block", "uid", "length").withColumn("island", F.explode(F.array(*map(F.lit, range(ISLANDS)))))
    elites = "block long, island int, bins int, fill double, solution binary"

    def lengths(frame: pd.DataFrame):
        return frame.sort_values("uid", kind="stable")["length"].to_numpy(np.int64)

    def row(key, best):
        n, squares = fitness(best)
        return pd.DataFrame(
            {"block": [key[0]], "island": [key[1]], "bins": [n], "fill": [-float(squares)], "solution": [to_bytes(best)]}
        )

    def first(key, frame):
        return row(key, evolve(lengths(frame), [], 1000 * int(key[0]) + int(key[1]), length))

    def later(epoch):
        def run(key, frame, came):
            if not len(frame):
                return pd.DataFrame({"block": [], "island": [], "bins": [], "fill": [], "solution": []})
            met = [from_bytes(x) for x in came.sort_values("origin")["solution"]]
            return row(key, evolve(lengths(frame), met, 10**9 * epoch + 1000 * int(key[0]) + int(key[1]), length))

        return run

    state = common.cut(spark, sizes.groupBy("block", "island").applyInPandas(first, elites), f"{work}/epoch0")
    for epoch in range(1, EPOCHS):
        stay = state.select("block", "island", F.col("island").alias("origin"), "solution")
        moved = stay.withColumn("island", F.pmod(F.col("origin") + 1, F.lit(ISLANDS)).cast("int"))
        met = (stay.unionByName(moved) if ISLANDS > 1 else stay).groupBy("block", "island")
        state = sizes.groupBy("block", "island").cogroup(met).applyInPandas(later(epoch), elites)
        state = common.cut(spark, state, f"{work}/epoch{epoch}")
    best = state.groupBy("block").agg(F.max_by("solution", F.struct(-F.col("bins"), "fill", "island")).alias("solution"))

    columns = ["doc_id", "known", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    kind = "doc_id long, known boolean, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    def placed(key, frame, chosen):
        if not len(frame):
            return frame.assign(sequence_id=[], offset=[])[columns]
        frame = frame.sort_values("uid", kind="stable").reset_index(drop=True)
        at = seats(frame["length"].to_numpy(np.int64), from_bytes(chosen["solution"].iloc[0]))
        frame["sequence_id"] = (int(key[0]) << 32) + at
        frame["offset"] = frame.groupby("sequence_id")["length"].cumsum() - frame["length"]
        return frame[columns]

    # pandas has no null integers: ids go there whole, with a flag beside them.
    small = small.withColumn("known", F.col("doc_id").isNotNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))
    packed = small.groupBy("block").cogroup(best.groupBy("block")).applyInPandas(placed, kind)
    alone = full.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.withColumn("doc_id", F.when(F.col("known"), F.col("doc_id"))).drop("known").unionByName(alone)


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH) -> DataFrame:
    work = common.work_dir(spark, "packing")
    return pack(spark, common.cut(spark, pieces(docs, tokenizer, end_id, length), f"{work}/pieces"), work, length)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: all ``documents`` packed into sequences of 1024 tokens."""
    import public_tokenizers

    return pack_documents(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), 2)
