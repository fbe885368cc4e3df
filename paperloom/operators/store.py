"""The corpus store: snapshot-versioned Parquet tables under one base path.

A keyed table is split into buckets by a hash of its key, others are one bucket. How many is part of each snapshot: a store
that is opened with another number keeps that of its tables until ``rebucket`` deals them anew. A write puts the buckets that it
changes into a new folder and then commits a manifest, which names the folder of every bucket: readers see the old snapshot
or the new one, older snapshots are backups that share unchanged buckets, and no write reads a folder it replaces. A
manifest is written aside and moved to ``commits/<n>``; if another writer has taken that number, the write raises and
nothing has changed. All file access goes through Spark's file system layer, so any store that Spark can reach will do.

A commit may carry a mark, the name of the run or the batch that made it. A write whose mark is there already is done: it
changes nothing and gives the snapshot that it made, so a run that broke off can be repeated under its name. Restoring an
older snapshot doesn't take marks back.

Files are sorted by key within a bucket and hold bloom filters of pmid and doi, so a lookup skips the row groups without it;
a lookup by the table's own key reads one bucket.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from paperloom import schema, shared
from paperloom.functions.falsy import filled
from paperloom.functions.text import query_hash
from paperloom.operators import corpus

TABLES = {
    "papers": schema.PAPER_DDL, "queries": schema.QUERIES_DDL, "collection_runs": schema.RUNS_DDL, "failed_dois": schema.FAILED_DDL,
    "query_cache": schema.CACHE_DDL, "rejects": schema.REJECTS_DDL,
}
KEYS = {"papers": "pmid", "failed_dois": "doi", "query_cache": "query_hash", "rejects": "digest"}
#: Of rows with one key in one batch the last by this column stays.
ORDER = {"papers": "collection_date", "failed_dois": "timestamp", "query_cache": "cached_date", "rejects": "timestamp"}
#: Columns with bloom filters, beside a table's key.
LOOKED_UP = {"papers": ("doi",), "failed_dois": ("pmid",)}
BUCKETS = 32
#: Bits of the map of a batch's keys, whatever their number: 1,024 rows of 4 KB.
SLOTS = 1 << 25


class CorpusStore:
    def __init__(self, spark: SparkSession, base: str, buckets: int = BUCKETS):
        self.spark, self.base, self.buckets = spark, base.rstrip("/"), buckets

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return None

    # Snapshots

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        p = self._path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self, table: str) -> list[int]:
        p, fs = self._fs(f"{self.base}/{table}/commits")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n) for n in names if n.isdigit())

    def version(self, table: str) -> int:
        """The current snapshot's number; 0 if there is none."""
        return max(self.versions(table), default=0)

    def manifest(self, table: str, version: int) -> dict[int, str]:
        """The folder of each bucket of a snapshot; buckets without rows have none."""
        if not version:
            return {}
        return {int(k): path for k, path in self._lines(table, version) if k.isdigit()}

    def _lines(self, table: str, version: int) -> list[tuple[str, str]]:
        rows = self.spark.read.text(f"{self.base}/{table}/commits/{version}").collect()
        return [(k, value) for k, _, value in (r[0].partition(" ") for r in rows if r[0])]

    def buckets_of(self, table: str, version: int | None = None) -> int:
        """By how many buckets a snapshot's rows are dealt. A table without snapshots gets what the store was opened with."""
        version = self.version(table) if version is None else version
        told = dict(self._lines(table, version)).get("buckets") if version else None
        return int(told) if told else self.buckets

    def marked(self, table: str, mark: str | None) -> int | None:
        """The snapshot that the write of this mark committed, if there is one."""
        if mark is None or not self.versions(table):
            return None
        lines = self.spark.read.text(f"{self.base}/{table}/commits").select("value", "_metadata.file_name")
        hit = lines.filter(F.col("value") == f"mark {mark}").agg(F.max(F.col("file_name").cast("int"))).first()
        return hit[0]

    def _commit(
        self, table: str, version: int, manifest: dict[int, str], buckets: int | None = None, mark: str | None = None
    ) -> None:
        buckets = self.buckets if buckets is None else buckets
        if mark is not None and (mark != mark.strip() or "\n" in mark):
            raise ValueError("a mark is one line without blanks at its ends")
        p, fs = self._fs(f"{self.base}/{table}/commits/.{version}-{uuid.uuid4().hex}")
        out = fs.create(p, False)
        lines = [f"buckets {buckets}", *(f"{k} {v}" for k, v in sorted(manifest.items()))]
        lines += [f"mark {mark}"] if mark is not None else []
        out.write(bytearray("\n".join(lines).encode()))
        out.close()
        to = self._path(f"{self.base}/{table}/commits/{version}")
        if fs.exists(to) or not fs.rename(p, to):
            fs.delete(p, False)
            raise RuntimeError(f"{table}: another writer has committed snapshot {version}")

    def _rows(self, table: str, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], TABLES[table])
        df = self.spark.read.option("mergeSchema", True).parquet(*(f"{self.base}/{table}/{p}" for p in paths))
        for f in schema.T.StructType.fromDDL(TABLES[table]):
            if f.name not in df.columns:
                df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
        return df.withColumn("source", F.coalesce("source", F.lit("PubMed"))) if table == "papers" else df

    def read(self, table: str, version: int | None = None) -> DataFrame:
        manifest = self.manifest(table, self.version(table) if version is None else version)
        return self._rows(table, sorted(manifest.values()))

    def _bucket(self, table: str, buckets: int) -> Column:
        return F.pmod(F.xxhash64(KEYS[table]), F.lit(buckets)).cast("int") if table in KEYS else F.lit(0)

    def _put(self, table: str, df: DataFrame, buckets: int, dealt: bool = False, folder: str | None = None) -> dict[int, str]:
        """Write rows as buckets into a new folder, or beside those of ``folder``: {bucket: folder}. Large buckets are spread
        over tasks, small ones not. ``dealt``: the rows are, and have their column _bucket."""
        folder = folder or f"data-{uuid.uuid4().hex[:12]}"
        rows = df if dealt else df.withColumn("_bucket", self._bucket(table, buckets)).hint("rebalance", "_bucket")
        if table in KEYS:
            rows = rows.sortWithinPartitions("_bucket", KEYS[table])
        # A filter is as large as its file's values need: a bucket has several files.
        out = rows.write.mode("append").partitionBy("_bucket").option("compression", "zstd")
        out = out.option("parquet.bloom.filter.adaptive.enabled", "true")
        for c in (KEYS.get(table), *LOOKED_UP.get(table, ())):
            if c:
                out = out.option(f"parquet.bloom.filter.enabled#{c}", "true")
        out.parquet(f"{self.base}/{table}/{folder}")
        p, fs = self._fs(f"{self.base}/{table}/{folder}")
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return {int(n.partition("=")[2]): f"{folder}/{n}" for n in names if n.startswith("_bucket=")}

    def write(self, table: str, df: DataFrame) -> int:
        """A whole new snapshot."""
        v, n = self.version(table) + 1, self.buckets_of(table)
        self._commit(table, v, self._put(table, df, n), n)
        return v

    def rebucket(self, table: str, buckets: int) -> int:
        """The same rows dealt by another number of buckets: more of them, and an upsert rewrites a smaller part."""
        v = self.version(table) + 1
        self._commit(table, v, self._put(table, self.read(table), buckets), buckets)
        return v

    def restore(self, table: str, version: int) -> int:
        """Make an older snapshot current again, as a new one. No row is moved."""
        v = self.version(table) + 1
        self._commit(table, v, self.manifest(table, version), self.buckets_of(table, version))
        return v

    # Mutations

    def upsert(self, table: str, rows: DataFrame, mark: str | None = None, fresh: bool = False) -> int:
        """Whole rows by the table's key; what comes now replaces what is there; rows without key are refused.

        Only buckets that the new keys fall into are read and written again. Under a mark that is there already
        nothing is done; ``fresh`` says that the caller knows it not to be there.
        """
        if not fresh and (done := self.marked(table, mark)) is not None:
            return done
        key, kinds = KEYS[table], schema.T.StructType.fromDDL(TABLES[table])
        known = {c.lower() for c in rows.columns}
        cast = lambda f: (F.col(f.name) if f.name.lower() in known else F.lit(None)).cast(f.dataType)
        new = rows.select(*(cast(f).alias(f.name) for f in kinds)).filter(F.col(key).isNotNull())
        v = self.version(table) + 1
        manifest, n = self.manifest(table, v - 1), self.buckets_of(table, v - 1)
        # What comes may be a long plan: it is evaluated once, by the write that deals it out.
        put = self._put(table, self._last(table, new, None, n), n, dealt=True)
        if manifest and put:
            keys = self._rows(table, sorted(put.values())).select(key)
            old = self._old(table, manifest, set(put)).select(*new.columns)
            folder = next(iter(put.values())).partition("/")[0]
            self._put(table, self._kept(table, keys, old, n), n, dealt=True, folder=folder)
        self._commit(table, v, manifest | put, n, mark)
        return v

    def _old(self, table: str, manifest: dict[int, str], touched: set[int]) -> DataFrame:
        return self._rows(table, sorted(p for k, p in manifest.items() if k in touched))

    def _last(self, table: str, new: DataFrame, old: DataFrame | None, n: int, gone: bool = False) -> DataFrame:
        """The last row of each key, those of ``new`` before those of ``old``; ``gone``: none of the keys of ``new``. Rows
        move once, to parts of their buckets, where they are sorted by key; no row is joined or dealt again to be written."""
        key = KEYS[table]
        others = [c for c in new.columns if c != key]
        rank = F.struct(F.lit(1).alias("come"), F.col(ORDER[table]).alias("at"), F.xxhash64(*others).alias("tie"))
        rows = new.withColumn("_rank", rank)
        if old is not None:
            rank = F.struct(F.lit(0).alias("come"), F.col(ORDER[table]).alias("at"), F.lit(0).cast("long").alias("tie"))
            rows = old.select(*new.columns).withColumn("_rank", rank).unionByName(rows)
        # Several parts of buckets a task, so that tasks are about even and a bucket has a few files.
        parts = -(-4 * int(self.spark.conf.get("spark.sql.shuffle.partitions")) // n)
        dealt = rows.withColumns({"_bucket": self._bucket(table, n), "_part": F.pmod(F.hash(key), F.lit(parts))})
        dealt = dealt.repartition("_bucket", "_part")
        last = dealt.groupBy("_bucket", key, "_part").agg(F.max_by(F.struct("_rank", *others), "_rank").alias("r"))
        last = last.filter("r._rank.come = 0") if gone else last
        return last.select(*(F.col(c) if c == key else F.col(f"r.`{c}`").alias(c) for c in new.columns), "_bucket")

    def _kept(self, table: str, keys: DataFrame, old: DataFrame, n: int) -> DataFrame:
        """The old rows whose key is none of ``keys``, with their bucket. They are written by the tasks that read them and
        don't move, nor do those that go; only rows in a slot that a key to keep shares with one of ``keys`` meet these."""
        key = KEYS[table]
        hit = self._hit(keys, key)
        met = self._met(old, hit, key, True)
        spared = met.select(key).join(keys, key, "left_anti")
        unclear = self._met(met, self._hit(spared, key), key, True)
        none = {f.name: F.lit(None).cast(f.dataType) for f in old.schema if f.name != key}
        gone = keys.withColumns(none).select(*old.columns)
        stay = self._met(old, hit, key, False).withColumn("_bucket", self._bucket(table, n))
        return stay.unionByName(self._last(table, gone, unclear, n, gone=True))

    @staticmethod
    def _slot(key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(SLOTS)) + 1

    def _hit(self, new: DataFrame, key: str) -> DataFrame:
        """(_page, _bits): the slots that keys of ``new`` fall into, a bit each."""
        slot = self._slot(key)
        pages = new.groupBy(F.bitmap_bucket_number(slot).alias("_page"))
        return pages.agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits"))

    def _met(self, old: DataFrame, hit: DataFrame, key: str, met: bool) -> DataFrame:
        """The old rows whose slot is hit, which a new row may replace; not ``met``: the others, which none does."""
        slot = self._slot(key)
        at = F.bitmap_bit_position(slot)
        byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        is_hit = F.coalesce(F.expr("getbit(_byte, _at)") == 1, F.lit(False))
        rows = old.withColumn("_page", F.bitmap_bucket_number(slot)).join(F.broadcast(hit), "_page", "left")
        rows = rows.withColumns({"_byte": byte, "_at": F.pmod(at, F.lit(8)).cast("int")})
        return rows.filter(is_hit if met else ~is_hit).select(*old.columns)

    def delete(self, table: str, keys: DataFrame) -> int:
        key, v = KEYS[table], self.version(table) + 1
        manifest, n = self.manifest(table, v - 1), self.buckets_of(table, v - 1)
        path = shared.folder(self.spark, f"delete-{table}")
        gone = keys.select(F.col(key).cast(schema.T.StructType.fromDDL(TABLES[table])[key].dataType).alias(key))
        gone = shared.written(self.spark, gone.filter(F.col(key).isNotNull()).distinct(), path)
        touched = {r[0] for r in gone.select(self._bucket(table, n)).distinct().collect()}
        kept = {k: p for k, p in manifest.items() if k not in touched}
        if touched:
            old = self._old(table, manifest, touched)
            kept |= self._put(table, self._kept(table, gone, old, n), n, dealt=True)
        self._commit(table, v, kept, n)
        shared.drop(self.spark, path)
        return v

    def append(self, table: str, rows: DataFrame, mark: str | None = None) -> int:
        """Rows with the next ids, in the order of their columns; for tables with an id. Gives the first of these ids. Under
        a mark that is there already nothing is appended, and the ids are those given then."""
        if (done := self.marked(table, mark)) is not None:
            before = self.read(table, done - 1) if done > 1 else self.read(table, done).limit(0)
            return before.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0] + 1
        v = self.version(table) + 1
        old = self.read(table, v - 1)
        last = old.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        # A run or a query is a row or a few: their numbering in one task is bounded by what a user enters at once.
        order = W.Window.orderBy(*rows.columns)
        new = rows.withColumn("id", (F.row_number().over(order) + last).cast("long"))
        n = self.buckets_of(table, v - 1)
        self._commit(table, v, self._put(table, old.unionByName(new.select(*old.columns)), n), n, mark)
        return last + 1

    # Lookups

    def exists(self, ids: DataFrame, by: str = "pmid") -> DataFrame:
        return ids.filter(filled(F.col(by))).join(self.read("papers").select(by), by, "left_semi")

    def paper(self, value: str, by: str = "pmid") -> DataFrame:
        """The paper of a pmid, which is in one bucket, or the first of a DOI, by the files' bloom filters."""
        v = self.version("papers")
        manifest = self.manifest("papers", v)
        if by == KEYS["papers"]:
            asked = self.spark.range(1).select(F.lit(value).alias(by))
            place = asked.select(self._bucket("papers", self.buckets_of("papers", v))).first()[0]
            manifest = {k: p for k, p in manifest.items() if k == place}
        return self._rows("papers", sorted(manifest.values())).filter(F.col(by) == value).orderBy("pmid").limit(1)

    def with_full_text(self, flag: bool = True) -> DataFrame:
        return self.read("papers").filter(F.col("is_full_text_pmc") == flag)

    def by_query(self, query_id: int) -> DataFrame:
        return self.read("papers").filter(F.col("query_id") == query_id)

    def by_mesh(self, term: str, query_id: int | None = None) -> DataFrame:
        rows = self.read("papers") if query_id is None else self.by_query(query_id)
        return rows.filter(F.array_contains("mesh_terms", term) & filled(F.col("doi"))).select("doi")

    def queries(self) -> DataFrame:
        return self.read("queries").orderBy("id")

    def statistics(self) -> DataFrame:
        return corpus.store_statistics(self.read("papers"), self.read("failed_dois"))

    # Query cache

    def cached(self, query: str, max_results: int) -> DataFrame | None:
        """Ids of a cached query, unless the entry was made with a smaller limit that it filled."""
        h = self.spark.range(1).select(query_hash(F.lit(query)).alias("query_hash"))
        enough = (F.col("count") < F.col("max_results")) | (F.col("max_results") >= max_results)
        hit = self.read("query_cache").join(h, "query_hash").filter(enough)
        return None if hit.isEmpty() else hit.select(F.explode(F.slice("pmids", 1, max_results)).alias("pmid"))

    def put_cache(self, query: str, pmids: list[str], max_results: int, date: str) -> int:
        kind = "query string, pmids array<string>, count int, max_results int, cached_date string"
        row = self.spark.createDataFrame([(query, pmids, len(pmids), max_results, date)], kind)
        shown = F.when(
            F.length("query") > 200, F.concat(F.substring("query", 1, 200), F.lit("..."))
        ).otherwise(F.col("query"))
        return self.upsert(
            "query_cache", row.withColumn("query_hash", query_hash(F.col("query"))).withColumn("query", shown)
        )

    def cache_entries(self) -> DataFrame:
        """The cached queries, newest first, without their ids."""
        return self.read("query_cache").drop("pmids").orderBy(F.desc("cached_date"), "query_hash")

    def cache_info(self) -> DataFrame:
        """One row: entries, ids in them, and the bytes of the cache's files."""
        size = 0
        for path in self.manifest("query_cache", self.version("query_cache")).values():
            p, fs = self._fs(f"{self.base}/query_cache/{path}")
            size += fs.getContentSummary(p).getLength()
        told = self.read("query_cache").agg(
            F.count("*").alias("entries"), F.coalesce(F.sum("count"), F.lit(0)).alias("ids")
        )
        return told.select("*", F.lit(size).cast("long").alias("bytes"), F.round(F.lit(size / 1024), 2).alias("kb"))

    def clear_cache(self) -> int:
        return self.write("query_cache", self.spark.createDataFrame([], TABLES["query_cache"]))
