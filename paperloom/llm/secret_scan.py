"""Secret scans over an incremental blob ledger (operator 2), in DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its content. The ledger has, for each blob, the
rule versions that have scanned it and what they found. A scan reads only pairs of blob and rule version that the
ledger lacks, each blob once however many paths and versions have it, appends to the ledger, and joins findings back
to all paths. Hashes are compared first, and texts of unseen blobs only are moved.

The ledger is a folder of Parquet batches, each named by a hash of the pairs of blob and rule version that it scanned, so a
repeated scan of the same pairs is the same batch. Batches are only ever added; ``compact`` puts them together. A pair that
two batches hold (concurrent scans) counts once, since spans are made distinct when they are read.

Spans are [start, end) in code points, leftmost and non-overlapping for each kind. SQL's regex functions give matches
but no places: texts are split at the matches, and running sums of the lengths of gaps and matches give the places.

Defined results: null content is empty and has no findings; rows of equal or null paths get their content's findings
each; repeated rows are one blob; a very long text is scanned whole, each finding a row of its own until they are
collected again; findings of equal places follow one another in the order of ``RULES``; an empty table gives an empty
result; other columns of the input are ignored (``redact`` passes them through, whatever their names).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from paperloom.llm import common


@dataclass(frozen=True)
class Rule:
    """``guard`` is a necessary condition that costs one pass over the text; ``least`` is on the group's characters."""

    kind: str
    version: int
    pattern: str
    guard: str
    group: int = 0
    least: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


_VALUE = r"[A-Za-z0-9+/_.=-]"
_ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"

#: The base kinds, then those that the ledger's own rules add. Order is that of kinds within a place.
RULES = (
    Rule("assign", 1, f"{_ASSIGN}({_VALUE}+)", f"{_ASSIGN}{_VALUE}{{8}}", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}", r"AKIA[A-Z0-9]{12}"),
    Rule("hex", 1, r"[0-9a-f]{32,}", r"[0-9a-f]{32}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----", "-----BEGIN "),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", r"eyJ[A-Za-z0-9_-]{8}"),
    Rule("bearer", 1, r"(?i)bearer\x20+[A-Za-z0-9+/_.=-]{16,}", r"(?i)bearer\x20"),
)
BASE = ("assign", "access", "hex")
CELL_BITS = 17
CHUNK = 4_096

SPAN = "struct<start:bigint,rank:int,kind:string,end:bigint,rule:string>"


def _parts(text: Column, rule: Rule, rank: int) -> Column:
    """For each match of a rule: its number, the lengths of the gap before it and of itself, and whether it counts."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    checked = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.least else matches
    rows = F.transform(
        F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), matches.alias("found"), checked.alias("checked")),
        lambda x, i: F.struct(
            F.lit(rank).alias("rank"), i.alias("i"), F.length(x["gap"]).cast("long").alias("gap"), F.length(x["found"]).cast("long").alias("found"), (F.length(x["checked"]) >= rule.least).alias("good")
        ),
    )
    return F.when(F.rlike(text, F.lit(rule.guard)), rows)


def scan_blobs(blobs: DataFrame, rules=RULES) -> DataFrame:
    """(blob, rules, spans) of (blob, text, todo): runs the rules of ``todo`` (names) over each whole text."""
    parts = F.concat(*(F.coalesce(F.when(F.array_contains("todo", r.name), _parts(F.col("text"), r, k)), F.array().cast("array<struct<rank:int,i:int,gap:bigint,found:bigint,good:boolean>>")) for k, r in enumerate(rules)))
    found = blobs.select("blob", F.col("todo").alias("rules"), parts.alias("parts"))
    order = W.Window.partitionBy("blob", "rank").orderBy("i").rowsBetween(W.Window.unboundedPreceding, 0)
    each = found.select("blob", "rules", F.explode_outer("parts").alias("p")).select("blob", "rules", "p.*")
    each = each.withColumn("end", F.sum(F.coalesce("gap", F.lit(0)) + F.coalesce("found", F.lit(0))).over(order))
    kind = F.element_at(F.array(*(F.lit(r.kind) for r in rules)), F.col("rank") + 1)
    name = F.element_at(F.array(*(F.lit(r.name) for r in rules)), F.col("rank") + 1)
    span = F.struct((F.col("end") - F.col("found")).alias("start"), "rank", kind.alias("kind"), "end", name.alias("rule"))
    return each.groupBy("blob").agg(F.first("rules").alias("rules"), F.array_sort(F.collect_list(F.when(F.col("good"), span))).alias("spans"))


def addressed(versions: DataFrame) -> DataFrame:
    """Adds ``_blob``, the address of ``text`` (null: empty)."""
    return versions.withColumn("_blob", F.sha2(common.text_of(versions).cast("binary"), 256))


LEDGER = f"blob string, rules array<string>, spans array<{SPAN}>"


def batches(spark: SparkSession, ledger: str) -> list[str]:
    """Paths of the ledger's whole batches."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger}/batches")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [x.getPath() for x in fs.listStatus(root)]
    return sorted(str(p) for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def names_of(paths: list[str]) -> set[str]:
    """Names of batches, without their folders: a path may be spelled in several ways."""
    return {p.rstrip("/").rsplit("/", 1)[-1] for p in paths}


def seen(spark: SparkSession, ledger: str) -> DataFrame | None:
    """(blob, rules, spans) of the ledger, one row a blob, or None if nothing has been written."""
    paths = batches(spark, ledger)
    if not paths:
        return None
    rows = spark.read.schema(LEDGER).parquet(*paths)
    if len(paths) == 1:
        return rows  # one batch has one row a blob
    every = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))
    return rows.groupBy("blob").agg(every("rules").alias("rules"), F.array_sort(every("spans")).alias("spans"))


def update(spark: SparkSession, versions: DataFrame, ledger: str, rules=RULES) -> int:
    """Scan what the ledger lacks of ``versions`` (text; any other columns) and append it. Gives the blobs scanned."""
    names = F.array(*(F.lit(r.name) for r in rules))
    texts = addressed(versions.select(common.text_of(versions).alias("text")))
    todo = texts.select(F.col("_blob").alias("blob")).distinct()
    known = seen(spark, ledger)
    if known is None:
        todo = todo.withColumn("todo", names)
    else:
        lacks = F.array_except(names, F.coalesce("rules", F.array().cast("array<string>")))
        todo = todo.join(known.select("blob", "rules"), "blob", "left").select("blob", lacks.alias("todo"))
    pending = common.work_dir(spark, "ledger-todo")
    todo = common.cut(spark, todo.filter(F.size("todo") > 0), pending)
    # Sums of hashes don't depend on the order of rows; two of them make a name of 128 bits.
    part = lambda seed: F.hex(F.bit_xor(F.xxhash64(F.lit(seed), "blob", F.array_join("todo", ","))))
    told = todo.agg(F.count("*").alias("n"), part(1).alias("x"), part(2).alias("y")).first()
    name = f"{told['x']}{told['y']}".lower()
    if told["n"] and name not in names_of(batches(spark, ledger)):
        # Of the texts, those whose blob may be unseen meet by blob, each task's repeats put together first.
        wanted = texts if known is None else texts.filter(may_hold(todo.withColumnRenamed("blob", "_blob")))
        blobs = wanted.groupBy(F.col("_blob").alias("blob")).agg(F.first("text").alias("text"))
        scan_blobs(blobs.join(todo, "blob"), rules).write.mode("overwrite").parquet(f"{ledger}/batches/{name}")
        if name not in names_of(batches(spark, ledger)):
            raise RuntimeError(f"{ledger}: batch {name} was written and isn't listed")
    common.drop(spark, pending)
    return told["n"]


def compact(spark: SparkSession, ledger: str) -> None:
    """Put all batches of a ledger into one. If this is cut short, both forms are there, which counts as one."""
    paths = batches(spark, ledger)
    if len(paths) > 1:
        name = hashlib.sha256("\n".join(p.rsplit("/", 1)[-1] for p in paths).encode()).hexdigest()[:32]
        seen(spark, ledger).write.mode("overwrite").parquet(f"{ledger}/batches/{name}")
        for p in paths:
            common.drop(spark, p)


def findings(spark: SparkSession, versions: DataFrame, ledger: str, rules=RULES) -> DataFrame:
    """``versions`` with ``_blob`` and ``_spans`` by the current rules, from the ledger. Only blobs with spans are joined."""
    return attached(spark, addressed(versions.drop("_spans")), found(spark, ledger, rules), "_spans")


def found(spark: SparkSession, ledger: str, rules=RULES) -> DataFrame:
    """(_blob, _spans) of the ledger's blobs that have any span by ``rules``."""
    current = F.array(*(F.lit(r.name) for r in rules))
    spans = F.filter("spans", lambda s: F.array_contains(current, s["rule"]))
    known = seen(spark, ledger)
    known = spark.createDataFrame([], LEDGER) if known is None else known
    return known.select(F.col("blob").alias("_blob"), spans.alias("_spans")).filter(F.size("_spans") > 0)


def attached(spark: SparkSession, rows: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """``rows`` with the array ``column`` of ``known`` by ``_blob``; empty where that lacks the blob."""
    # Written first, so that the join is a plain one of two tables, whose frequent keys Spark splits.
    known = common.cut(spark, known, common.work_dir(spark, "findings"))
    empty, flag = F.array().cast(known.schema[column].dataType), may_hold(known)
    sure = rows.filter(~flag).withColumn(column, empty)
    perhaps = rows.filter(flag).join(known, "_blob", "left").withColumn(column, F.coalesce(column, empty))
    return sure.unionByName(perhaps.select(*sure.columns))


def may_hold(known: DataFrame) -> Column:
    """Whether ``_blob`` may be among ``known``, by a bitmap of 2**CELL_BITS cells (16 KB): rows that certainly aren't,
    mostly most of them, then need no join and their texts stay where they are."""
    cell = F.shiftrightunsigned(F.xxhash64("_blob"), 64 - CELL_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), cell.bitwiseAND(F.lit(63)).cast("int"))
    words = dict.fromkeys(range(1 << (CELL_BITS - 6)), 0)
    words |= {r["w"]: r["m"] for r in known.groupBy(F.shiftright(cell, 6).alias("w")).agg(F.bit_or(bit).alias("m")).collect()}
    table = F.array(*(F.lit(words[w]) for w in sorted(words))).cast("array<bigint>")
    return F.get(table, F.shiftright(cell, 6).cast("int")).bitwiseAND(bit) != 0


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def stretches(known: DataFrame) -> DataFrame:
    """(_blob, _kept) of (_blob, _spans): the stretches [a, b) of a text that no span covers, in order. The last, behind
    all spans, has a null b. Spans that overlap leave no stretch between them."""
    spans = known.select("_blob", F.explode("_spans").alias("s")).select("_blob", "s.start", "s.end")
    of = W.Window.partitionBy("_blob").orderBy("start", "end").rowsBetween(W.Window.unboundedPreceding, -1)
    upto = F.coalesce(F.max("end").over(of), F.lit(0).cast("long"))
    spans = spans.withColumn("a", upto)
    piece = F.when(F.col("start") >= F.col("a"), F.struct("a", F.col("start").alias("b")))
    tail = F.struct(F.max("end").alias("a"), F.lit(None).cast("long").alias("b"))
    grouped = spans.groupBy("_blob").agg(F.array_sort(F.collect_list(piece)).alias("pieces"), tail.alias("tail"))
    return grouped.select("_blob", F.concat("pieces", F.array("tail")).alias("_kept"))


def _cut_out(text: Column, kept: Column) -> Column:
    """The texts of stretches. Texts are cut into chunks first, as finding a place in a string takes its whole length."""
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    size = F.length(text).cast("long")
    div = lambda x: F.floor(x / CHUNK).cast("int")

    def piece(p):
        a, b = p["a"], F.coalesce(p["b"], size)
        some = F.array_join(F.slice(chunks, div(a) + 1, F.greatest(div(b - 1) - div(a) + 1, F.lit(0))), "")
        return F.when(b > a, F.substring(some, (a % CHUNK + 1).cast("int"), (b - a).cast("int"))).otherwise("")

    return F.transform(kept, piece)


def redact(spark: SparkSession, docs: DataFrame, ledger: str, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret replaced by ``mark``; overlapping spans are replaced as one. Other texts stay as they are."""
    update(spark, docs, ledger)
    # Other columns travel in a struct, so that no name can clash.
    others = F.struct(F.lit(0).alias("_none"), *(F.col(f"`{c}`") for c in docs.columns if c != "text"))
    rows = addressed(docs.select("text", others.alias("_rest")))
    rows = attached(spark, rows, stretches(found(spark, ledger)), "_kept")
    held = F.size("_kept") > 0
    rows = rows.select("_rest", F.when(held, F.array_join(_cut_out(F.col("text"), F.col("_kept")), mark)).otherwise(F.col("text")).alias("text"), held.alias("held"))

    def column(c: str) -> Column:
        if c == "text":
            return F.col("text")
        old = F.col("_rest").getField(c)
        if c == "n_chars":
            old = F.when(F.col("held"), F.length("text").cast(docs.schema[c].dataType)).otherwise(old)
        return old.alias(c)

    return rows.select(*map(column, docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: findings of every document; each is one version of the path that its id names."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ledger = common.work_dir(spark, "blob-ledger")
    update(spark, docs, ledger)
    rows = findings(spark, docs, ledger)
    count = lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = joined(F.filter("_spans", lambda s: s["kind"].isin(*BASE)))
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), *map(count, BASE), F.sha2(base.cast("binary"), 256).alias("base_sha256"), joined(F.col("_spans")).alias("spans"), F.col("_blob").alias("blob"))


def _rule_sql(rank: int, kind: str, pattern: str, group: int = 0, least: int = 0) -> str:
    """Matches of one rule as (doc_id, rank, kind, start, end): sums of the gaps and matches before each."""
    sums = "CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS BIGINT)"
    return f"""SELECT doc_id, {rank} AS rank, '{kind}' AS kind, {sums} AS start, {sums} + length(found[i]) AS stop FROM (
    SELECT doc_id, found, checked, gaps, unnest(range(1, len(found) + 1)) AS i FROM (
      SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS found, regexp_extract_all(t, '{pattern}', {group}) AS checked, string_split_regex(t, '{pattern}') AS gaps FROM d))
  WHERE length(checked[i]) >= {least}"""


_SQL_RULES = [
    ("assign", "(?i)(password|passwd|secret|token|api_?key)[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32), ("pem", "-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----"), ("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    ("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]+"), ("bearer", "(?i)bearer\\x20+[A-Za-z0-9+/_.=-]{16,}"),
]
_TOLD = "kind || ':' || start || ':' || stop, ',' ORDER BY start, rank"
SQL = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(_rule_sql(k, *r) for k, r in enumerate(_SQL_RULES))}),
told AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
  string_agg({_TOLD}) FILTER (WHERE rank < 3) AS base, string_agg({_TOLD}) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(t) AS blob
FROM d LEFT JOIN told ON d.doc_id = told.doc_id"""
