"""Chat formatting of preference pairs (operator 7).

A chosen and a rejected conversation share their first turns. Their longest common prefix of turns is rendered once as
the prompt; what follows on either side are the paired completions, each with the spans that count in training: the
text and end mark of the assistant's turns, [start, end) in code points.

Turns are numbered and compared row by row, so a long conversation or a frequent first turn needs no more memory than
other rows; a conversation meets in one row only when its output string is made.

Defined results: null role or text is empty; turns of equal number follow one another by role and text; rows without
conversation id are ignored; a side that is missing has a null completion, shares no prompt and leaves the other side
whole; two equal conversations have empty completions; repeated rows of turns are turns of their own, repeated pairs are
one; very long conversations need no more memory but for their output; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
TRAINED = "assistant"


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, role, text): turns in order, from 1."""
    rows = turns.filter("conv_id is not null").select(
        turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].cast("long").alias("turn"), F.coalesce(turns["role"].cast("string"), F.lit("")).alias("role"), F.coalesce(turns["text"].cast("string"), F.lit("")).alias("text")
    )
    order = W.Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rows.select("conv_id", F.row_number().over(order).alias("pos"), "role", "text")


def format_pairs(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row for each of ``pairs`` (pair_id, chosen_id, rejected_id); rows that are there twice count once."""
    rows, pairs = numbered(turns), pairs.select("pair_id", "chosen_id", "rejected_id").distinct()
    sides = pairs.select("pair_id", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("chosen_id").alias("conv_id")), F.struct(F.lit(1).alias("side"), F.col("rejected_id").alias("conv_id")))).alias("s")).select("pair_id", "s.*")
    told = rows.join(sides, "conv_id")
    # A place differs unless both sides have the same turn there.
    places = told.groupBy("pair_id", "pos").agg(F.count("*").alias("n"), F.min(F.struct("role", "text")).alias("a"), F.max(F.struct("role", "text")).alias("b"))
    same = (F.col("n") == 2) & (F.col("a") == F.col("b"))
    prompts = places.groupBy("pair_id").agg(F.coalesce(F.min(F.when(~same, F.col("pos") - 1)), F.max("pos")).alias("n_prompt"))
    shown = F.concat(F.lit(OPEN), "role", F.lit(CLOSE), "text", F.lit(END))
    told = told.join(prompts, "pair_id").withColumn("shown", shown).withColumn("part", F.when(F.col("pos") <= F.col("n_prompt"), F.lit("p")).when(F.col("side") == 0, F.lit("c")).otherwise(F.lit("r")))
    told = told.filter("part <> 'p' or side = 0")
    before = W.Window.partitionBy("pair_id", "part").orderBy("pos").rowsBetween(W.Window.unboundedPreceding, 0)
    told = told.withColumn("upto", F.sum(F.length("shown")).over(before))
    start = F.col("upto") - F.length("text") - len(END)
    span = F.when(F.col("role") == TRAINED, F.concat_ws(":", start.cast("string"), F.col("upto").cast("string")))
    told = told.select("pair_id", "side", "part", "pos", "n_prompt", "shown", span.alias("span"))
    joined = lambda part, what, by: F.array_join(F.transform(F.array_sort(F.collect_list(F.when((F.col("part") == part) & F.col(what).isNotNull(), F.struct("pos", F.col(what).alias("v"))))), lambda x: x["v"]), by)
    # A side is there if any turn of it is; the prompt's turns stand for both.
    there = lambda k: F.max(((F.col("side") == k) | (F.col("part") == "p")).cast("int")) == 1
    out = told.groupBy("pair_id").agg(
        F.max("n_prompt").cast("long").alias("n_prompt_turns"), joined("p", "shown", "").alias("prompt"),
        F.when(there(0), joined("c", "shown", "")).alias("chosen"), F.when(there(1), joined("r", "shown", "")).alias("rejected"),
        F.when(there(0), joined("c", "span", ",")).alias("chosen_spans"), F.when(there(1), joined("r", "span", ",")).alias("rejected_spans"),
    )
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: all ``conversations``, those of ids 2k (chosen) and 2k + 1 (rejected) paired."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    pairs = turns.filter("conv_id is not null").select(F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id")).distinct()
    return format_pairs(turns, pairs.select("pair_id", (F.col("pair_id") * 2).alias("chosen_id"), (F.col("pair_id") * 2 + 1).alias("rejected_id")))


SQL = """
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(floor(conv_id / 2.0) AS BIGINT) AS pair_id,
         conv_id - 2 * CAST(floor(conv_id / 2.0) AS BIGINT) AS side, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
differ AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.pos, b.pos) AS pos,
         (a.pos IS NOT NULL AND b.pos IS NOT NULL AND a.role = b.role AND a.text = b.text) AS same
  FROM (SELECT * FROM t WHERE side = 0) a FULL JOIN (SELECT * FROM t WHERE side = 1) b ON a.pair_id = b.pair_id AND a.pos = b.pos),
p AS (
  SELECT pair_id, coalesce(min(CASE WHEN same THEN NULL ELSE pos - 1 END), max(pos)) AS n_prompt FROM differ GROUP BY pair_id),
s AS (
  SELECT t.*, p.n_prompt, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown,
         CASE WHEN t.pos <= p.n_prompt THEN 'p' WHEN side = 0 THEN 'c' ELSE 'r' END AS part
  FROM t JOIN p ON t.pair_id = p.pair_id),
u AS (
  SELECT *, sum(length(shown)) OVER (PARTITION BY pair_id, part ORDER BY pos) AS upto FROM s WHERE part <> 'p' OR side = 0),
v AS (
  SELECT *, CASE WHEN role = 'assistant' THEN CAST(upto - length(text) - 8 AS BIGINT) || ':' || CAST(upto AS BIGINT) END AS span FROM u),
sides AS (
  SELECT pair_id, max(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS c, max(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS r FROM t GROUP BY pair_id)
SELECT v.pair_id, CAST(max(n_prompt) AS BIGINT) AS n_prompt_turns,
       coalesce(string_agg(CASE WHEN part = 'p' THEN shown END, '' ORDER BY pos), '') AS prompt,
       CASE WHEN max(c) = 1 THEN coalesce(string_agg(CASE WHEN part = 'c' THEN shown END, '' ORDER BY pos), '') END AS chosen,
       CASE WHEN max(r) = 1 THEN coalesce(string_agg(CASE WHEN part = 'r' THEN shown END, '' ORDER BY pos), '') END AS rejected,
       CASE WHEN max(c) = 1 THEN coalesce(string_agg(CASE WHEN part = 'c' THEN span END, ',' ORDER BY pos), '') END AS chosen_spans,
       CASE WHEN max(r) = 1 THEN coalesce(string_agg(CASE WHEN part = 'r' THEN span END, ',' ORDER BY pos), '') END AS rejected_spans
FROM v JOIN sides ON v.pair_id = sides.pair_id GROUP BY v.pair_id
"""
