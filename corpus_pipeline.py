"""A training corpus from ``documents``: quality, near copies, secrets, mix, packed sequences.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last give the columns of ``documents``.

Defined results: a null text is empty, so the quality rules reject it; without them (each stage takes any table) it is no
near copy, holds no secret, is taken by the mix as a document without words, and is packed as its end id. Rows of equal or
null ids are judged, redacted, mixed and packed each on their own; near copies keep the row of the smallest id. Very long
texts are handled whole. An empty table gives an empty table of the same columns in every stage, and no sequences. Extra
columns pass through all stages but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperloom.llm import common, mixing, ngram_join, packing, quality_rules, secret_scan

END_ID = 2


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed votes of the quality rules keep."""
    return quality_rules.keep_good(spark, docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, Jaccard index of 0.8 or more."""
    return ngram_join.one_of_each(spark, docs, n=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced."""
    return secret_scan.redact(spark, docs, common.work_dir(spark, "blob-ledger"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the sources' target weights take them, in shuffled shards."""
    return mixing.mixed_documents(spark, docs, common.work_dir(spark, "mixing"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix packed into sequences of 1024 tokens: one row for each piece of a document."""
    import public_tokenizers

    return packing.pack_documents(spark, docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID)


STAGES = [
    ("quality rules", quality),
    ("near copies", near_copies),
    ("secret scan", secrets),
    ("mixing", mix),
    ("packing", sequences),
]

#: Expectation-maximisation, redaction by a ledger and the packing have no SQL form; tests hold the stages against
#: brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    work = common.work_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = common.cut(spark, stage(spark, docs, sf_dir), f"{work}/{k}")
        if k:
            common.drop(spark, f"{work}/{k - 1}")
    return docs
