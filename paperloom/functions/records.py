"""Whole records as JSON, and the projection of topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_json(df: DataFrame) -> DataFrame:
    """(json): each row as one object with all its fields, null ones too; binary fields are base64."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def from_json(rows: DataFrame, kind: T.StructType, column: str = "json") -> DataFrame:
    """Rows of a type from objects; fields that an object lacks are null, others of the object are ignored."""
    return rows.select(F.from_json(column, kind).alias("_r")).select("_r.*")


def topic_fields(topic: Column) -> list[Column]:
    """topic_name, topic_subfield, topic_field and topic_domain of a topic; null wherever a part is missing."""
    name = lambda c: c["display_name"]
    return [
        name(topic).alias("topic_name"), name(topic["subfield"]).alias("topic_subfield"),
        name(topic["field"]).alias("topic_field"), name(topic["domain"]).alias("topic_domain"),
    ]
