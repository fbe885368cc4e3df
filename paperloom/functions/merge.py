"""Merging of scalars, lists and whole records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.functions.falsy import truthy

LONGEST = ("title", "abstract", "full_text")
LISTS = ("mesh_terms", "keywords", "authors")
EXISTING_ONLY = ("collection_date", "query_id")


def scalar(a: Column, b: Column, kind: T.DataType, longest: bool = False) -> Column:
    """a if truthy, else b if truthy, else null; with ``longest`` b also wins if it is strictly longer as text."""
    ta, tb = truthy(a, kind), truthy(b, kind)
    both = F.when(F.length(b.cast("string")) > F.length(a.cast("string")), b).otherwise(a) if longest else a
    return F.when(ta & tb, both).when(ta, a).when(tb, b)


def lists(a: Column, b: Column) -> Column:
    """a as it is, then what of b isn't in a; repeats within either stay."""
    empty = F.array().cast("array<string>")
    a, b = F.coalesce(a, empty), F.coalesce(b, empty)
    return F.concat(a, F.filter(b, lambda x: ~F.array_contains(a, x)))


def records(
    pairs: DataFrame, columns: dict[str, T.DataType], old: str = "a", new: str = "b", key: str = "pmid"
) -> list[Column]:
    """Columns of the merge of struct ``new`` into struct ``old``."""
    out = []
    for name, kind in columns.items():
        x, y = F.col(f"{old}.{name}"), F.col(f"{new}.{name}")
        if name == key or name in EXISTING_ONLY:
            c = x
        elif name in LISTS:
            c = lists(x, y)
        elif isinstance(kind, T.BooleanType):
            c = F.coalesce(x, F.lit(False)) | F.coalesce(y, F.lit(False))
        elif isinstance(kind, (T.ArrayType, T.StructType)):
            c = F.when(truthy(x, kind), x).otherwise(y)
        else:
            c = scalar(x, y, kind, name in LONGEST)
        out.append(c.alias(name))
    return out
