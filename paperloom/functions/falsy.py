"""Truthiness and white space as the corpus rules mean them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The Unicode white space that str.strip() and \s know, as one regex class for Java and RE2.
WS = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Anything but letters and numbers, as one class.
NONWORD = r"[^\p{L}\p{N}]"


def truthy(c: Column, kind: T.DataType) -> Column:
    """Not null and not empty: '' and 0 and false and empty collections are falsy."""
    if isinstance(kind, T.StringType):
        good = c != ""
    elif isinstance(kind, T.BooleanType):
        good = c
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        good = F.size(c) > 0
    elif isinstance(kind, T.NumericType):
        good = c != 0
    else:
        good = c.isNotNull()
    return F.coalesce(good, F.lit(False))


def filled(c: Column) -> Column:
    """truthy() of a string."""
    return F.coalesce(c != "", F.lit(False))


def wstrip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")
