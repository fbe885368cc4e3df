"""Functions of ordered sections: ARRAY<STRUCT<pos INT, name STRING, content STRING>>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.falsy import filled, wstrip
from paperloom.functions.text import REFERENCE_SECTIONS, clean_full_text, strip_references

SECTIONS = "array<struct<pos:int,name:string,content:string>>"
#: The order of well-known sections.
PRIORITY = ("Abstract", "Introduction", "Main", "Methods", "Results", "Discussion", "Conclusion")


def _blank(c: Column) -> Column:
    return F.coalesce(wstrip(c) == "", F.lit(True))


def _headed(s: Column, body: Column) -> Column:
    return F.when(F.lower(s["name"]) == "main", body).otherwise(F.concat(F.lit("## "), s["name"], F.lit("\n\n"), body))


def clean_sections(c: Column) -> Column:
    """Blank sections go; references are cut only within sections that hold them."""
    name = lambda s: F.lower(s["name"]).isin(*REFERENCE_SECTIONS)
    text = lambda s: F.when(
        name(s), strip_references(clean_full_text(s["content"]))
    ).otherwise(clean_full_text(s["content"]))
    cleaned = F.transform(
        F.filter(c, lambda s: ~_blank(s["content"])),
        lambda s: F.struct(s["pos"].alias("pos"), s["name"].alias("name"), text(s).alias("content")),
    )
    return F.filter(cleaned, lambda s: filled(s["content"]))


def to_flat(c: Column) -> Column:
    """Text with ## headings, in order of (priority, name)."""
    rank = lambda s: F.coalesce(
        F.nullif(F.array_position(F.array(*map(F.lit, PRIORITY)), s["name"]), F.lit(0)), F.lit(100)
    )
    order = F.array_sort(
        F.transform(
            c, lambda s: F.struct(rank(s).alias("rank"), s["name"].alias("name"), s["content"].alias("content"))
        )
    )
    parts = F.transform(
        F.filter(order, lambda s: filled(s["content"])),
        lambda s: _headed(s, F.concat(wstrip(s["content"]), F.lit("\n\n"))),
    )
    return wstrip(F.array_join(parts, ""))


def from_flat(c: Column) -> Column:
    """Sections of a text with ## headings: the text before the first is Main; a heading without lines is dropped; a name
    that comes again replaces the content at its first place."""
    parts = F.split(c, r"(?<=\n)(?=## )", -1)

    def section(part, i, last):
        # What ends at the next heading ends with a line feed that belongs to neither.
        own = F.when(i < last, F.substring(part, F.lit(1), F.length(part) - 1)).otherwise(part)
        headed = part.startswith("## ")
        lines = F.contains(own, F.lit("\n"))
        name = F.when(headed, wstrip(F.regexp_replace(F.substring_index(own, "\n", 1), "^#+", ""))).otherwise("Main")
        body = F.when(headed, F.regexp_replace(own, r"^[^\n]*\n?", "")).otherwise(own)
        return F.when(~headed | lines, F.struct(name.alias("name"), i.alias("i"), wstrip(body).alias("content")))

    def distinct(found):
        # Sorted by name, a name's sections lie together: its first gives the place, its last the content.
        return _let(F.sort_array(found), lambda by_name: F.transform(F.sort_array(F.transform(
            F.arrays_zip(
                F.filter(by_name, lambda s, k: (k == 0) | (F.get(by_name, k - 1)["name"] != s["name"])).alias("first"),
                F.filter(by_name, lambda s, k: (k == F.size(by_name) - 1) | (F.get(by_name, k + 1)["name"] != s["name"])).alias("last"),
            ),
            lambda z: F.struct(z["first"]["i"].alias("i"), z["first"]["name"].alias("name"), z["last"]["content"].alias("content")),
        )), lambda s, i: F.struct(i.alias("pos"), s["name"].alias("name"), s["content"].alias("content"))))

    found = lambda p: F.filter(F.transform(p, lambda x, i: section(x, i, F.size(p) - 1)), lambda s: s.isNotNull())
    return F.when(c.isNotNull(), _let(parts, lambda p: _let(found(p), distinct)))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once: a lambda's variable, where a name for an expression would be written out
    (and evaluated) wherever it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lookup(c: Column, name: Column) -> Column:
    """Content of a section: exact name, then in any case, then as a part of a name; the first in order."""
    first = lambda test: F.get(F.filter(c, test), 0)["content"]
    low = F.lower(name)
    return F.coalesce(
        first(lambda s: s["name"] == name),
        first(lambda s: F.lower(s["name"]) == low),
        first(lambda s: F.contains(F.lower(s["name"]), low)),
    )


def names(c: Column) -> Column:
    return F.transform(c, lambda s: s["name"])


def merge(a: Column, b: Column) -> Column:
    """Shared names: both contents, a blank line between; new names follow."""
    other = lambda s: F.get(F.filter(b, lambda t: t["name"] == s["name"]), 0)["content"]
    both = F.transform(
        a,
        lambda s: F.struct(
            s["pos"].alias("pos"), s["name"].alias("name"), F.concat_ws("\n\n", s["content"], other(s)).alias("content")
        ),
    )
    new = F.filter(b, lambda t: ~F.exists(a, lambda s: s["name"] == t["name"]))
    shifted = F.transform(
        new,
        lambda t, i: F.struct(
            (F.size(a) + i).cast("int").alias("pos"), t["name"].alias("name"), t["content"].alias("content")
        ),
    )
    return F.concat(both, shifted)


def find_by_keywords(c: Column, words: list[str]) -> Column:
    """The first section whose name has any of the words, in any case."""
    low = [w.lower() for w in words]
    return F.get(
        F.filter(c, lambda s: F.exists(F.array(*map(F.lit, low)), lambda w: F.contains(F.lower(s["name"]), w))), 0
    )


def full_text(c: Column, flat: Column, form: str = "auto") -> Column:
    """Text as 'flat', 'sectioned' or 'auto' (sectioned if there are sections); any other form is null."""
    parts = F.transform(F.filter(c, lambda s: ~_blank(s["content"])), lambda s: _headed(s, s["content"]))
    sectioned = wstrip(F.array_join(parts, "\n"))
    if form == "flat":
        return flat
    if form == "sectioned":
        return sectioned
    if form == "auto":
        return F.when(F.coalesce(F.size(c), F.lit(0)) > 0, sectioned).otherwise(flat)
    return F.lit(None).cast("string")


def has_full_text(c: Column, flat: Column) -> Column:
    return ~_blank(flat) | (F.coalesce(F.size(c), F.lit(0)) > 0)
