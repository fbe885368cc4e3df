"""Cleaning and small string functions, as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.falsy import NONWORD, WS, wstrip

#: Greek commands of LaTeX, as found between dollar signs and bare.
GREEK_MATH = {"alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ"}
GREEK = {
    "alpha": "α",
    "beta": "β",
    "gamma": "γ",
    "delta": "δ",
    "mu": "μ",
    "sigma": "σ",
    "lambda": "λ",
    "theta": "θ",
    "pi": "π",
    "omega": "ω",
}
#: Parts of a LaTeX preamble that are dropped.
PREAMBLE = (
    r"\\documentclass\[[^\n]*?\]\{[^\n]*?\}",
    r"\\usepackage\{[^\n]*?\}",
    r"\\setlength\{[^\n]*?\}\{[^\n]*?\}",
    r"\\begin\{document\}",
    r"\\end\{document\}",
)
#: Three-letter months.
MONTHS = {m: f"{k:02d}" for k, m in enumerate("Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split(), 1)}
#: Names of sections that hold references.
REFERENCE_SECTIONS = ("references", "bibliography", "literature cited")

WHOLE_DOCUMENT = r"(?s)\\documentclass\[.*?\]\{.*?\}.*?\\begin\{document\}(.*?)\\end\{document\}"
SPACING = (
    (r"\\[a-zA-Z]+\{([^}]*)\}", "$1"),
    (r"\\[a-zA-Z]+", ""),
    (r"\$+", ""),
    (r"\t+", " "),
    (r" {3,}", " "),
    (r"\n{3,}", "\n\n"),
)
REFERENCE_TAILS = (r"(?is)\n##\s*references\s*\n.*$", r"(?is)\nreferences\s*\n.*$")


def clean_abstract(c: Column) -> Column:
    # Single spaces, which are most white space, are no matches; what is left at the ends is one space.
    other = WS.replace(r"\x{1c}-\x{20}", r"\x{1c}-\x{1f}")
    return F.trim(F.regexp_replace(c, f"{other}{WS}*|\\x{{20}}{WS}+", " "))


def clean_full_text(c: Column) -> Column:
    """LaTeX and spacing cleaned, then lines stripped and those without a word of substance dropped."""
    x = F.regexp_replace(c, WHOLE_DOCUMENT, "$1")
    x = reduce(lambda x, p: F.regexp_replace(x, p, ""), PREAMBLE, x)
    for name, sign in GREEK_MATH.items():
        x = F.replace(x, F.lit(rf"$$\{name}$$"), F.lit(sign))
    for name, sign in GREEK.items():
        x = F.replace(x, F.lit(rf"\{name}"), F.lit(sign))
    x = reduce(lambda x, p: F.regexp_replace(x, *p), SPACING, x)
    lines = F.transform(F.split(x, "\n", -1), wstrip)
    kept = F.filter(lines, lambda s: (F.length(s) > 1) & ~F.rlike(s, F.lit(f"^{NONWORD}+$")))
    return F.when(c == "", c).otherwise(wstrip(F.array_join(kept, "\n")))


def strip_references(c: Column) -> Column:
    """Cut from the first heading of references to the end; headed by ## first, then bare."""
    return reduce(lambda x, p: F.regexp_replace(x, p, ""), REFERENCE_TAILS, c)


def clean_comprehensive(c: Column, references: bool = True) -> Column:
    x = clean_full_text(c)
    return strip_references(x) if references else x


def query_hash(c: Column) -> Column:
    return F.md5(clean_abstract(c))


def ellipsis(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def doi_key(c: Column) -> Column:
    """A DOI without its resolver's address, in lower case."""
    return F.lower(F.when(c.startswith("http"), F.element_at(F.split(c, r"doi\.org/"), -1)).otherwise(c))


def doi_unversioned(c: Column) -> Column:
    return F.regexp_replace(c, "v[^v]*$", "")


def pmcid_digits(c: Column) -> Column:
    return F.when(c.startswith("PMC"), F.replace(c, F.lit("PMC"), F.lit(""))).otherwise(c)


def month_number(c: Column) -> Column:
    """Jan to 01 and so on; other values pass through."""
    table = F.create_map(*(F.lit(x) for pair in MONTHS.items() for x in pair))
    return F.coalesce(F.try_element_at(table, c), c)


def authors_of(c: Column) -> Column:
    """'Last, First; ...' as an array without empty names."""
    return F.filter(F.transform(F.split(c, ";"), wstrip), lambda x: x != "")


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(F.try_to_timestamp(end)) - F.unix_micros(F.try_to_timestamp(start))) / 1e6


def summary_line(pmid: Column, doi: Column, title: Column) -> Column:
    return F.concat(
        F.lit("PMID: "),
        pmid,
        F.lit(" | DOI: "),
        F.coalesce(doi, F.lit("None")),
        F.lit(" | Title: "),
        F.substring(F.coalesce(title, F.lit("")), 1, 50),
        F.lit("..."),
    )
