"""Does an article's text hold more than its front and back matter?"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.falsy import wstrip

#: Parts of section names that are boilerplate.
BOILERPLATE = (
    "conflict of interest", "conflicts of interest", "competing interests", "acknowledgment", "acknowledgments", "acknowledgement",
    "acknowledgements", "funding", "financial disclosure", "author contributions", "data availability", "supplementary material",
    "supporting information", "abbreviations", "keywords", "copyright", "license", "author information", "correspondence", "ethics", "consent",
)
#: Parts of section names that carry an article.
MEANINGFUL = (
    "introduction", "background", "methods", "methodology", "materials", "results", "discussion", "conclusion", "analysis", "findings",
    "literature review", "theory", "hypothesis", "experiment", "case study", "data", "implementation", "evaluation",
)


def _any(name: Column, words) -> Column:
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(name, w))


def has_meaningful_content(sections: Column, full_text: Column) -> Column:
    length = F.coalesce(F.length(wstrip(full_text)), F.lit(0))
    low = lambda s: F.lower(F.coalesce(s["name"], F.lit("")))
    abstract = lambda s: F.contains(low(s), F.lit("abstract"))
    boiler = lambda s: ~abstract(s) & _any(low(s), BOILERPLATE)
    other = lambda s: ~abstract(s) & ~_any(low(s), BOILERPLATE)
    count = lambda test: F.size(F.filter(sections, test))
    boilers, meant = count(boiler), count(lambda s: other(s) & _any(low(s), MEANINGFUL))
    large = count(lambda s: other(s) & (F.coalesce(F.length(wstrip(s["content"])), F.lit(0)) > 500))
    return (
        F.when(F.coalesce(F.size(sections), F.lit(0)) <= 0, length > 2000)
        .when((meant >= 1) & (large >= 1), True)
        .when((large >= 3) & (boilers < large), True)
        .when((boilers > 0) & (meant == 0) & (large < 3), False)
        .when(large < 2, False)
        .otherwise(length > 3000)
    )
