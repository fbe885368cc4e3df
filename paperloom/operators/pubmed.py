"""Bibliographic XML to papers: articles and book chapters.

Records are parsed by Spark's own XML functions over a string column, so a table of XML strings and the XML file source
share one plan. A record that can't be read is no paper; ``checked`` parses once and tells each record's fate, so that none
is lost unseen.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom import schema
from paperloom.functions.falsy import WS, filled, wstrip
from paperloom.functions.text import clean_abstract, month_number

_ID = "ARRAY<STRUCT<_IdType: STRING, _VALUE: STRING>>"
_AUTHORS = "STRUCT<Author: ARRAY<STRUCT<LastName: STRING, Initials: STRING, CollectiveName: STRING>>>"
_ABSTRACT = "STRUCT<AbstractText: ARRAY<STRUCT<_Label: STRING, _VALUE: STRING>>>"
_DATE = "STRUCT<Year: STRING, Month: STRING, Day: STRING>"

_DESCRIPTOR = "STRUCT<_VALUE: STRING, _UI: STRING, _MajorTopicYN: STRING>"

ARTICLE = f"""MedlineCitation STRUCT<
  PMID: STRUCT<_VALUE: STRING, _Version: STRING>,
  Article: STRUCT<
    Journal: STRUCT<Title: STRING, JournalIssue: STRUCT<PubDate: {_DATE}>>,
    ArticleTitle: STRING, Abstract: {_ABSTRACT}, AuthorList: {_AUTHORS},
    PublicationTypeList: STRUCT<PublicationType: ARRAY<STRUCT<_VALUE: STRING, _UI: STRING>>>>,
  MeshHeadingList: STRUCT<MeshHeading: ARRAY<STRUCT<DescriptorName: {_DESCRIPTOR}>>>,
  KeywordList: ARRAY<STRUCT<Keyword: ARRAY<STRUCT<_VALUE: STRING, _MajorTopicYN: STRING>>>>>,
PubmedData STRUCT<ArticleIdList: STRUCT<ArticleId: {_ID}>>"""

BOOK = f"""BookDocument STRUCT<
  PMID: STRUCT<_VALUE: STRING, _Version: STRING>,
  ArticleIdList: STRUCT<ArticleId: {_ID}>,
  Book: STRUCT<BookTitle: STRUCT<_VALUE: STRING, _book: STRING>>,
  ArticleTitle: STRUCT<_VALUE: STRING, _book: STRING>, Abstract: {_ABSTRACT}, AuthorList: ARRAY<{_AUTHORS}>>,
PubmedBookData STRUCT<History: STRUCT<PubMedPubDate: ARRAY<{_DATE}>>, ArticleIdList: STRUCT<ArticleId: {_ID}>>"""


#: Where Spark puts a record that isn't well-formed.
_CORRUPT = "_corrupt_record"


def _parsed(c: Column, kind: str) -> Column:
    return F.from_xml(c, f"{kind}, {_CORRUPT} STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def _list(c: Column, kind: str) -> Column:
    return F.coalesce(c, F.array().cast(kind))


def _ids(c: Column) -> Column:
    return F.transform(
        _list(c, "array<struct<_IdType:string,_VALUE:string>>"),
        lambda x: F.struct(x["_IdType"].alias("kind"), wstrip(x["_VALUE"]).alias("id")),
    )


def _last(ids: Column, test) -> Column:
    return F.try_element_at(F.filter(ids, test), F.lit(-1))["id"]


def _abstract(c: Column) -> Column:
    parts = F.transform(
        c,
        lambda p: F.when(
            filled(p["_Label"]), F.concat(p["_Label"], F.lit(": "), F.coalesce(p["_VALUE"], F.lit("")))
        ).otherwise(F.coalesce(p["_VALUE"], F.lit(""))),
    )
    return clean_abstract(F.array_join(parts, " "))


def _authors(c: Column) -> Column:
    name = lambda a: F.when(
        filled(a["LastName"]), F.rtrim(F.concat(a["LastName"], F.lit(" "), F.coalesce(a["Initials"], F.lit(""))))
    ).otherwise(a["CollectiveName"])
    return F.filter(F.transform(c, name), filled)


def published(date: Column) -> Column:
    """yyyy-mm-dd of a date with a year; a named month becomes its number, other values pass."""
    part = lambda n: F.when(filled(date[n]), date[n]).otherwise("01")
    return F.when(filled(date["Year"]), F.concat_ws("-", date["Year"], month_number(part("Month")), part("Day")))


def articles(xml: DataFrame, column: str = "xml") -> DataFrame:
    """Papers of rows that hold a well-formed PubmedArticle; others are dropped."""
    rows = xml.filter(F.contains(F.col(column), F.lit("<PubmedArticle")))
    return _articles(rows.select(_parsed(F.col(column), ARTICLE).alias("r")).filter(f"r.{_CORRUPT} is null"))


def _articles(rows: DataFrame) -> DataFrame:
    """Papers of parsed records r."""
    return rows.select(*(c.alias(name) for name, c in _article_columns("r").items()))


def _article_columns(r: str) -> dict[str, Column]:
    m, ids = f"{r}.MedlineCitation", _ids(F.col(f"{r}.PubmedData.ArticleIdList.ArticleId"))
    pmcid = F.get(F.filter(ids, lambda x: x["id"].startswith("PMC")), 0)["id"]
    headings = _list(F.col(f"{m}.MeshHeadingList.MeshHeading"), f"array<struct<DescriptorName:{_DESCRIPTOR}>>")
    values = lambda c: F.filter(F.transform(c, lambda h: h["DescriptorName"]["_VALUE"]), filled)
    mesh, major = values(headings), values(F.filter(headings, lambda h: h["DescriptorName"]["_MajorTopicYN"] == "Y"))
    first = F.get(F.col(f"{m}.KeywordList"), 0)["Keyword"]
    keywords = F.filter(
        F.transform(_list(first, "array<struct<_VALUE:string,_MajorTopicYN:string>>"), lambda k: k["_VALUE"]), filled
    )
    kinds = _list(F.col(f"{m}.Article.PublicationTypeList.PublicationType"), "array<struct<_VALUE:string,_UI:string>>")
    kind = F.array_join(F.filter(F.transform(kinds, lambda k: k["_VALUE"]), filled), "; ")
    date = F.col(f"{m}.Article.Journal.JournalIssue.PubDate")
    return {
        "pmid": F.col(f"{m}.PMID._VALUE"), "pmcid": pmcid, "doi": _last(ids, lambda x: x["kind"] == "doi"),
        "title": F.col(f"{m}.Article.ArticleTitle"), "abstract": _abstract(F.col(f"{m}.Article.Abstract.AbstractText")),
        "mesh_terms": mesh, "keywords": keywords,
        "authors": F.coalesce(_authors(F.col(f"{m}.Article.AuthorList.Author")), F.array().cast("array<string>")),
        "year": F.when(filled(date["Year"]), date["Year"]), "date_published": published(date),
        "journal": F.col(f"{m}.Article.Journal.Title"), "is_full_text_pmc": pmcid.isNotNull(),
        "publication_type": F.nullif(kind, F.lit("")), "mesh_major": major,
    }


def books(xml: DataFrame, column: str = "xml") -> DataFrame:
    """Papers of rows that hold a well-formed PubmedBookArticle."""
    rows = xml.filter(F.contains(F.col(column), F.lit("<PubmedBookArticle")))
    return _books(rows.select(_parsed(F.col(column), BOOK).alias("r")).filter(f"r.{_CORRUPT} is null"))


def _books(rows: DataFrame) -> DataFrame:
    return rows.select(*(c.alias(name) for name, c in _book_columns("r").items()))


def _book_columns(r: str) -> dict[str, Column]:
    b = f"{r}.BookDocument"
    ids = F.concat(_ids(F.col(f"{r}.PubmedBookData.ArticleIdList.ArticleId")), _ids(F.col(f"{b}.ArticleIdList.ArticleId")))
    year = F.get(F.filter(F.col(f"{r}.PubmedBookData.History.PubMedPubDate"), lambda d: filled(d["Year"])), 0)["Year"]
    people = F.flatten(F.transform(F.col(f"{b}.AuthorList"), lambda a: a["Author"]))
    pmid = F.coalesce(
        F.get(F.filter(ids, lambda x: x["kind"] == "pubmed"), 0)["id"], F.get(ids, 0)["id"], F.col(f"{b}.PMID._VALUE")
    )
    return {
        "pmid": pmid, "title": F.col(f"{b}.ArticleTitle._VALUE"), "abstract": _abstract(F.col(f"{b}.Abstract.AbstractText")),
        "authors": F.coalesce(_authors(people), F.array().cast("array<string>")), "year": year,
        "journal": F.col(f"{b}.Book.BookTitle._VALUE"),
    }


def papers(xml: DataFrame, column: str = "xml") -> DataFrame:
    return articles(xml, column).unionByName(books(xml, column), allowMissingColumns=True)


def checked(xml: DataFrame, column: str = "xml") -> DataFrame:
    """(digest, record, kind, reason, columns of papers): one row for each record, parsed once.

    ``reason`` is null for a record that is a paper. Else it is "empty" (null or blank), "no record" (neither article nor
    book), "malformed" (not well-formed, also when cut short) or "no id". ``digest`` is the SHA-256 of the record, or the
    rows' own where they have a column of that name; ``record`` is kept of those only that are no papers. A record that holds an article and a book counts as an article.
    """
    text = F.col(column)
    # A sign that isn't white space ends the search; records are large.
    blank = ~F.coalesce(F.rlike(text, F.lit(WS.replace("[", "[^", 1))), F.lit(False))
    kind = F.when(blank, "empty").when(F.contains(text, F.lit("<PubmedArticle")), "article").when(
        F.contains(text, F.lit("<PubmedBookArticle")), "book"
    ).otherwise("no record")
    digest = F.col("digest") if "digest" in xml.columns else F.sha2(F.coalesce(text, F.lit("")), 256)
    rows = xml.select(digest.alias("digest"), text.alias("record"), kind.alias("kind"))
    # One pass over the records, whose making may be most of the work; each is parsed as what it is.
    of = {"article": (ARTICLE, _article_columns("_article")), "book": (BOOK, _book_columns("_book"))}
    parsed = {f"_{k}": F.when(F.col("kind") == k, _parsed(F.col("record"), types)) for k, (types, _) in of.items()}
    rows = rows.withColumns(parsed)
    names = dict.fromkeys(chain.from_iterable(columns for _, columns in of.values()))
    own = lambda name: F.coalesce(*(F.when(F.col("kind") == k, c[name]) for k, (_, c) in of.items() if name in c))
    broken = reduce(lambda x, y: x | y, (F.col(f"{r}.{_CORRUPT}").isNotNull() for r in parsed))
    told = rows.select("digest", "record", "kind", broken.alias("_broken"), *(own(n).alias(n) for n in names))
    reason = F.when(F.col("kind").isin("empty", "no record"), F.col("kind")).when(F.col("_broken"), "malformed").when(
        ~filled(F.col("pmid")), "no id"
    )
    told = told.withColumn("reason", reason)
    record = F.when(F.col("reason").isNotNull(), F.col("record")).alias("record")
    return told.select("digest", record, "kind", "reason", *names)


def good(told: DataFrame) -> DataFrame:
    """The papers among ``checked`` records, with all columns of a paper."""
    rows = told.filter("reason is null").drop("digest", "record", "kind", "reason")
    lacking = [f for f in schema.paper() if f.name not in rows.columns]
    return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking})


def bad(told: DataFrame) -> DataFrame:
    """(digest, pmid, kind, reason, record) of ``checked`` records that are no papers, as they came. The pmid is the first
    that can be made out in the text."""
    named = F.nullif(F.regexp_extract("record", r"<PMID[^>]*>\s*([0-9]+)", 1), F.lit(""))
    return told.filter("reason is not null").select("digest", named.alias("pmid"), "kind", "reason", "record")
