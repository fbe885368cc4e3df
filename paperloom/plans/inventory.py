"""Named queries for parsers, the store, exports, preprints and runs: each builds its inputs (XML, files, stores) from whole
tables in the shared folder, runs the library over them and has SQL that gives the same rows from the tables alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import shared
from paperloom.functions import sections, text
from paperloom.functions.falsy import WS
from paperloom.operators import corpus, dedup, fulltext, hits, pubmed
from paperloom.operators.store import CorpusStore
from paperloom.plans import collect, views
from paperloom.plans.catalogue import ORACLES, QUERIES, clean_sql, paper_query, query, strip_sql
from paperloom.sources import files, remote
from paperloom.sources.querylang import doi_filter, predicate, preprint_query, with_suffix

STRIP = f"regexp_replace(%s, '^{WS}+|{WS}+$', '', 'g')"
SQUASH = STRIP % f"regexp_replace(%s, '{WS}+', ' ', 'g')"
NUMBER = "CAST(pmid AS BIGINT)"

__all__ = ["ORACLES", "QUERIES"]


def number(c: str = "pmid") -> Column:
    return F.col(c).cast("long")


def escaped(c: Column) -> Column:
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(sign), F.lit(name))
    return c


def tag(name: str, *inner: Column | str, attrs: str = "") -> Column:
    parts = [F.lit(x) if isinstance(x, str) else x for x in inner]
    return F.concat(F.lit(f"<{name}{attrs}>"), *parts, F.lit(f"</{name}>"))


# Bibliographic XML


def article_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pmid, xml): every document as an article; the abstract is a labelled title and the whole text."""
    d = views.table(spark, sf_dir, "documents")
    i, title, body = F.col("doc_id"), F.substring("text", 1, 80), F.col("text")
    month = F.element_at(F.array(*(F.lit(m) for m in ("Jan", "Apr", "07", "Dec"))), (i % 4 + 1).cast("int"))
    date = tag(
        "PubDate", tag("Year", (1990 + i % 35).cast("string")), F.when(i % 5 != 0, tag("Month", month)).otherwise("")
    )
    authors = tag(
        "AuthorList",
        tag("Author", tag("LastName", "Doe"), tag("Initials", F.col("lang"))),
        tag("Author", tag("CollectiveName", "Group of ", i.cast("string"))),
        tag("Author", tag("Initials", "X")),
    )
    article = tag(
        "Article", tag(
            "Journal", tag("Title", "Journal of ", F.col("lang")), tag("JournalIssue", date)
        ), tag("ArticleTitle", escaped(title)),
        tag(
            "Abstract", tag("AbstractText", escaped(title), attrs=' Label="AIM"'), tag("AbstractText", escaped(body))
        ), authors,
        tag(
            "PublicationTypeList",
            tag("PublicationType", "Review"),
            F.when(i % 2 == 0, tag("PublicationType", "Trial")).otherwise(""),
        ),
    )
    mesh = tag(
        "MeshHeadingList",
        tag("MeshHeading", tag("DescriptorName", "Aging", attrs=' MajorTopicYN="Y"')),
        tag("MeshHeading", tag("DescriptorName", F.col("lang"), attrs=' MajorTopicYN="N"')),
    )
    keywords = F.concat(tag("KeywordList", tag("Keyword", "first")), tag("KeywordList", tag("Keyword", "second list")))
    ids = tag(
        "ArticleIdList", tag("ArticleId", " 10.1/old ", attrs=' IdType="doi"'), F.when(
            i % 3 == 0, tag("ArticleId", "PMC", i.cast("string"), attrs=' IdType="pmc"')
        ).otherwise(""),
        F.when(i % 7 != 0, tag("ArticleId", "10.5555/", i.cast("string"), attrs=' IdType="doi"')).otherwise(""),
    )
    cited = tag("MedlineCitation", tag("PMID", i.cast("string"), attrs=' Version="1"'), article, mesh, keywords)
    return d.select(i.cast("string").alias("pmid"), tag("PubmedArticle", cited, tag("PubmedData", ids)).alias("xml"))


def book_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pmid, xml): every document as a book's chapter."""
    d = views.table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    ids = tag(
        "ArticleIdList",
        tag("ArticleId", "NBK1", attrs=' IdType="bookaccession"'),
        F.when(i % 2 == 0, tag("ArticleId", "b", i.cast("string"), attrs=' IdType="pubmed"')).otherwise(""),
    )
    people = tag("AuthorList", tag("Author", tag("LastName", "Roe")))
    title, book = F.substring("text", 1, 60), tag(
        "Book", tag("BookTitle", "Book of ", F.col("lang"), attrs=' book="b"')
    )
    document = tag(
        "BookDocument",
        tag("PMID", i.cast("string")),
        ids,
        book,
        tag("ArticleTitle", escaped(title), attrs=' book="b"'),
        people,
        tag("Abstract", tag("AbstractText", escaped(F.col("text")))),
    )
    data = tag(
        "PubmedBookData",
        tag(
            "History",
            tag("PubMedPubDate", tag("Month", "1")),
            tag("PubMedPubDate", tag("Year", (1990 + i % 35).cast("string"))),
        ),
    )
    return d.select(i.cast("string").alias("pmid"), tag("PubmedBookArticle", document, data).alias("xml"))


def told_articles(a: DataFrame) -> DataFrame:
    joined = lambda c: F.array_join(c, "|").alias(c)
    return a.select(
        "pmid",
        "pmcid",
        "doi",
        "title",
        "abstract",
        joined("mesh_terms"),
        joined("keywords"),
        joined("authors"),
        "year",
        "date_published",
        "journal",
        "is_full_text_pmc",
        "publication_type",
        joined("mesh_major"),
    )


ARTICLES = f"""SELECT CAST(doc_id AS VARCHAR) AS pmid, CASE WHEN doc_id % 3 = 0 THEN 'PMC' || doc_id END AS pmcid,
  CASE WHEN doc_id % 7 <> 0 THEN '10.5555/' || doc_id ELSE '10.1/old' END AS doi, {STRIP % "substring(text, 1, 80)"}
  AS title,
  {SQUASH % "'AIM: ' || substring(text, 1, 80) || ' ' || text"} AS abstract, 'Aging|' || lang AS mesh_terms, 'first'
  AS keywords,
  'Doe ' || lang || '|Group of ' || doc_id AS authors, CAST(1990 + doc_id % 35 AS VARCHAR) AS year,
  (1990 + doc_id % 35) || '-' || CASE WHEN doc_id % 5 = 0 THEN '01' ELSE ['01', '04', '07', '12'][CAST(doc_id % 4 +
  1 AS INTEGER)] END || '-01' AS date_published,
  'Journal of ' || lang AS journal, doc_id % 3 = 0 AS is_full_text_pmc, 'Review' || CASE WHEN doc_id % 2 = 0 THEN
  '; Trial' ELSE '' END AS publication_type,
  'Aging' AS mesh_major FROM documents"""
query("pubmed_articles", f", a AS ({ARTICLES}) SELECT * FROM a")(
    lambda s, d: told_articles(pubmed.articles(article_xml(s, d)))
)
query("pubmed_by_ids", f", a AS ({ARTICLES}) SELECT pmid, doi, year FROM a WHERE {NUMBER} % 10 = 4")(
    lambda s, d: pubmed.papers(
        article_xml(s, d).join(views.papers(s, d).filter(number() % 10 == 4).select("pmid"), "pmid", "left_semi")
    ).select("pmid", "doi", "year")
)
BOOKS = f"""SELECT CASE WHEN doc_id % 2 = 0 THEN 'b' || doc_id ELSE 'NBK1' END AS pmid,
  {STRIP % "substring(text, 1, 60)"} AS title, {SQUASH % "text"} AS abstract,
  'Roe' AS authors, CAST(1990 + doc_id % 35 AS VARCHAR) AS year, 'Book of ' || lang AS journal FROM documents"""
query("pubmed_books", f", b AS ({BOOKS}) SELECT * FROM b")(
    lambda s, d: pubmed.books(book_xml(s, d)).select(
        "pmid", "title", "abstract", F.array_join("authors", "|").alias("authors"), "year", "journal"
    )
)
query("pubmed_single", f", a AS ({ARTICLES}) SELECT pmid, title FROM a")(
    lambda s, d: pubmed.articles(
        article_xml(s, d).select("xml").unionByName(book_xml(s, d).select("xml"))
    ).select("pmid", "title")
)
query("pubmed_union", f""", a AS ({ARTICLES}), b AS ({BOOKS}) SELECT pmid, journal, doi FROM a UNION ALL SELECT
  pmid, journal, NULL FROM b""")(
    lambda s, d: pubmed.papers(
        article_xml(s, d).select("xml").unionByName(book_xml(s, d).select("xml"))
    ).select("pmid", "journal", "doi")
)


# Records that can't be read: a seventh each cut short, without an id, or no XML at all


def mixed_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(xml) of all articles, of which three in seven can't be read."""
    i, xml = number(), F.col("xml")
    broken = F.when(i % 7 == 1, F.substring(xml, F.lit(1), F.floor(F.length(xml) / 2).cast("int"))).when(
        i % 7 == 2, F.regexp_replace(xml, "<PMID[^>]*>[^<]*</PMID>", "")
    ).when(i % 7 == 3, F.concat(F.lit("moved to "), "pmid")).otherwise(xml)
    return article_xml(spark, sf_dir).select(broken.alias("xml"))


REJECTS = """SELECT CASE WHEN doc_id % 7 = 1 THEN CAST(doc_id AS VARCHAR) END AS pmid, CASE WHEN doc_id % 7 = 3 THEN
  'no record' ELSE 'article' END AS kind, CASE doc_id % 7 WHEN 1 THEN 'malformed' WHEN 2 THEN 'no id' ELSE 'no record'
  END AS reason FROM documents WHERE doc_id % 7 IN (1, 2, 3)"""
query("pubmed_rejects", f", r AS ({REJECTS}) SELECT * FROM r")(
    lambda s, d: pubmed.bad(pubmed.checked(mixed_xml(s, d))).select("pmid", "kind", "reason")
)
query("pubmed_checked", f", a AS ({ARTICLES}) SELECT * FROM a WHERE {NUMBER} % 7 NOT IN (1, 2, 3)")(
    lambda s, d: told_articles(pubmed.good(pubmed.checked(mixed_xml(s, d))))
)


# Article XML


def jats_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pmid, pmcid, doi, xml): every conversation as an article: a section a turn, odd turns within the turn before."""
    rows = views.section_rows(spark, sf_dir).withColumn("outer", F.floor(F.col("pos") / 2))
    part = F.struct(
        "pos",
        F.concat(F.lit("<title>"), F.col("name"), F.lit("</title>"), tag("p", escaped(F.col("content")))).alias("x"),
    )
    outer = rows.groupBy("pmid", "outer").agg(F.array_sort(F.collect_list(part)).alias("p"))
    sec = F.concat(
        F.lit("<sec>"),
        F.col("p")[0]["x"],
        F.coalesce(F.concat(F.lit("<sec>"), F.get("p", 1)["x"], F.lit("</sec>")), F.lit("")),
        F.lit("</sec>"),
    )
    whole = outer.groupBy("pmid").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("outer", sec.alias("x")))), lambda s: s["x"]), ""
        ).alias("body")
    )
    front = tag("front", tag("abstract", tag("p", "Abstract of ", F.col("pmid"))))
    figure = tag("fig", tag("label", "F1"), tag("caption", tag("p", "Figure of ", F.col("pmid"))))
    grid = tag(
        "table-wrap",
        tag("label", "T1"),
        tag("caption", tag("p", "Numbers")),
        tag("table", tag("tr", tag("td", F.col("pmid")), tag("td", "b"))),
    )
    back = tag("back", tag("ref-list", tag("ref", tag("mixed-citation", "Cited by ", F.col("pmid")))))
    xml = F.concat(
        F.lit('<article article-type="research-article">'),
        front,
        tag("body", F.col("body"), tag("sec", tag("title", "Data"), figure, grid)),
        back,
        F.lit("</article>"),
    )
    return whole.select(
        "pmid",
        F.concat(F.lit("PMC"), "pmid").alias("pmcid"),
        F.concat(F.lit("10.5555/"), "pmid").alias("doi"),
        xml.alias("xml"),
    )


TURNS = f"""turns AS (SELECT pmid, pos, pos // 2 AS o, name, {STRIP % "content"} AS said FROM sections),
outers AS (SELECT pmid, o, arg_min(name, pos) AS head, min(pos) AS opens FROM turns GROUP BY pmid, o),
keyed AS (SELECT t.pmid, t.o, t.pos, t.said, CASE WHEN t.pos = u.opens THEN t.name ELSE u.head || '/' || t.name END
  AS name, t.pos <> u.opens AS inner_one
  FROM turns t JOIN outers u ON t.pmid = u.pmid AND t.o = u.o WHERE t.said <> '')"""
query("jats_sections", f""", {TURNS} SELECT pmid, CAST(row_number() OVER (PARTITION BY pmid ORDER BY o, inner_one
  DESC) - 1 AS INTEGER) AS pos, name, said AS content FROM keyed""")(
    lambda s, d: fulltext.jats(jats_xml(s, d)).select(
        "pmid", F.explode("sections").alias("s")
    ).select("pmid", "s.pos", "s.name", "s.content")
)
query("jats_flat", f""", {TURNS} SELECT pmid, string_agg(CASE WHEN t.pos = u.opens THEN '# ' ELSE '## ' END ||
  t.name || CASE WHEN said <> '' THEN chr(10) || chr(10) || said ELSE '' END, chr(10) || chr(10) ORDER BY t.pos) ||
  chr(10) || chr(10) || '# Data' AS full_text,
  'Abstract of ' || pmid AS abstract, true AS has_body FROM turns t JOIN outers u USING (pmid, o) GROUP BY pmid""")(lambda s, d: fulltext.jats(jats_xml(s, d)).select("pmid", "full_text", "abstract", "has_body"))
query("jats_extras", """SELECT DISTINCT pmid, 'Numbers: ' || pmid || ' | b' AS tables, 'F1 Figure of ' || pmid AS
  figures, 'Cited by ' || pmid AS refs, 'research-article' AS article_type FROM sections""")(
    lambda s, d: fulltext.article_extras(jats_xml(s, d)).select(
        "pmid", F.array_join(
            F.transform("tables", lambda t: F.concat(t["caption"], F.lit(": "), t["content"])), "|"
        ).alias("tables"),
        F.array_join(
            F.transform("figures", lambda t: F.concat(t["label"], F.lit(" "), t["caption"])), "|"
        ).alias("figures"), F.array_join(F.transform("references", lambda t: t["content"]), "|").alias("refs"), "article_type",
    )
)
query("jats_with_extras", """SELECT DISTINCT pmid, '**Table 1:** Numbers' || chr(10) || pmid || ' | b' AS tables,
  '**Figure 1:** Figure of ' || pmid AS figures, '[1] Cited by ' || pmid AS refs FROM sections""")(
    lambda s, d: _with_extras(s, d)
)


def _with_extras(s: SparkSession, d: str) -> DataFrame:
    j = fulltext.jats(jats_xml(s, d), include=("tables", "figures", "references"))
    named = lambda n: F.get(F.filter("sections", lambda x: x["name"] == n), 0)["content"]
    return j.select(
        "pmid", named("TABLES").alias("tables"), named("FIGURES").alias("figures"), named("REFERENCES").alias("refs")
    )


MEANT = f"""meant AS (SELECT pmid, count(*) FILTER (WHERE NOT contains(lower(name), 'funding') AND
  contains(lower(name), 'introduction') AND NOT contains(lower(name), 'abstract')) AS m,
  count(*) FILTER (WHERE NOT contains(lower(name), 'funding') AND NOT contains(lower(name), 'abstract') AND
  length(said) > 500) AS l,
  count(*) FILTER (WHERE contains(lower(name), 'funding') AND NOT contains(lower(name), 'abstract')) AS b FROM keyed
  GROUP BY pmid),
flats AS (SELECT pmid, sum(length(t.name) + CASE WHEN t.pos = u.opens THEN 2 ELSE 3 END + CASE WHEN said <> '' THEN
  2 + length(said) ELSE 0 END + 2) + 6 AS n FROM turns t JOIN outers u USING (pmid, o) GROUP BY pmid)"""
query("jats_assembled", f""", {TURNS}, {MEANT} SELECT f.pmid, CASE WHEN (m >= 1 AND l >= 1) OR (l >= 3 AND b < l)
  THEN 'body' WHEN b > 0 AND m = 0 AND l < 3 THEN 'page' WHEN l < 2 THEN 'page' WHEN n > 3000 THEN 'body' ELSE
  'page' END AS origin
  FROM flats f JOIN meant USING (pmid)""")(
    lambda s, d: (
        lambda j: j.select(
            "pmid",
            fulltext.assemble(
                F.col("full_text"), F.col("sections"), F.col("has_body"), F.col("abstract"), F.lit("the page")
            ).alias("t"),
        ).select("pmid", F.when(F.col("t.full_text").startswith("ABSTRACT:\nAbstract of"), "body").when(F.col("t.full_text") == "the page", "page").alias("origin"))
    )(fulltext.jats(jats_xml(s, d)))
)
query("fulltext_by_doi", """SELECT p.pmid, s.pmid IS NOT NULL AS found, CASE WHEN s.pmid IS NOT NULL THEN 'PMC' ||
  s.pmid END AS late_pmcid FROM papers p LEFT JOIN (SELECT DISTINCT pmid FROM sections) s ON p.pmid = s.pmid""")(
    lambda s, d: (lambda texts: fulltext.waterfall(
        views.papers(s, d).select(
            "pmid", F.lit(None).cast("string").alias("pmcid"), F.concat(F.lit("10.5555/"), "pmid").alias("doi")
        ),
        texts.select("pmcid", F.col("full_text").alias("text")), texts.select("doi", F.col("full_text").alias("text")),
    ).select("pmid", F.col("full_text").isNotNull().alias("found"), F.when(F.col("full_text").isNotNull(), F.concat(F.lit("PMC"), "pmid")).alias("late_pmcid")))(fulltext.jats(jats_xml(s, d)))
)


def html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pmid, html): every conversation as a page with a headed part for each turn."""
    part = tag("div", tag("h2", F.col("name")), tag("p", escaped(F.col("content")), tag("script", "var t = '</p>';")))
    rows = views.section_rows(spark, sf_dir).select("pmid", F.struct("pos", part.alias("x")).alias("p"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["x"]), "")
    return rows.groupBy("pmid").agg(
        tag("html", tag("nav", tag("p", "A line of the menu that is long enough")), tag("article", body)).alias("html")
    )


RAW = """SELECT pmid, coalesce(string_agg('## ' || name || chr(10) || chr(10) || said, chr(10) || chr(10) ORDER BY
  pos) FILTER (WHERE length(said) > 30), '') AS raw FROM turns GROUP BY pmid"""
query(
    "html_sections",
    f", {TURNS} SELECT pmid, CASE WHEN length(raw) > 500 THEN {
        strip_sql(clean_sql('raw'))
    } END AS page_text FROM ({RAW})",
)(lambda s, d: fulltext.pages(html_pages(s, d)).select("pmid", "page_text"))


# Preprints

PRE = """pre AS (SELECT *, CASE WHEN year IS NULL THEN NULL ELSE year || '-0' || (CAST(pmid AS BIGINT) % 9 + 1) ||
  '-15' END AS date_published FROM papers)"""


def preprints(s: SparkSession, d: str) -> DataFrame:
    month = (number() % 9 + 1).cast("string")
    return views.papers(s, d).withColumn(
        "date_published", F.when(F.col("year").isNotNull(), F.concat(F.col("year"), F.lit("-0"), month, F.lit("-15")))
    )


query(
    "preprint_search", f", {PRE} SELECT pmid FROM pre WHERE source = 'PPR' AND year BETWEEN '1995' AND '2010'"
)(lambda s, d: preprints(s, d).filter(predicate(preprint_query("PUB_YEAR:[1995 TO 2010]"))).select("pmid"))
query("preprint_search_medrxiv", f", {PRE} SELECT pmid FROM pre WHERE source = 'MED' AND year = '2001'")(
    lambda s, d: preprints(s, d).filter(predicate(preprint_query("2001[dp]", "medrxiv"))).select("pmid")
)
query(
    "preprint_dois",
    f", {
        PRE
    } SELECT DISTINCT doi FROM pre WHERE source = 'PPR' AND doi IS NOT NULL AND date_published >= '2000-03' AND substring(date_published, 1, 4) <= '2009'",
)(lambda s, d: hits.preprint_dois(preprints(s, d), "", None, "2000-03", "2009"))
query("preprint_details", """SELECT pmid AS doi, CASE WHEN pmid IN (SELECT pmid FROM sections) THEN (SELECT
  arg_min(content, pos) FROM sections s WHERE s.pmid = p.pmid) END AS detail FROM papers p""")(
    lambda s, d: hits.preprint_details(
        views.papers(s, d).select(F.col("pmid").alias("doi")),
        views.sections(s, d).select(
            F.col("pmid").alias("doi"), F.transform("sections", lambda x: x["content"]).alias("collection")
        ),
    )
)
query("preprint_papers", """SELECT coalesce(nullif(CASE WHEN i % 2 = 0 THEN '' ELSE pmid END, ''), doi) AS pmid,
  doi, CASE WHEN i % 4 = 0 THEN '2021' ELSE year END AS year,
  CASE i % 3 WHEN 0 THEN 'bioRxiv (preprint)' WHEN 1 THEN 'medRxiv (preprint)' ELSE 'other (preprint)' END AS
  journal, 'PubMed' AS source FROM (SELECT *, CAST(pmid AS BIGINT) AS i FROM papers) WHERE doi IS NOT NULL""")(
    lambda s, d: (lambda i: hits.from_preprints(views.papers(s, d).select(
        F.when(i % 2 == 0, "").otherwise(F.col("pmid")).alias("pmid"), "doi", "title", "abstract", F.array_join(
            "authors", ";"
        ).alias("authors"), F.when(i % 4 == 0, "2021-03-04").otherwise(F.concat("year", F.lit("-01-01"))).alias("date"),
        F.lit(None).cast("string").alias("first_date"), F.element_at(F.array(F.lit("bioRxiv"), F.lit("medrxiv"), F.lit("other")), (i % 3 + 1).cast("int")).alias("server"))).select("pmid", "doi", "year", "journal", "source"))(number())
)
query("pdf_urls", """SELECT pmid, 'https://www.biorxiv.org/content/' || doi || 'v2.full.pdf' AS url,
  'https://www.biorxiv.org/content/' || doi || '.full.pdf' AS plain FROM papers WHERE doi IS NOT NULL AND NOT
  contains(doi, 'v')""")(
    lambda s, d: views.papers(s, d).filter("doi is not null and not contains(doi, 'v')").select(
        "pmid",
        hits.pdf_url(F.concat("doi", F.lit("v2")), F.lit("biorxiv")).alias("url"),
        hits.pdf_url(F.concat("doi", F.lit("v2")), F.lit("biorxiv"), True).alias("plain"),
    )
)
query("preprint_fulltext", """SELECT pmid, CASE WHEN i % 4 = 0 THEN 'explicit' WHEN i % 4 = 1 THEN 'versioned' WHEN
  i % 4 = 2 THEN 'plain' END AS origin, CASE WHEN i % 4 < 3 THEN 'main' END AS section FROM (SELECT pmid, CAST(pmid
  AS BIGINT) AS i FROM papers)""")(
    lambda s, d: _preprint_fulltext(s, d)
)


def _preprint_fulltext(s: SparkSession, d: str) -> DataFrame:
    """Every document's text as the two pages of a PDF, at one of three addresses or none."""
    i = number()
    p = views.table(s, d, "documents").select(
        F.col("doc_id").cast("string").alias("pmid"),
        F.concat(F.lit("10.1101/"), F.col("doc_id").cast("string"), F.lit("v3")).alias("doi"),
        F.lit("medRxiv").alias("journal"),
        F.concat(F.lit("readable text\n"), "text").alias("text"),
    )
    p = p.withColumn("pdf_url", F.when(i % 4 == 0, F.concat(F.lit("https://files.example/"), "pmid")))
    at = F.when(i % 4 == 0, F.col("pdf_url")).when(i % 4 == 1, hits.pdf_url(F.col("doi"), F.lit("medrxiv"))).when(
        i % 4 == 2, hits.pdf_url(F.col("doi"), F.lit("medrxiv"), True)
    )
    pdfs = p.select(
        at.alias("url"), F.array(F.col("text"), F.lit(""), F.lit("last page of it")).alias("pages")
    ).filter("url is not null")
    out = hits.preprint_full_text(p.drop("text"), pdfs)
    u = F.col("full_text_url")
    return out.select(
        "pmid",
        F.when(
            u.contains("files.example"), "explicit"
        ).when(u.contains("v3.full.pdf"), "versioned").when(u.isNotNull(), "plain").alias("origin"),
        F.get("sections", 0)["name"].alias("section"),
    )


TITLES = "works2 AS (SELECT 'doi-' || pmid AS doi, title FROM papers WHERE CAST(pmid AS BIGINT) % 2 = 0)"
query("title_to_doi_exact", f""", {TITLES}, keys AS (SELECT doi, trim(regexp_replace(lower(title),
  '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ') AS k FROM works2),
  asked AS (SELECT DISTINCT upper(title) AS title FROM papers WHERE CAST(pmid AS BIGINT) % 2 = 0 AND NOT
  contains(title, 'ß')) SELECT a.title, min(k.doi) AS doi FROM asked a JOIN keys k
  ON k.k = trim(regexp_replace(lower(a.title), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ') WHERE k.k <> '' GROUP BY
  a.title""")(
    lambda s, d: (
        lambda p: hits.dois_of_titles(
            p.filter(~F.contains("title", F.lit("ß"))).select(F.upper("title").alias("title")),
            p.select(F.concat(F.lit("doi-"), "pmid").alias("doi"), "title"),
        ).filter("score = 1").select("title", "doi")
    )(views.papers(s, d).filter(number() % 2 == 0))
)


# The store


def new_store(spark: SparkSession) -> CorpusStore:
    return CorpusStore(spark, shared.folder(spark, "store"), buckets=8)


def filled_store(spark: SparkSession, sf_dir: str) -> CorpusStore:
    """All papers in one batch, then every fourth anew with another title and a later date."""
    store, p = new_store(spark), views.papers(spark, sf_dir)
    store.upsert("papers", p)
    again = p.filter(number() % 4 == 0).withColumn("title", F.concat(F.lit("new "), "title")).withColumn(
        "collection_date", F.lit("2025-01-01T00:00:00")
    )
    store.upsert("papers", again)
    return store


NEWER = "CASE WHEN CAST(pmid AS BIGINT) % 4 = 0 THEN 'new ' || title ELSE title END"
query(
    "store_upsert",
    f"SELECT pmid, doi, {NEWER} AS title, array_to_string(mesh_terms, '|') AS mesh_terms, source FROM papers",
)(lambda s, d: filled_store(s, d).read("papers").select("pmid", "doi", "title", F.array_join("mesh_terms", "|").alias("mesh_terms"), "source"))
query("store_last_writer_in_a_batch", "SELECT pmid, 'second ' || pmid AS title FROM papers")(
    lambda s, d: _last_writer(s, d)
)


def _last_writer(s: SparkSession, d: str) -> DataFrame:
    store, p = new_store(s), views.papers(s, d)
    twice = p.withColumn(
        "k", F.explode(F.array(F.lit("first "), F.lit("second ")))
    ).withColumn("title", F.concat("k", "pmid"))
    dated = twice.withColumn("collection_date", F.when(F.col("k") == "second ", "2025").otherwise("2024"))
    store.upsert("papers", dated.drop("k"))
    return store.read("papers").select("pmid", "title")


def _after(change):
    def run(s: SparkSession, d: str) -> DataFrame:
        store = filled_store(s, d)
        change(store, views.papers(s, d))
        return store.read("papers").select("pmid", "title")

    return run


query(
    "store_delete", f"SELECT pmid, {NEWER} AS title FROM papers WHERE CAST(pmid AS BIGINT) % 3 <> 0"
)(_after(lambda store, p: store.delete("papers", p.filter(number() % 3 == 0).select("pmid"))))
query("store_restore", "SELECT pmid, title FROM papers")(_after(lambda store, p: store.restore("papers", 1)))
query("store_snapshots", "SELECT * FROM (VALUES (1, 0), (2, 1)) t(version, changed)")(
    lambda s, d: (
        lambda store: s.createDataFrame(
            [
                (
                    v, int(store.read("papers", v).filter("title like 'new %'").limit(1).count())
                ) for v in store.versions("papers")
            ],
            "version int, changed int",
        )
    )(filled_store(s, d))
)
query("store_exists", "SELECT pmid FROM papers WHERE CAST(pmid AS BIGINT) % 5 = 0")(
    lambda s, d: (
        lambda store, p: store.exists(
            p.filter(number() % 5 == 0).select("pmid").unionByName(
                s.createDataFrame([("",), (None,), ("no such id",)], "pmid string")
            )
        )
    )(filled_store(s, d), views.papers(s, d))
)
query("store_exists_by_doi", "SELECT DISTINCT doi FROM papers WHERE doi IS NOT NULL")(
    lambda s, d: filled_store(s, d).exists(views.papers(s, d).select("doi"), "doi").distinct()
)
query("store_by_query_and_mesh", """SELECT doi FROM papers WHERE query_id = 2 AND list_contains(mesh_terms,
  mesh_terms[1]) AND doi IS NOT NULL AND list_contains(mesh_terms, (SELECT mesh_terms[1] FROM papers WHERE query_id
  = 2 AND doi IS NOT NULL ORDER BY pmid LIMIT 1))""")(
    lambda s, d: (
        lambda store: store.by_mesh(
            store.by_query(2).filter("doi is not null").orderBy("pmid").first()["mesh_terms"][0], 2
        )
    )(filled_store(s, d))
)
query(
    "store_query_registry",
    """SELECT q.id, q.query_text, (SELECT count(*) FROM papers p WHERE p.query_id = q.id) AS papers FROM (VALUES (1,
  'aging'), (2, 'theory'), (3, 'cells')) q(id, query_text)""",
)(lambda s, d: _registry(s, d))


def _registry(s: SparkSession, d: str) -> DataFrame:
    store = filled_store(s, d)
    for q in ("aging", "theory", "cells"):
        store.append(
            "queries", s.createDataFrame([(q, "", "now")], "query_text string, description string, created_date string")
        )
    counts = store.read("papers").groupBy("query_id").agg(F.count("*").alias("papers"))
    return store.queries().join(counts, F.col("id") == F.col("query_id"), "left").select(
        F.col("id").cast("int").alias("id"), "query_text", F.coalesce("papers", F.lit(0)).alias("papers")
    )


query(
    "store_failed_dois",
    """SELECT doi, max(pmid) AS pmid, 'second' AS reason FROM papers WHERE doi IS NOT NULL AND NOT is_full_text_pmc
  GROUP BY doi""",
)(lambda s, d: _failed(s, d))


def _failed(s: SparkSession, d: str) -> DataFrame:
    store = new_store(s)
    rows = views.papers(s, d).filter("doi is not null and not is_full_text_pmc").select("doi", "pmid")
    last = rows.groupBy("doi").agg(F.max("pmid").alias("pmid"))
    store.upsert(
        "failed_dois",
        rows.groupBy("doi").agg(F.min("pmid").alias("pmid")).select(
            "doi", "pmid", F.lit("first").alias("reason"), F.lit("1").alias("timestamp")
        ),
    )
    store.upsert(
        "failed_dois", last.select("doi", "pmid", F.lit("second").alias("reason"), F.lit("2").alias("timestamp"))
    )
    return store.read("failed_dois").select("doi", "pmid", "reason")


query(
    "store_query_cache", "SELECT pmid FROM papers WHERE source = 'PPR' ORDER BY pmid LIMIT 40"
)(lambda s, d: _cached(s, d))
query(
    "store_cache_info",
    "SELECT 1 AS entries, least(40, count(*)) AS ids, true AS has_bytes FROM papers WHERE source = 'PPR'",
)(lambda s, d: _cached(s, d, True))


def _cached(s: SparkSession, d: str, info: bool = False) -> DataFrame:
    """A limit is the feature: the second search is answered from the cache, which honours it."""
    store, p = new_store(s), views.papers(s, d)
    collect.cached_search(store, p, "SRC:PPR", 40, "now")
    got = collect.cached_search(store, p.limit(0), "SRC:PPR", 40, "later")
    return store.cache_info().select("entries", "ids", (F.col("bytes") > 0).alias("has_bytes")) if info else got


# Exports


def lines_of(s: SparkSession, path: str) -> DataFrame:
    return s.read.text(path)


def _array(indent: bool):
    def run(s: SparkSession, d: str) -> DataFrame:
        path = shared.folder(s, "export")
        files.write_array(views.papers(s, d).select("pmid", "doi", "title", "mesh_terms"), path, indent)
        kind = "pmid string, doi string, title string, mesh_terms array<string>"
        rows = lines_of(s, path)
        if indent:
            starts = rows.filter(F.rlike("value", F.lit("^[\\[,]\\{"))).count()
            keys = rows.filter(F.col("value").startswith('  "pmid"')).select(
                F.from_json(
                    F.concat(F.lit("{"), F.rtrim(F.regexp_replace("value", ",$", "")), F.lit("}")), "pmid string"
                ).alias("r")
            )
            return keys.select("r.pmid", F.lit(starts).alias("objects"))
        one = rows.filter("value <> ']'").select(
            F.from_json(F.substring(F.col("value"), F.lit(2), F.length("value")), kind).alias("r")
        )
        return one.select("r.pmid", "r.doi", "r.title", F.array_join("r.mesh_terms", "|").alias("mesh_terms"))

    return run


query(
    "export_json_array", "SELECT pmid, doi, title, array_to_string(mesh_terms, '|') AS mesh_terms FROM papers"
)(_array(False))
query("export_json_indented", "SELECT pmid, (SELECT count(*) FROM papers) AS objects FROM papers")(_array(True))
query("export_run_files", """SELECT * FROM (SELECT 'papers_all' AS artefact, count(*) AS n FROM papers UNION ALL
  SELECT 'papers_with_fulltext', count(*) FROM papers WHERE is_full_text_pmc
  UNION ALL SELECT 'papers_without_fulltext', count(*) FROM papers WHERE NOT is_full_text_pmc UNION ALL SELECT
  'pmid_list', count(*) FROM papers UNION ALL SELECT 'query_info', 1 UNION ALL SELECT 'statistics', 1
  UNION ALL SELECT 'checkpoints', CAST(ceil(count(*) / 100.0) AS BIGINT) FROM papers UNION ALL SELECT
  'papers_checkpoint', count(*) FROM papers
  UNION ALL SELECT 'doi_list', count(doi) FROM papers UNION ALL SELECT 'doi_to_pmid_mapping', count(DISTINCT doi)
  FROM papers)""")(lambda s, d: _run_files(s, d))


def _run_files(s: SparkSession, d: str) -> DataFrame:
    path, p = shared.folder(s, "run"), views.papers(s, d)
    files.write_runs(p, path, "a query", "told", p.filter("doi is not null").select("doi"), 100)
    names = (
        "papers_all",
        "papers_with_fulltext",
        "papers_without_fulltext",
        "pmid_list",
        "query_info",
        "statistics",
        "papers_checkpoint",
        "doi_list",
        "doi_to_pmid_mapping",
    )
    counted = [s.read.text(f"{path}/{n}").agg(F.lit(n).alias("artefact"), F.count("*").alias("n")) for n in names]
    batches = s.read.json(f"{path}/papers_checkpoint").agg(
        F.lit("checkpoints").alias("artefact"), F.count_distinct("batch").alias("n")
    )
    out = batches
    for c in counted:
        out = out.unionByName(c)
    return out


def _text_lines(make):
    def run(s: SparkSession, d: str) -> DataFrame:
        path = shared.folder(s, "lines")
        return make(s, views.papers(s, d), path)

    return run


def _doi_output(s, p, path):
    files.write_lines(p.filter("query_id = 3 and doi is not null"), "doi", path)
    return files.doi_list(s, path)


def _doi_file(s, p, path):
    lines = F.concat(F.when(number() % 4 == 0, "# ").otherwise("  "), F.coalesce("doi", F.lit("")), F.lit(" \t"))
    p.select(lines.alias("value")).write.text(path)
    return files.doi_list(s, path)


def _titles(s, p, path):
    files.write_titles(p.select(F.lit("title of it").alias("title"), "doi"), path)
    return s.read.text(f"{path}/title_doi").select(F.col("value").alias("line"))


query("export_doi_list", "SELECT doi FROM papers WHERE query_id = 3 AND doi IS NOT NULL")(_text_lines(_doi_output))
query(
    "doi_list_file", "SELECT doi FROM papers WHERE CAST(pmid AS BIGINT) % 4 <> 0 AND doi IS NOT NULL"
)(_text_lines(_doi_file))
query(
    "export_title_dois", "SELECT 'title of it:' || doi AS line FROM papers WHERE doi IS NOT NULL"
)(_text_lines(_titles))
query("export_failed_json", """SELECT pmid, doi, title, authors FROM (SELECT pmid, doi, title,
  array_to_string(list_slice(authors, 1, 3), '; ') AS authors FROM papers WHERE NOT is_full_text_pmc)""")(
    _text_lines(
        lambda s, p, path: (
            corpus.failed_export(p).drop("line", "abstract").write.json(path),
            s.read.schema("pmid string, doi string, title string, authors string").json(path),
        )[1]
    )
)
query(
    "query_catalogue",
    """SELECT * FROM (VALUES ('1', 'one', 'aging'), ('2', 'two', 'theory'), ('2', 'two', 'cells'), ('3', 'three',
  NULL)) t(id, name, query)""",
)(lambda s, d: _catalogue(s))
query(
    "collection_config", "SELECT 'aging' AS query, 5 AS max_results, 60000 AS check_num, false AS use_suffix"
)(lambda s, d: _config(s))


def _json_file(s: SparkSession, value: str) -> str:
    path = shared.folder(s, "json")
    s.createDataFrame([(value,)], "value string").coalesce(1).write.text(path)
    return path


def _catalogue(s: SparkSession) -> DataFrame:
    return files.catalogue(
        s,
        _json_file(
            s,
            '{"queries": [{"id": "1", "name": "one", "query": "aging"}, {"id": "2", "name": "two", "queries": ["theory", "cells"]}, {"id": "3", "name": "three"}]}',
        ),
    )


def _config(s: SparkSession) -> DataFrame:
    c = files.config(s, _json_file(s, '{"queries": ["aging"], "max_results": 5}'))
    return s.createDataFrame(
        [(c["queries"][0], c["max_results"], c["check_num"], c["use_suffix"])],
        "query string, max_results int, check_num int, use_suffix boolean",
    )


query(
    "output_folders",
    """SELECT * FROM (VALUES ('base', '/x'), ('data', '/x/data'), ('checkpoints', '/x/checkpoints'), ('logs',
  '/x/logs'), ('store', '/x/test_store')) t(name, path)""",
)(lambda s, d: s.createDataFrame(list(files.output_folders("/x/", True).items()), "name string, path string"))


# Scalar functions

paper_query(
    "pmcid_digits",
    "SELECT pmid, CASE WHEN CAST(pmid AS BIGINT) % 2 = 0 THEN pmid ELSE 'x' || pmid END AS digits FROM papers",
)(lambda p: p.select("pmid", text.pmcid_digits(F.when(number() % 2 == 0, F.concat(F.lit("PMC"), "pmid")).otherwise(F.concat(F.lit("x"), "pmid"))).alias("digits")))
paper_query("month_numbers", """SELECT pmid, ['01', '02', '03', '04', '05', '06', '07', '08', '09', '10', '11',
  '12', '13', 'Spring'][CAST(CAST(pmid AS BIGINT) % 14 + 1 AS INTEGER)] AS month FROM papers""")(
    lambda p: p.select(
        "pmid",
        text.month_number(
            F.element_at(
                F.array(
                    *(
                        F.lit(m) for m in (
                            "Jan",
                            "Feb",
                            "Mar",
                            "Apr",
                            "May",
                            "Jun",
                            "Jul",
                            "Aug",
                            "Sep",
                            "Oct",
                            "Nov",
                            "Dec",
                            "13",
                            "Spring",
                        )
                    )
                ),
                (number() % 14 + 1).cast("int"),
            )
        ).alias("month"),
    )
)
paper_query("doi_unversioned", """SELECT pmid, CASE WHEN CAST(pmid AS BIGINT) % 2 = 0 THEN '10.1101/a.' || pmid ELSE
  '10.1101/a.' || pmid || 'v1' END AS doi FROM papers""")(
    lambda p: p.select(
        "pmid",
        text.doi_unversioned(
            F.concat(F.lit("10.1101/a."), "pmid", F.when(number() % 2 == 0, "v12").otherwise("v1v3"))
        ).alias("doi"),
    )
)
paper_query("duration_seconds", """SELECT pmid, CASE WHEN CAST(pmid AS BIGINT) % 3 = 0 THEN NULL ELSE CAST(CAST(pmid
  AS BIGINT) % 50 * 60 + 1.5 AS DOUBLE) END AS seconds FROM papers""")(
    lambda p: p.select(
        "pmid",
        text.seconds_between(
            F.lit("2024-01-01T00:00:00"),
            F.when(number() % 3 == 0, "never").otherwise(
                F.concat(F.lit("2024-01-01T00:"), F.lpad((number() % 50).cast("string"), 2, "0"), F.lit(":01.500"))
            ),
        ).alias("seconds"),
    )
)
paper_query("display_cuts", """SELECT pmid, CASE WHEN length(title) > 70 THEN substring(title, 1, 70) || '...' ELSE
  title END AS title, CASE WHEN length(journal) > 10 THEN substring(journal, 1, 10) || '...' ELSE journal END AS
  journal FROM papers""")(
    lambda p: p.select(
        "pmid", text.ellipsis(F.col("title"), 70).alias("title"), text.ellipsis(F.col("journal"), 10).alias("journal")
    )
)
query("query_suffix", "SELECT * FROM (VALUES ('aging AND (full text[sb])'), ('aging')) t(query)")(
    lambda s, d: s.createDataFrame(
        [(with_suffix("aging", " AND (full text[sb])"),), (with_suffix("aging", " "),)], "query string"
    )
)
query("clean_sections", f"""SELECT pmid, pos, name, cleaned AS content FROM (SELECT pmid, pos, name,
  array_to_string(list_filter(list_transform(string_split(regexp_replace(regexp_replace(content, chr(9) || '+', ' ',
  'g'), ' {{3,}}', ' ', 'g'), chr(10)), lambda s: {STRIP % "s"}), lambda s: length(s) > 1 AND regexp_matches(s,
  '[\\p{{L}}\\p{{N}}]')), chr(10)) AS cleaned
  FROM (SELECT pmid, pos, CASE WHEN pos % 3 = 1 THEN '' ELSE name END AS name, CASE WHEN pos % 3 = 1 THEN ' ' ||
  chr(10) || ' ' ELSE content || chr(10) || '--' || chr(9) || chr(9) || chr(10) || 'end   of it' END AS content FROM
  sections WHERE NOT contains(content, '$') AND NOT contains(content, '\\'))) WHERE cleaned <> ''""")(
    lambda s, d: _clean_sections(s, d)
)


def _clean_sections(s: SparkSession, d: str) -> DataFrame:
    blank = F.col("pos") % 3 == 1
    content = F.when(blank, " \n ").otherwise(F.concat("content", F.lit("\n--\t\t\nend   of it")))
    rows = views.section_rows(s, d).filter(~F.contains("content", F.lit("$")) & ~F.contains("content", F.lit("\\")))
    rows = rows.select(
        "pmid",
        F.struct("pos", F.when(blank, "").otherwise(F.col("name")).alias("name"), content.alias("content")).alias("s"),
    )
    whole = rows.groupBy("pmid").agg(F.array_sort(F.collect_list("s")).alias("sections"))
    return whole.select(
        "pmid", F.explode(sections.clean_sections(F.col("sections"))).alias("s")
    ).select("pmid", "s.pos", "s.name", "s.content")


# Predicates, searches, orders

query("volume_guard", "SELECT pmid FROM papers")(
    lambda s, d: (lambda p: corpus.guard(p, p.count() + 1))(views.papers(s, d).select("pmid"))
)
paper_query("not_seen_before", "SELECT DISTINCT pmid FROM papers WHERE CAST(pmid AS BIGINT) % 3 <> 0")(
    lambda p: corpus.missing(
        p.select("pmid").unionByName(p.select("pmid")).dropDuplicates(["pmid"]),
        p.filter(number() % 3 == 0).select("pmid"),
    )
)
paper_query("distinct_ids", "SELECT DISTINCT pmid FROM papers WHERE year >= '2000' OR source = 'PPR'")(
    lambda p: p.filter("year >= '2000'").select("pmid").union(p.filter("source = 'PPR'").select("pmid")).distinct()
)
paper_query("search_publication_type", "SELECT pmid FROM papers WHERE source = 'PPR' OR CAST(pmid AS BIGINT) % 4 = 0")(
    lambda p: (lambda q: q.filter(predicate('"Systematic Review"[Publication Type] OR preprint[pt]', q.columns)).select("pmid"))(p.withColumn("publication_type", F.when(F.col("source") == "PPR", "Preprint; Other").when(number() % 4 == 0, "Trial; Systematic  Review").otherwise("Reviewer"))))
paper_query("search_major_topic", "SELECT pmid FROM papers WHERE CAST(pmid AS BIGINT) % 6 = 0")(
    lambda p: (lambda q: q.filter(predicate("mice/genetics[MAJR]", q.columns)).select("pmid"))(
        p.withColumn("mesh_terms", F.array(F.lit("Mice"))).withColumn(
            "mesh_major", F.when(number() % 6 == 0, F.array(F.lit("Mice"))).otherwise(F.array().cast("array<string>"))
        )
    )
)
query(
    "search_month_range",
    f", {PRE} SELECT pmid FROM pre WHERE date_published >= '2003-05' AND date_published < '2004-04'",
)(lambda s, d: preprints(s, d).filter(predicate("2003/05:2004/03[dp]")).select("pmid"))
query(
    "search_one_month", f", {PRE} SELECT pmid FROM pre WHERE substring(date_published, 1, 7) = '2003-05'"
)(lambda s, d: preprints(s, d).filter(predicate("2003/05[pdat]")).select("pmid"))
paper_query("search_doi_and_subset", """SELECT pmid FROM papers WHERE doi = (SELECT doi FROM papers WHERE doi IS NOT
  NULL ORDER BY pmid LIMIT 1) OR is_full_text_pmc""")(
    lambda p: p.filter(
        predicate(f'{p.filter("doi is not null").orderBy("pmid").first()["doi"].upper()}[DOI] OR "full text"[sb]')
    ).select("pmid")
)
query(
    "works_by_doi_filter",
    """SELECT doi, cited_by_count FROM works WHERE doi IN (SELECT 'https://doi.org/' || upper(doi) FROM papers WHERE
  CAST(pmid AS BIGINT) % 9 = 1)""",
)(lambda s, d: _doi_filter(s, d))


def _doi_filter(s: SparkSession, d: str) -> DataFrame:
    """The service's batch filter as a join with its list. A filter's text is what a user enters: it is short."""
    asked = views.papers(s, d).filter((number() % 9 == 1) & F.col("doi").isNotNull()).agg(
        F.array_join(F.collect_list("doi"), "|").alias("f")
    ).first()["f"]
    wanted = s.createDataFrame([(x,) for x in doi_filter(f"doi:{asked}")], "k string").distinct()
    w = views.works(s, d)
    return w.withColumn("k", text.doi_key(F.col("doi"))).join(wanted, "k", "left_semi").select("doi", "cited_by_count")


paper_query("sorted_by_count", """SELECT doi, n, row_number() OVER (ORDER BY n DESC, doi) AS place FROM (SELECT doi,
  count(*) AS n FROM papers WHERE coalesce(doi, '') <> '' GROUP BY doi HAVING count(*) > 1)""")(
    lambda p: corpus.numbered(
        dedup.groups(p).select(
            "doi", "n", F.concat(F.lpad((10**12 - F.col("n")).cast("string"), 12, "0"), "doi").alias("k")
        ),
        "k",
    ).select("doi", "n", (F.col("number") + 1).alias("place"))
)
SCORE = "len(list_filter(regexp_split_to_array(lower(coalesce({c}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w IN ('the', 'und', 'de')))"
paper_query(
    "relevance_order",
    f"SELECT pmid, CAST(2 * {SCORE.format(c='title')} + {SCORE.format(c='abstract')} AS BIGINT) AS score FROM papers",
)(lambda p: corpus.relevance(p, ["the", "UND", "de"]).select("pmid", "score"))
paper_query(
    "first_ids", "SELECT pmid FROM papers WHERE source = 'MED' ORDER BY pmid LIMIT 25"
)(lambda p: collect.search(p, "SRC:MED", 25))
paper_query(
    "page_of_ids", "SELECT pmid FROM papers ORDER BY pmid LIMIT 20 OFFSET 40"
)(lambda p: p.select("pmid").orderBy("pmid").offset(40).limit(20))


# Statistics and reports

query("reclean_counts", f"""SELECT count(*) FILTER (WHERE a <> abstract) AS modified, count(*) FILTER (WHERE a =
  abstract) AS unchanged FROM (SELECT abstract, {SQUASH % 'abstract'} AS a FROM papers)""")(
    lambda s, d: corpus.reclean_counts(views.papers(s, d).select("abstract", F.lit("clean text").alias("full_text")))
)
paper_query("append_report", """SELECT count(*) FILTER (WHERE i % 2 = 0) AS before, count(*) AS after, count(*)
  FILTER (WHERE i % 2 = 1) AS added, count(*) FILTER (WHERE i % 2 = 0 AND i % 3 = 0) AS known, (SELECT
  string_agg(pmid, ',' ORDER BY pmid) FROM (SELECT pmid FROM papers WHERE CAST(pmid AS BIGINT) % 2 = 0 ORDER BY pmid
  LIMIT 5)) AS sample FROM (SELECT CAST(pmid AS BIGINT) AS i FROM papers)""")(
    lambda p: corpus.append_report(
        p.filter(number() % 2 == 0), p, p.filter((number() % 2 == 1) | (number() % 3 == 0))
    ).withColumn("sample", F.array_join("sample", ","))
)
paper_query("change_notes", """SELECT pmid, concat_ws('; ', CASE WHEN coalesce(abstract, '') = '' THEN
  'abstract added' ELSE 'abstract longer by 5' END, CASE WHEN coalesce(full_text, '') = '' THEN 'full_text added'
  END, 'authors grew by 1') AS changes FROM papers WHERE CAST(pmid AS BIGINT) % 2 = 0""")(
    lambda p: corpus.changes(
        p,
        p.filter(number() % 2 == 0).withColumns(
            {
                "abstract": F.concat(F.coalesce("abstract", F.lit("")), F.lit(" more")),
                "full_text": F.coalesce("full_text", F.lit("text")),
                "authors": F.concat("authors", F.array(F.lit("New A"))),
            }
        ),
    ).select("pmid", F.array_join("changes", "; ").alias("changes"))
)
paper_query(
    "reclean_preview",
    """SELECT pmid, 'a   b' AS before, 'a b' AS after, 5 AS chars_before, 3 AS chars_after FROM papers ORDER BY pmid
  LIMIT 3""",
)(lambda p: corpus.reclean_preview(p.select("pmid", F.lit("a   b").alias("full_text"))))
query(
    "run_summary",
    """SELECT * FROM (VALUES ('total processed: ' || (SELECT count(*) FROM papers)), ('with full text: ' || (SELECT
  count(*) FROM papers WHERE is_full_text_pmc)), ('seconds: 90'), ('query: aging')) t(line)""",
)(lambda s, d: _summary(s, d))


def _summary(s: SparkSession, d: str) -> DataFrame:
    p = views.papers(s, d)
    run = p.agg(F.count("*").alias("total_processed"), F.count_if("is_full_text_pmc").alias("with_full_text"))
    zero = {
        c: F.lit(0) for c in ("total_found", "without_full_text", "with_openalex", "failed_pubmed", "failed_openalex")
    }
    run = run.withColumns(
        {
            **zero,
            "query": F.lit("aging"),
            "start_time": F.lit("2024-01-01T00:00:00"),
            "end_time": F.lit("2024-01-01T00:01:30"),
        }
    )
    lines = corpus.run_summary(run).split("\n")
    return s.createDataFrame(
        [(x,) for x in lines if x.split(":")[0] in ("total processed", "with full text", "seconds", "query")],
        "line string",
    )


query(
    "enrich_one",
    """SELECT p.pmid, w.cited_by_count FROM papers p JOIN works w ON lower(replace(w.doi, 'https://doi.org/', '')) =
  p.doi WHERE p.pmid = (SELECT min(q.pmid) FROM papers q JOIN works v ON lower(replace(v.doi, 'https://doi.org/',
  '')) = q.doi)""",
)(lambda s, d: _enrich_one(s, d))


def _enrich_one(s: SparkSession, d: str) -> DataFrame:
    none = {c: F.lit(None).cast(k) for c, k in (("citation_normalized_percentile", "double"), ("fwci", "double"), ("oa_url", "string"))}
    p, w = views.papers(s, d).withColumns(none), views.works(s, d)
    first = p.withColumn("k", text.doi_key(F.col("doi"))).join(
        w.select(text.doi_key(F.col("doi")).alias("k")), "k", "left_semi"
    ).agg(F.min("pmid")).first()[0]
    return corpus.enrich(p.filter(F.col("pmid") == first), w).select("pmid", "cited_by_count")


# Runs

COUNTS = "count(*) AS total_processed, count(*) FILTER (WHERE is_full_text_pmc) AS with_full_text"
query("collection_run", f"""SELECT 'aging' AS query, {COUNTS}, count(*) FILTER (WHERE NOT is_full_text_pmc) AS
  without_full_text FROM papers""")(
    lambda s, d: collect.collect(
        new_store(s), _bare(s, d), views.works(s, d), "aging", "2024-01-01T00:00:00", "2024-01-01T00:01:00"
    ).select("query", "total_processed", "with_full_text", "without_full_text")
)


def _bare(s: SparkSession, d: str) -> DataFrame:
    none = {c: F.lit(None).cast(k) for c, k in (("citation_normalized_percentile", "double"), ("fwci", "double"), ("oa_url", "string"))}
    return views.papers(s, d).withColumns(none)


query("collection_repeated", f"""SELECT 1 AS id, 'aging' AS query, {COUNTS}, 1 AS runs, 1 AS queries, 1 AS snapshots FROM
  papers""")(lambda s, d: _repeated_run(s, d))


def _repeated_run(s: SparkSession, d: str) -> DataFrame:
    """A run that broke off behind its query and its papers, and is repeated twice under its id."""
    store, p, w, when = new_store(s), _bare(s, d), views.works(s, d), "2024-01-01T00:00:00"
    run = lambda: collect.collect(store, p, w, "aging", when, "2024-01-01T00:01:00", run_id="run-1")
    asked = s.createDataFrame([("aging", "", when)], "query_text string, description string, created_date string")
    number_ = store.append("queries", asked, "run-1")
    dated = corpus.enrich(p.withColumns({"query_id": F.lit(number_).cast("long"), "collection_date": F.lit(when)}), w)
    store.upsert("papers", dated, "run-1")
    run()
    told = {"runs": "collection_runs", "queries": "queries"}
    counts = {n: F.lit(len(store.versions(t))) for n, t in told.items()} | {"snapshots": F.lit(len(store.versions("papers")))}
    return run().select("id", "query", "total_processed", "with_full_text").withColumns(counts)


query("collection_rejects", """SELECT count(*) FILTER (WHERE doc_id % 7 NOT IN (1, 2, 3)) AS total_processed, count(*)
  FILTER (WHERE doc_id % 7 NOT IN (1, 2, 3)) AS total_found, count(*) FILTER (WHERE doc_id % 7 IN (1, 2, 3)) AS
  failed_pubmed FROM documents""")(
    lambda s, d: collect.collect_xml(
        new_store(s), mixed_xml(s, d), views.works(s, d), "aging", "2024-01-01T00:00:00", "2024-01-01T00:01:00"
    ).select("total_processed", "total_found", "failed_pubmed")
)
query("rejects_retried", f""", r AS ({REJECTS}) SELECT pmid, 'paper' AS state FROM (SELECT CAST(doc_id AS VARCHAR) AS
  pmid FROM documents WHERE doc_id % 7 NOT IN (2, 3)) UNION ALL SELECT pmid, reason FROM r WHERE reason <>
  'malformed'""")(lambda s, d: _retried(s, d))


def _retried(s: SparkSession, d: str) -> DataFrame:
    """All records are collected, then the ones that were cut short come whole."""
    store, works = new_store(s), views.works(s, d)
    collect.collect_xml(store, mixed_xml(s, d), works, "aging", "2024-01-01T00:00:00", "2024-01-01T00:01:00")
    whole = store.read("rejects").filter("reason = 'malformed'").select("digest", "pmid").join(article_xml(s, d), "pmid")
    collect.retry_rejects(
        store, works, "2024-01-02T00:00:00", "2024-01-02T00:01:00", repaired=whole.select("digest", F.col("xml").alias("record"))
    )
    papers = store.read("papers").select("pmid", F.lit("paper").alias("state"))
    return papers.unionByName(store.read("rejects").select("pmid", F.col("reason").alias("state")))


query("dois_run_missing", """SELECT 'no-' || pmid AS doi FROM papers WHERE CAST(pmid AS BIGINT) % 2 = 1 AND doi IS
  NOT NULL""")(
    lambda s, d: (
        lambda p: collect.collect_from_dois(
            new_store(s),
            p.filter("doi is not null").select(
                F.when(number() % 2 == 1, F.concat(F.lit("no-"), "pmid")).otherwise(F.upper("doi")).alias("doi")
            ),
            p,
            views.works(s, d),
            "2024-01-01T00:00:00",
            "2024-01-01T00:01:00",
        )[1]
    )(_bare(s, d))
)
query("files_run", """SELECT pmid, coalesce(w.cited_by_count, p.cited_by_count) AS cited_by_count FROM papers p LEFT
  JOIN works w ON lower(replace(w.doi, 'https://doi.org/', '')) = p.doi WHERE CAST(pmid AS BIGINT) % 3 <> 0""")(
    lambda s, d: (
        lambda p, path: (
            collect.collect_to_files(p, views.works(s, d), path, "aging", seen=p.filter(number() % 3 == 0)),
            s.read.schema("pmid string, cited_by_count bigint").json(f"{path}/papers_all"),
        )[1]
    )(_bare(s, d), shared.folder(s, "files-run"))
)
HITS = "CASE WHEN i % 5 = 0 THEN NULL ELSE pmid END"
query("europepmc_batch", f""", {TURNS}, {MEANT}, flag AS (SELECT f.pmid, (m >= 1 AND l >= 1) OR (l >= 3 AND b < l)
  OR (NOT (b > 0 AND m = 0 AND l < 3) AND l >= 2 AND n > 3000) AS full_body FROM flats f JOIN meant USING (pmid))
  SELECT coalesce({HITS}, doi) AS pmid, coalesce(f.full_body, false) AS is_full_text_pmc FROM (SELECT *, CAST(pmid
  AS BIGINT) AS i FROM papers) p LEFT JOIN flag f USING (pmid) WHERE NOT (i % 5 = 0 AND doi IS NULL)""")(lambda s, d: _batch(s, d).select("pmid", "is_full_text_pmc"))


def _batch(s: SparkSession, d: str) -> DataFrame:
    hits_ = views.papers(s, d).select(
        F.when(
            number() % 5 != 0, F.col("pmid")
        ).alias("pmid"), F.concat(F.lit("PMC"), "pmid").alias("pmcid"), "doi", "title", "abstract", F.array_join("authors", "; ").alias("authors"),
        "journal", "year", F.col("collection_date").alias("date"), "source", "cited_by_count",
    )
    return collect.batch_papers(hits_, jats_xml(s, d), views.works(s, d))


query(
    "single_paper",
    f", a AS ({ARTICLES}) SELECT a.pmid, coalesce(a.pmcid, 'PMC' || a.pmid) AS pmcid, a.doi FROM a WHERE pmid = '1'",
)(lambda s, d: collect.one_paper("1", article_xml(s, d), jats_xml(s, d), views.works(s, d)).select("pmid", "pmcid", "doi"))


# Remote services, over an offline client

CLIENT = "paperloom.sources.offline:Numbers"


def _remote(name: str, **options):
    def run(s: SparkSession, d: str) -> DataFrame:
        remote.register(s)
        return s.read.format(name).options(client=CLIENT, requests_per_second="100000", **options).load()

    return run


query(
    "remote_pages", "SELECT 'small-' || i AS pmid FROM range(7000) t(i)"
)(_remote("corpus_search", query="small", max_results="7000"))
query("remote_date_split", """SELECT y || '/' || lpad(CAST(m AS VARCHAR), 2, '0') || '-' || i AS pmid FROM (SELECT
  2024 AS y, m FROM range(1, 13) a(m)) CROSS JOIN range(900) b(i)
  UNION ALL SELECT '2023/' || lpad(CAST(m AS VARCHAR), 2, '0') || '-' || i FROM range(1, 5) a(m) CROSS JOIN
  range(900) b(i) WHERE m < 5 AND (m - 1) * 900 + i < 3200""")(_remote("corpus_search", query="large", max_results="14000", last_year="2024"))
query(
    "remote_cursor", "SELECT 'small-' || i AS id FROM range(2345) t(i)"
)(_remote("corpus_cursor", query="small", max_results="2345"))
query("remote_works_fallback", "SELECT 'd' || i AS doi, i AS cited_by_count FROM range(120) t(i) WHERE i % 10 <> 7")(
    lambda s, d: _remote(
        "corpus_works", dois="|".join(f"d{i}" for i in range(120)), batch="20", daily_budget="100000"
    )(s, d).select("doi", "cited_by_count")
)
