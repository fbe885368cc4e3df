"""Full text from article XML and HTML pages, and the order in which sources are tried.

Nested sections need a tree, which SQL's XML functions don't give: both parsers run over Arrow batches. Everything that
can be decided before parsing (which rows, which columns) is, so only needed pages reach Python.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.falsy import filled
from paperloom.functions.sections import SECTIONS
from paperloom.functions.text import clean_abstract, clean_comprehensive, doi_key
from paperloom.functions.validity import has_meaningful_content

#: Least lengths of paragraphs, of a body, of front or back matter, of a whole article and of a page.
PARAGRAPH, BODY, MATTER, ARTICLE, PAGE, HEADING = 30, 100, 100, 200, 500, 200
#: Pages that a task parses before it passes their texts on.
PAGES = 64
#: Sections nested deeper than this are headed and named like one at this depth.
DEPTH = 100
JATS = f"full_text string, sections {SECTIONS}, has_body boolean, abstract string"


def _said(node) -> str:
    return " ".join(x for t in node.itertext() if (x := t.strip()))


def _sections(tops, out: dict[str, str]) -> list[str]:
    """Flat texts of top-level sections; sub-sections enter ``out`` before the section that holds them. No recursion."""
    texts = []
    for top in tops:
        parts: list[str] = []
        work = [(top, 1, "", None)]
        while work:
            node, level, path, own = work.pop()
            if own is not None:  # behind its sub-sections
                out[path] = own
                continue
            title = node.find("title")
            name = (_said(title) if title is not None else "") or f"Section {level}"
            path = f"{path}/{name}" if path and level < DEPTH else path or name
            said = [x for p in node.findall("p") if (x := _said(p))]
            parts += [f"{'#' * level} {name}", *said]
            if said:
                work.append((node, level, path, "\n\n".join(said)))
            work += [(s, min(level + 1, DEPTH), path, None) for s in reversed(node.findall("sec"))]
        texts.append("\n\n".join(parts))
    return texts


def _bodyless(article, abstract) -> tuple[list, list]:
    """(outermost sections, paragraphs outside of any section) of an article without body, its abstract left out."""
    tops, loose = [], []
    work = [(article, False)]
    while work:
        node, inside = work.pop()
        if node is abstract:
            continue
        if node.tag == "sec" and not inside:
            tops.append(node)
            inside = True
        elif node.tag == "p" and not inside:
            loose.append(node)
        work += [(c, inside) for c in reversed(node)]
    return tops, loose


def _strings(node, skipped, tails: bool) -> list[str]:
    """Texts of ``node`` and all elements below it but ``skipped``, each with its tail if asked for."""
    out, work = [], [node]
    while work:
        e = work.pop()
        if e is not skipped:
            out += [s for t in (e.text, e.tail if tails else None) if t and (s := t.strip())]
            work += reversed(e)
    return out


def extras(article) -> dict[str, list[dict[str, str]]]:
    """Tables and figures (label, caption, and a table's cells as lines of a | b), references as text, of an article."""
    out: dict[str, list[dict[str, str]]] = {"tables": [], "figures": [], "references": []}
    text = lambda e, tag: _said(x) if (x := e.find(tag)) is not None else ""
    for e in article.iter():
        if e.tag == "table-wrap":
            rows = [" | ".join(_said(c) for c in r if c.tag in ("td", "th")) for r in e.iter("tr")]
            out["tables"].append(
                {"label": text(e, "label"), "caption": text(e, "caption"), "content": "\n".join(r for r in rows if r)}
            )
        elif e.tag == "fig":
            out["figures"].append({"label": text(e, "label"), "caption": text(e, "caption"), "content": ""})
        elif e.tag == "ref":
            label = text(e, "label")
            cited = next(
                (c for c in e if c.tag in ("mixed-citation", "element-citation", "citation", "nlm-citation")), e
            )
            out["references"].append({"label": label, "caption": "", "content": _said(cited)})
    return out


def _extra_text(found: dict, include: tuple[str, ...]) -> list[tuple[str, str]]:
    """(section name, text) of the extras asked for."""
    out = []
    for kind, name, one in (
        ("tables", "TABLES", "Table"), ("figures", "FIGURES", "Figure"), ("references", "REFERENCES", "")
    ):
        if kind in include and found[kind]:
            lines = []
            for k, x in enumerate(found[kind], 1):
                if one:
                    head = f"**{one} {k}:** {x['caption']}".rstrip()
                    lines.append(head + (f"\n{x['content']}" if x["content"] else ""))
                else:
                    lines.append(f"[{k}] {x['content']}")
            out.append((name, "\n\n".join(lines)))
    return out


def parse_jats(xml: str | None, include: tuple[str, ...] = ()) -> tuple:
    """(full_text, sections, has_body, abstract) of an article; nulls if there is none to parse.

    ``include`` adds sections of its "tables", "figures" and "references" behind the text.
    """
    try:
        root = ElementTree.fromstring(xml or "")
    except ElementTree.ParseError:
        return None, [], False, None
    article = root if root.tag == "article" else root.find(".//article")
    if article is None:
        return None, [], False, None
    found = article.find(".//abstract")
    abstract = _said(found) if found is not None else None
    sections: dict[str, str] = {}
    body = article.find("body")
    parts = []
    if body is not None:
        loose = [x for p in body.findall("p") if (x := _said(p))]
        if loose:
            sections["Main"] = "\n\n".join(loose)
            parts.append(sections["Main"])
        parts += _sections(body.findall("sec"), sections)
    else:
        tops, paragraphs = _bodyless(article, found)
        parts += _sections(tops, sections)
        loose = [x for p in paragraphs if len(x := _said(p)) > PARAGRAPH]
        if loose:
            sections["Main"] = "\n\n".join(loose)
            parts.append(sections["Main"])
    text = "\n\n".join(x for x in parts if x)
    has_body = body is not None and bool(text)
    if not text and body is not None and len(whole := _said(body)) > BODY:
        text, has_body = whole, True
        sections["Main"] = whole
    if not text:
        for tag, name in (("front", "Front"), ("back", "Back")):
            node = article.find(tag)
            if node is not None and len(x := " ".join(_strings(node, found, False))) > MATTER:
                sections[name] = x
        text = "\n\n".join(sections.values())
    if not text:
        rest = " ".join(_strings(article, found, True))
        if len(rest) > ARTICLE:
            text = sections["Content"] = rest
    if include:
        for name, more in _extra_text(extras(article), include):
            sections[name] = more
            text = f"{text}\n\n## {name}\n\n{more}" if text else f"## {name}\n\n{more}"
    return text or None, [(k, n, c) for k, (n, c) in enumerate(sections.items())], has_body, abstract


class _Page(HTMLParser):
    """A page as flat arrays in document order: tag, classes and id of each node, the node behind its last descendant, its
    parent, and the range of shown text that it holds. Scripts and styles show nothing."""

    VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
    HIDDEN = frozenset(("script", "style"))

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.classes, self.ids, self.parents = [], [], [], []
        self.behind, self.first, self.last = [], [], []
        self.open, self.count, self.hidden = [], {}, 0
        self.parts, self.size = [], 0

    def _new(self, tag, attrs) -> int:
        given = dict(attrs)
        self.tags.append(tag)
        self.classes.append((given.get("class") or "").split())
        self.ids.append(given.get("id"))
        self.parents.append(self.open[-1] if self.open else -1)
        self.behind.append(len(self.tags))
        self.first.append(self.size)
        self.last.append(self.size)
        return len(self.tags) - 1

    def _shut(self) -> None:
        k = self.open.pop()
        tag = self.tags[k]
        self.count[tag] -= 1
        self.hidden -= tag in self.HIDDEN
        self.behind[k], self.last[k] = len(self.tags), self.size

    def handle_starttag(self, tag, attrs):
        if tag == "p" and self.open and self.tags[self.open[-1]] == "p":
            self._shut()
        k = self._new(tag, attrs)
        if tag not in self.VOID:
            self.open.append(k)
            self.count[tag] = self.count.get(tag, 0) + 1
            self.hidden += tag in self.HIDDEN

    def handle_startendtag(self, tag, attrs):
        self._new(tag, attrs)

    def handle_endtag(self, tag):
        if self.count.get(tag):
            while self.tags[self.open[-1]] != tag:
                self._shut()
            self._shut()

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)
            self.size += len(data)

    def close(self):
        super().close()
        while self.open:
            self._shut()
        self.text = "".join(self.parts)

    def shown(self, k: int) -> str:
        return self.text[self.first[k] : self.last[k]].strip()


def _article(page: _Page) -> int | None:
    """The node that holds the article: the first that passes the first test that any node passes."""
    tests = (
        lambda k: page.tags[k] == "div" and "jig-ncbiinpagenav" in page.classes[k],
        lambda k: page.tags[k] == "article",
        lambda k: page.tags[k] == "div" and "article" in page.classes[k],
        lambda k: page.ids[k] == "article",
    )
    return next((k for test in tests for k in range(len(page.tags)) if test(k)), None)


def parse_html(source: str | None) -> str | None:
    """Text of an article page by headed sections, else by paragraphs; null if too short. Not cleaned."""
    page = _Page()
    page.feed(source or "")
    page.close()
    top = _article(page)
    if top is None:
        return None
    inside = range(top + 1, page.behind[top])
    headings = [k for k in inside if page.tags[k] in ("h2", "h3", "h4", "title") and page.shown(k)]
    long = lambda k: page.last[k] - page.first[k] > PARAGRAPH and len(page.shown(k)) > PARAGRAPH
    paragraphs = [k for k in inside if page.tags[k] == "p" and long(k)]
    children: dict[int, list[int]] = {}
    for k in paragraphs:
        children.setdefault(page.parents[k], []).append(k)
    parts = []
    for k in inside:
        if page.tags[k] not in ("div", "section") or k not in children:
            continue
        at = bisect.bisect_right(headings, k)
        title = page.shown(headings[at]) if at < len(headings) and headings[at] < page.behind[k] else None
        text = "\n\n".join(page.shown(p) for p in children[k])
        parts.append((f"## {title}\n\n" if title and len(title) < HEADING else "") + text)
    whole = "\n\n".join(parts or [page.shown(k) for k in paragraphs])
    return whole if len(whole) > PAGE else None


def jats(articles: DataFrame, column: str = "xml", include: tuple[str, ...] = ()) -> DataFrame:
    """``articles`` with JATS columns of each XML text; ``include`` as in ``parse_jats``."""

    @F.pandas_udf(f"struct<full_text:string,sections:{SECTIONS},has_body:boolean,abstract:string>")
    def parsed(xml: pd.Series) -> pd.DataFrame:
        rows = [parse_jats(x, include) for x in xml]
        sections = [[{"pos": k, "name": n, "content": c} for k, n, c in r[1]] for r in rows]
        return pd.DataFrame(
            {
                "full_text": [r[0] for r in rows],
                "sections": sections,
                "has_body": [r[2] for r in rows],
                "abstract": [r[3] for r in rows],
            }
        )

    return articles.withColumn("_jats", parsed(F.col(column))).select(*articles.columns, "_jats.*")


EXTRA = "array<struct<label:string,caption:string,content:string>>"


def article_extras(articles: DataFrame, column: str = "xml") -> DataFrame:
    """``articles`` with tables, figures and references of each XML text, and the article's type and outside links."""

    @F.pandas_udf(f"struct<tables:{EXTRA},figures:{EXTRA},references:{EXTRA},article_type:string,links:array<string>>")
    def parsed(xml: pd.Series) -> pd.DataFrame:
        out = []
        for x in xml:
            try:
                root = ElementTree.fromstring(x or "")
            except ElementTree.ParseError:
                root = None
            article = None if root is None else root if root.tag == "article" else root.find(".//article")
            if article is None:
                out.append({"tables": [], "figures": [], "references": [], "article_type": None, "links": []})
                continue
            href = "{http://www.w3.org/1999/xlink}href"
            links = [u for e in article.iter("ext-link") if (u := e.get(href))]
            out.append({**extras(article), "article_type": article.get("article-type"), "links": links})
        return pd.DataFrame(out)

    return articles.withColumn("_extra", parsed(F.col(column))).select(*articles.columns, "_extra.*")


def page_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Parsed pages, a few at a time: only these are Python strings, beside the batch that Arrow holds."""
    for b in batches:
        for k in range(0, len(b), PAGES):
            yield pa.array([parse_html(x) for x in b.slice(k, PAGES).to_pylist()], pa.string())


def pages(df: DataFrame, column: str = "html", out: str = "page_text") -> DataFrame:
    """``df`` with the cleaned text of each HTML page."""

    @F.arrow_udf("string")
    def parsed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return page_texts(batches)

    return df.withColumn(out, clean_comprehensive(parsed(F.col(column))))


def assemble(text: Column, sections: Column, has_body: Column, abstract: Column, page_text: Column) -> Column:
    """Struct (full_text, sections): the body behind its abstract if it is more than boilerplate, else the page of an
    article that has an abstract, else null."""
    a = clean_abstract(abstract)
    lead = F.when(filled(a), F.concat(F.lit("ABSTRACT:\n"), a, F.lit("\n\n"))).otherwise("")
    first = F.when(
        filled(a), F.array(F.struct(F.lit(-1).alias("pos"), F.lit("Abstract").alias("name"), a.alias("content")))
    ).otherwise(F.array().cast(SECTIONS))
    good = F.coalesce(has_body & has_meaningful_content(sections, text), F.lit(False))
    numbered = F.transform(
        F.concat(first, sections),
        lambda s, i: F.struct(i.cast("int").alias("pos"), s["name"].alias("name"), s["content"].alias("content")),
    )
    body = F.struct(F.concat(lead, clean_comprehensive(text)).alias("full_text"), numbered.alias("sections"))
    page = F.struct(page_text.alias("full_text"), F.array().cast(SECTIONS).alias("sections"))
    return F.when(good, body).when(filled(a) & filled(page_text), page)


def first_text(source: DataFrame, key: Column, text: str = "text") -> DataFrame:
    """(key, text): the first hit of each key among non-empty texts, by ``rank`` where the source has one, then by text."""
    rank = F.col("rank") if "rank" in source.columns else F.lit(0)
    rows = source.filter(filled(F.col(text))).select(key.alias("key"), F.struct(rank.alias("rank"), F.col(text).alias("text")).alias("hit"))
    return rows.filter(filled(F.col("key"))).groupBy("key").agg(F.min("hit").alias("hit")).select("key", "hit.text")


def waterfall(papers: DataFrame, by_pmcid: DataFrame, by_doi: DataFrame) -> DataFrame:
    """papers (pmid, pmcid, doi) with the first text found: by PMC id, then by DOI in any case. Sources are (pmcid | doi,
    text, optional rank). Of several texts of a key the first hit counts: that of the least rank, then the least text; a
    source of empty texts has none. Papers stay one row each."""
    a = first_text(by_pmcid, F.col("pmcid")).select(F.col("key").alias("_pmcid"), F.col("text").alias("_a"))
    b = first_text(by_doi, doi_key(F.col("doi"))).select(F.col("key").alias("_doi"), F.col("text").alias("_b"))
    own_doi = F.when(filled(F.col("doi")), doi_key(F.col("doi")))
    rows = papers.join(a, filled(F.col("pmcid")) & (F.col("pmcid") == F.col("_pmcid")), "left")
    rows = rows.withColumn("_own", own_doi).join(b, F.col("_own") == F.col("_doi"), "left").drop("_own")
    text = F.coalesce(F.when(filled(F.col("_a")), F.col("_a")), F.when(filled(F.col("_b")), F.col("_b")))
    return rows.withColumn("full_text", text).withColumn(
        "origin", F.when(filled(F.col("_a")), "pmcid").when(filled(F.col("_b")), "doi")
    ).drop("_pmcid", "_a", "_doi", "_b")


