"""The boolean search language as a Column.

Grammar: terms joined by AND, OR and NOT of equal precedence, read from left to right; parentheses group. A term is a
word, a quoted phrase or either with a trailing *, then an optional [field]; or FIELD:value, PUB_YEAR:[a TO b]. Without
an operator between two terms AND is meant. Matching ignores case.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = re.compile(
    r'\s*(?:(\()|(\))|(PUB_YEAR:\[\s*\d{4}\s+TO\s+\d{4}\s*\])|([A-Za-z_]+:"[^"]*"|[A-Za-z_]+:[^\s()\[\]]+)'
    r'|("[^"]*"\*?|[^\s()\[\]"]+)(?:\s*\[([^\]]+)\])?)',
    re.I,
)
#: Names of fields.
FIELDS = {
    "title/abstract": "tiab", "tiab": "tiab", "title": "title", "ti": "title", "dp": "date", "pdat": "date", "mesh": "mesh", "mh": "mesh",
    "mesh terms": "mesh",
    "majr": "major", "au": "author", "author": "author", "publication type": "type", "pt": "type", "sb": "subset", "doi": "doi",
    "pmid": "pmid", "all fields": "all",
    "src": "source", "pub_year": "date", "auth": "author", "abstract": "abstract", "journal": "journal",
}


def tokens(query: str) -> list[tuple]:
    out, at = [], 0
    query = query.strip()
    while at < len(query):
        m = TOKEN.match(query, at)
        if not m:
            raise ValueError(f"can't read the query at {query[at : at + 20]!r}")
        at = m.end()
        left, right, years, pair, word, field = m.groups()
        if left or right:
            out.append(("paren", left or right))
        elif years:
            a, b = re.findall(r"\d{4}", years)
            out.append(("term", f"{a}:{b}", "date"))
        elif pair:
            name, _, value = pair.partition(":")
            if name.isdigit() or name.lower() not in FIELDS:
                out.append(("term", pair, "all"))
            else:
                out.append(("term", value.strip('"'), FIELDS[name.lower()]))
        elif not field and word.upper() in ("AND", "OR", "NOT"):
            out.append(("op", word.upper()))
        else:
            key = (field or "all fields").strip().lower()
            if key not in FIELDS:
                raise ValueError(f"no field [{field}]")
            out.append(("term", word, FIELDS[key]))
    return out


def parse(query: str):
    """An expression tree: ("term", text, field) or (operator, left, right); NOT without a left side has None there."""
    rest = tokens(query)

    def group():
        left, op = None, "AND"
        while rest:
            kind, *value = rest.pop(0)
            if kind == "op":
                op = value[0] if left is not None or value[0] == "NOT" else "AND"
                if rest and rest[0] == ("op", "NOT") and op != "NOT":
                    op += " NOT"
                    rest.pop(0)
                continue
            if kind == "paren" and value[0] == ")":
                break
            node = group() if kind == "paren" else ("term", *value)
            if node is None:
                continue
            left = node if left is None and op != "NOT" else (op, left, node)
            op = "AND"
        return left

    return group()


def _pattern(text: str) -> str:
    text = text.strip()
    wild = text.endswith("*")
    words = text.rstrip("*").strip('"').split()
    body = r"[^\p{L}\p{N}]+".join(re.escape(w).replace("\\-", "-") for w in words)
    return r"(?iu)(^|[^\p{L}\p{N}])" + body + ("" if wild else r"($|[^\p{L}\p{N}])")


def _term(text: str, field: str, columns: frozenset[str] | None) -> Column:
    plain = text.strip('"').rstrip("*").strip('"').lower()
    has = lambda c: F.coalesce(F.rlike(c, F.lit(_pattern(text))), F.lit(False))
    match field:
        case "title" | "abstract" | "journal":
            return has(F.col(field))
        case "tiab":
            return has(F.concat_ws(" ", "title", "abstract"))
        case "mesh":
            return F.exists("mesh_terms", lambda x: F.lower(x) == plain.split("/")[0])
        case "major":
            # Without a column of major topics a topic counts as one.
            own = "mesh_major" if columns is not None and "mesh_major" in columns else "mesh_terms"
            return F.coalesce(F.exists(own, lambda x: F.lower(x) == plain.split("/")[0]), F.lit(False))
        case "author":
            return F.exists("authors", lambda x: F.lower(x).startswith(plain))
        case "type":
            return has(F.col("publication_type")) if columns is None or "publication_type" in columns else F.lit(False)
        case "subset":
            return F.col("is_full_text_pmc") if plain == "full text" else F.lit(False)
        case "doi" if "|" in plain:
            return F.coalesce(F.lower("doi").isin(*(x for x in plain.split("|") if x)), F.lit(False))
        case "doi" | "pmid" | "source":
            return F.coalesce(F.lower(F.col(field)) == plain, F.lit(False))
        case "date":
            if ":" in plain:
                a, b = plain.split(":")
                # Month bounds compare as text, so 2020/03 starts a range at that month.
                stamp = F.coalesce(F.replace("date_published", F.lit("-"), F.lit("/")), F.col("year"))
                low, high = stamp >= a, F.substring(stamp, 1, len(b)) <= b
                return F.coalesce(low & high, F.lit(False))
            stamp = F.coalesce(F.replace("date_published", F.lit("-"), F.lit("/")), F.col("year"))
            return F.coalesce(stamp.startswith(plain), F.lit(False))
    return has(F.concat_ws(" ", "title", "abstract", F.array_join("mesh_terms", " "), F.array_join("authors", " ")))


def compiled(node, columns: frozenset[str] | None = None) -> Column:
    if node is None:
        return F.lit(True)
    op, a, b = node
    if op == "term":
        return _term(a, b, columns)
    left = F.lit(True) if a is None else compiled(a, columns)
    right = compiled(b, columns)
    match op:
        case "AND":
            return left & right
        case "OR":
            return left | right
        case "OR NOT":
            return left | ~right
    return left & ~right


def predicate(query: str, columns=None) -> Column:
    """The query as a boolean Column over papers (title, abstract, mesh_terms, authors, year, date_published, doi, ...).

    With ``columns``, the names that the papers have, major topics and publication types are looked up where they exist.
    """
    return compiled(parse(query), None if columns is None else frozenset(columns))


#: What a search of a preprint server adds to a query.
PREPRINTS = {"biorxiv": "(SRC:PPR)", "medrxiv": "(SRC:MED)"}


def preprint_query(query: str, server: str = "biorxiv") -> str:
    """A query restricted to the records of a preprint server."""
    return f"({query}) AND {PREPRINTS['medrxiv' if server.lower() == 'medrxiv' else 'biorxiv']}"


def doi_filter(text: str) -> list[str]:
    """The DOIs of a batch filter ``doi:a|b|c``, without resolver addresses, in lower case."""
    head, _, rest = text.partition(":")
    if head.strip().lower() != "doi":
        raise ValueError(f"not a filter by DOI: {text[:20]!r}")
    return [x.strip().lower().rpartition("doi.org/")[2] for x in rest.split("|") if x.strip()]


def any_of(queries: list[str]) -> Column:
    return reduce(lambda x, y: x | y, map(predicate, queries), F.lit(False))


def with_suffix(query: str, suffix: str) -> str:
    """A query and its suffix, a space between."""
    return f"{query} {suffix.strip()}" if suffix.strip() else query
