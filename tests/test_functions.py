import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.functions import merge, sections, text, validity
from paperloom.functions.falsy import truthy, wstrip

SECTION = "struct<pos:int,name:string,content:string>"


def one(spark, f, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


def secs(pairs):
    return [(k, n, c) for k, (n, c) in enumerate(pairs)]


@pytest.mark.parametrize(
    ("f", "given", "want"),
    [
        (text.clean_abstract, "  a \n b ", "a b"), (text.clean_abstract, "", ""), (text.clean_abstract, None, None), (wstrip, "\x1c　x\x85", "x"),
        (text.clean_full_text, "x\n\n-\n*\nab\na", "ab"), (text.clean_full_text, "cost \\mu \\multirow $5", "cost μ μltirow 5"), (text.clean_full_text, "\\foo{bar} \\baz qux", "bar  qux"),
        (text.clean_full_text, "a\\documentclass[1]{m}\n\\begin{document}$$\\alpha$$\\end{document} bc", "aα bc"), (text.clean_full_text, "ab\rcd\nef gh", "ab\rcd\nef gh"),
        (text.strip_references, "body\nReferences\n[1]\nAppendix", "body"), (text.strip_references, "References\n[1]", "References\n[1]"), (text.strip_references, "\nReferences\n## References\nx", "\nReferences"),
        (text.doi_key, "https://doi.org/10.1/AbC", "10.1/abc"), (text.doi_key, "10.1/AbC", "10.1/abc"), (text.doi_unversioned, "10.1101/2020.01.01v2", "10.1101/2020.01.01"),
        (text.pmcid_digits, "PMC12", "12"), (text.month_number, "Mar", "03"), (text.month_number, "April", "April"), (text.authors_of, "A, B; ;C", ["A, B", "C"]),
    ],
)
def test_text(spark, f, given, want):
    assert one(spark, f, given) == want


def test_hash_and_ellipsis(spark):
    assert one(spark, text.query_hash, " a  b ") == one(spark, text.query_hash, "a b")
    assert one(spark, lambda c: text.ellipsis(c, 200), "x" * 201) == "x" * 200 + "..." and one(spark, lambda c: text.ellipsis(c, 200), "x" * 200) == "x" * 200
    assert one(spark, lambda c: text.seconds_between(c, F.lit("2024-01-01T00:01:00.5")), "2024-01-01T00:00:00") == 60.5


@pytest.mark.parametrize(("kind", "bad", "good"), [("string", "", " "), ("bigint", 0, 1), ("boolean", False, True), ("array<string>", [], ["a"]), ("double", 0.0, 0.1)])
def test_truthy(spark, kind, bad, good):
    t = T.StructType.fromDDL(f"x {kind}")["x"].dataType
    assert [one(spark, lambda c: truthy(c, t), v, kind) for v in (None, bad, good)] == [False, False, True]


CASES = [
    ([("Abstract", "a"), ("Introduction", "Lorem ipsum " * 100), ("Methods", "We did " * 80), ("Acknowledgments", "x")], "s", True),
    ([("Abstract", "a"), ("Conflict of Interest", "No"), ("Acknowledgments", "x"), ("Funding", "y")], "s", False), ([("Abstract", "a"), ("Conflict of Interest", "No conflicts")], "s", False),
    ([("Abstract", "a"), ("Section 1", "Lorem ipsum " * 100), ("Section 2", "Dolor sit " * 100), ("Section 3", "Consectetur " * 100)], "s", True),
    ([("Abstract", "a"), ("Note", "n"), ("Comment", "c"), ("Acknowledgments", "x")], "s", False), ([], "Lorem ipsum dolor sit amet " * 200, True), ([], "Short text", False),
    ([("A", "x" * 501), ("B", "y" * 501)], "z" * 3001, True), ([("A", "x" * 501), ("B", "y" * 501)], "z" * 3000, False), ([("Database notes", "d"), ("B", "y" * 501)], "s", True),
]


@pytest.mark.parametrize(("pairs", "full", "want"), CASES)
def test_validity(spark, pairs, full, want):
    df = spark.createDataFrame([(secs(pairs), full)], f"s array<{SECTION}>, t string")
    assert df.select(validity.has_meaningful_content(F.col("s"), F.col("t"))).first()[0] is want


def test_sections(spark):
    run = lambda f, pairs: one(spark, f, secs(pairs), f"array<{SECTION}>")
    flat = run(sections.to_flat, [("Zeta", "z"), ("Methods", "m"), ("main", "x"), ("Abstract", "a")])
    assert flat == "## Abstract\n\na\n\n## Methods\n\nm\n\n## Zeta\n\nz\n\nx"
    parsed = one(spark, sections.from_flat, "pre\n## A\nx\n## B\n## A\ny")
    assert [(s["name"], s["content"]) for s in parsed] == [("Main", "pre"), ("A", "y")]
    found = run(lambda c: sections.lookup(c, F.lit("Methods")), [("Materials and Methods", "1"), ("methods", "2")])
    assert found == "2" and run(lambda c: sections.lookup(c, F.lit("nope")), [("a", "1")]) is None
    assert run(lambda c: sections.find_by_keywords(c, ["RESULT"]), [("a", "1"), ("My results", "2")])["content"] == "2"
    merged = run(lambda c: sections.merge(c, F.array(F.struct(F.lit(0).alias("pos"), F.lit("a").alias("name"), F.lit("2").alias("content")), F.struct(F.lit(1).alias("pos"), F.lit("b").alias("name"), F.lit("3").alias("content")))), [("a", "1")])
    assert [(s["pos"], s["name"], s["content"]) for s in merged] == [(0, "a", "1\n\n2"), (1, "b", "3")]
    cleaned = run(sections.clean_sections, [("References", "ab\nReferences\nxx"), ("Blank", " "), ("Text", "ok\nReferences\nyy")])
    assert [(s["name"], s["content"]) for s in cleaned] == [("References", "ab"), ("Text", "ok\nReferences\nyy")]
    assert run(lambda c: sections.full_text(c, F.lit("flat")), [("Main", "a"), ("B", "b")]) == "a\n## B\n\nb"
    assert run(lambda c: sections.full_text(c, F.lit("flat")), []) == "flat" and run(lambda c: sections.full_text(c, F.lit("f"), "other"), []) is None


def test_merge(spark):
    num = lambda a, b: spark.createDataFrame([(a, b)], "a bigint, b bigint").select(merge.scalar(F.col("a"), F.col("b"), T.LongType())).first()[0]
    assert (num(0, None), num(0, 5), num(3, 9), num(None, 0)) == (None, 5, 3, None)
    long = lambda a, b: spark.createDataFrame([(a, b)], "a string, b string").select(merge.scalar(F.col("a"), F.col("b"), T.StringType(), True)).first()[0]
    assert (long("abc", "xyz"), long("ab", "xyz"), long("", "x"), long("x", None)) == ("abc", "xyz", "x", "x")
    both = spark.createDataFrame([(["a", "a"], ["b", "b", "a"])], "a array<string>, b array<string>")
    assert both.select(merge.lists(F.col("a"), F.col("b"))).first()[0] == ["a", "a", "b", "b"]


def test_ten_thousand_headings_take_no_longer_than_their_text(spark):
    """Each heading costs what its section costs: twice the headings, about twice the time."""
    import time

    text = "".join(f"## H{k}\n{'word ' * 20}\n" for k in range(10_000)) + "## H7\nagain"
    df = spark.createDataFrame([("## A\nx",), (text,)], "t string").repartition(1)
    df.select(sections.from_flat(F.col("t"))).collect()
    start = time.perf_counter()
    got = df.select(sections.from_flat(F.col("t")).alias("s")).collect()[-1]["s"]
    assert time.perf_counter() - start < 5
    got = got if len(got) > 1 else df.select(sections.from_flat(F.col("t")).alias("s")).collect()[0]["s"]
    assert len(got) == 10_000 and [x["pos"] for x in got] == list(range(10_000))
    assert got[7]["name"] == "H7" and got[7]["content"] == "again" and got[8]["content"] == ("word " * 20).strip()


def test_white_space_of_abstracts_by_the_rule(spark):
    from paperloom.functions.falsy import WS, wstrip

    some = ["", " ", "\t", "a  b", " a  b 　", " x\ty\x1c z\x85", "a b c", "\n a \n", None, "\x1f\x20\x20q\x20\x0b", "é  é"]
    df = spark.createDataFrame([(x,) for x in some], "t string")
    rows = df.select(text.clean_abstract(F.col("t")).alias("a"), wstrip(F.regexp_replace("t", f"{WS}+", " ")).alias("b")).collect()
    assert [r["a"] for r in rows] == [r["b"] for r in rows]


def test_records_are_made_and_parsed_once(spark):
    """What makes the records may be most of the work: articles, books and the rest come from one pass over them."""
    from paperloom.operators import pubmed

    book = "<PubmedBookArticle><BookDocument><PMID>7</PMID></BookDocument></PubmedBookArticle>"
    some = ["<PubmedArticle><MedlineCitation><PMID>1</PMID></MedlineCitation></PubmedArticle>", book, "<PubmedArticle>", " 　\t", None, "else", book[:-9], "<PubmedArticle></PubmedArticle>"]
    told = pubmed.checked(spark.createDataFrame([(x,) for x in some], "xml string").coalesce(1))
    assert "Union" not in told._jdf.queryExecution().optimizedPlan().toString()
    rows = {r["record"] if r["reason"] else r["pmid"]: r for r in told.collect()}
    assert {k: r["reason"] for k, r in rows.items()} == {"1": None, "7": None, some[2]: "malformed", some[3]: "empty", None: "empty", "else": "no record", some[6]: "malformed", some[7]: "no id"}
    assert rows["1"]["mesh_terms"] == [] and rows["7"]["mesh_terms"] is None and rows["7"]["authors"] == [] and rows["else"]["authors"] is None
    assert rows["1"]["is_full_text_pmc"] is False and rows["7"]["is_full_text_pmc"] is None
