import random

from pyspark.sql import functions as F

from paperloom.llm import substring_dedup as D


def spans(spark, rows, work):
    """By the options that spare short lines and short runs."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return D.repeats(spark, df, work, lines=False, least=3, run_words=24).collect()


def words(rng, n):
    return [rng.choice("abcdefghijkl") + str(rng.randrange(10_000)) for _ in range(n)]


def test_units_cover_the_words_in_order():
    rng = random.Random(1)
    cut = D.Units()
    for _ in range(200):
        text = "".join(rng.choice([" ", "\n", "\t", "é", "ab", "c ", "漢 ", "word "]) for _ in range(rng.randrange(200)))
        found = cut(text)
        if found is None:
            assert not text.split()
            continue
        start, end, size, whole, *_ = found
        assert sum(size) == len(text.encode().split()) and list(start) == sorted(start)
        for a, b, n in zip(start, end, size):
            assert len(text[a:b].encode().split()) == n and "\n" not in text[a:b]


def test_repeated_lines_go_and_the_first_stays(spark, work):
    line, short = " ".join(f"word{i}" for i in range(15)), "a short line that many share"
    two = f"{line}\n{line[::-1]}"
    n = len(line)
    rows = [(3, f"own\n{two}\nmore of it"), (1, f"start here\n{two.upper()}\n{short}"), (2, f"{two}\n{two}"), (4, f"{short}\nrest"), (5, f"{line}\n{short}")]
    got = sorted((r["doc_id"], r["start"], r["end"], r["kept_doc_id"]) for r in spans(spark, rows, work))
    assert got == [(2, k * (n + 1), k * (n + 1) + n, 1) for k in range(4)] + [(3, 4, 4 + n, 1), (3, 5 + n, 5 + 2 * n, 1)]


def test_passages_within_other_text(spark, work):
    """A passage of over 50 words is found wherever it stands; text that doesn't repeat is left alone."""
    rng = random.Random(7)
    passage = words(rng, 60)
    rows = [(i, " ".join(words(rng, 80 + i) + (passage if i % 3 == 0 else []) + words(rng, 50))) for i in range(90)]
    got = spans(spark, rows, work)
    assert {r["doc_id"] for r in got} == {i for i in range(3, 90, 3)}
    text = dict(rows)
    for r in got:
        assert set(text[r["doc_id"]][r["start"] : r["end"]].split()) <= set(passage) and r["kept_doc_id"] < r["doc_id"] and r["kept_doc_id"] % 3 == 0


def test_whole_lines_go_at_every_length(spark, work, tmp_path):
    """As the query runs: lines from LEAST words, lines cut into parts, copies of short documents, repeats in one document."""
    rng = random.Random(8)
    line = {n: " ".join(words(rng, n)) for n in (2, 3, 5, 8, 16, 17, 20, 23)}
    own = lambda: " ".join(words(rng, 9))
    rows = [(1, "\n".join(x for n in line for x in (own(), line[n]))), (4, "two words"), (5, "two words"), (6, "a whole short document"), (7, "A  whole short document"), (8, "see here now\nsee here now\nlast")]
    rows += [(20 + n, f"{own()}\n{line[n]}\n{own()}") for n in line] + [(50, f"{own()} {line[8]} {own()}")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    text, gone = dict(rows), {}
    for r in D.query(spark, str(tmp_path)).orderBy("doc_id", "start").collect():
        gone.setdefault(r["doc_id"], []).append(text[r["doc_id"]][r["start"] : r["end"]])
    assert {k: " ".join(v) for k, v in gone.items()} == {**{20 + n: line[n] for n in line}, 5: "two words", 7: "A  whole short document", 8: "see here now"}
    out = D.removed(spark, spark.createDataFrame(rows, "doc_id long, text string"), work, lines=True)
    assert {r["doc_id"]: r["text"] for r in out.collect()}[8] == "see here now\n\nlast"


def test_passages_of_short_lines(spark, work):
    """Lists, verse and lines of 1 or 2 words between others belong to a passage; short lines that many share don't go."""
    rng = random.Random(5)
    rows = []
    for k, shape in enumerate([[1], [2], [1, 2], [10, 2, 2], [20, 1, 1], [17, 1, 1, 2]]):
        lines = [" ".join(words(rng, shape[i % len(shape)])) for i in range(200) if sum(shape[j % len(shape)] for j in range(i)) < 110]
        rows += [(10 * k + d, "\n".join([" ".join(words(rng, 7)), *lines, " ".join(words(rng, 7))])) for d in (0, 1)]
    answers = ["yes", "no", "not known", "often", "never", "at times"]
    rows += [(100 + d, "\n".join(w for q in range(20) for w in (" ".join(words(rng, 8)), rng.choice(answers)))) for d in range(20)]
    gone = {}
    for r in spans(spark, rows, work):
        gone[r["doc_id"]] = gone.get(r["doc_id"], 0) + r["words"]
    assert set(gone) == {10 * k + 1 for k in range(6)}
    assert all(n >= 90 for n in gone.values()), gone


def test_rows_without_id_are_apart(spark, work):
    """Short repeats of several rows without id don't add up to a run."""
    rng = random.Random(6)
    some = [" ".join(words(rng, 10)) for _ in range(3)]
    rows = [(None, f"{' '.join(words(rng, 5))}\n{line}") for line in some for _ in range(2)] + [(1, "\n".join(some))]
    assert {r["doc_id"] for r in spans(spark, rows, work)} == {1}


def test_removed_keeps_the_rest(spark, rough, work):
    out = D.removed(spark, rough, work, lines=False, least=3, run_words=24)
    rows = {r["doc_id"]: r for r in out.filter("doc_id is not null").collect()}
    assert out.count() == rough.count() and rows[12]["removed_spans"] == [] and rows[12]["text"].startswith("line one is here now\nline one")
    assert rows[1]["text"] is None and rows[5]["removed_spans"] == [] and rows[4]["text"] == "one" and rows[4]["line"] == "clash"
    assert rows[8]["text"].strip().endswith("end") and len(rows[8]["text"].split()) < 60 and len(rows[7]["text"].split()) < 60 and len(rows[6]["text"].split()) == 400


def test_empty_table(spark, empty, work):
    assert D.repeats(spark, empty, work).count() == 0 and F is not None


def test_rows_of_equal_or_null_ids_keep_their_own_text(spark, work):
    rng = random.Random(9)
    unique, again = " ".join(words(rng, 60)), " ".join(words(rng, 60))
    rows = [(None, unique), (None, again), (None, f"own start\n{again}"), (7, " ".join(words(rng, 40))), (7, " ".join(words(rng, 41))), (8, again)]
    rows += [(9, "a row that is there twice"), (9, "a row that is there twice")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("removed_spans", F.lit("clash")).repartition(3)
    out = [(r["doc_id"], r["text"]) for r in D.removed(spark, df, work).collect()]
    assert len(out) == len(rows)
    for row in (rows[0], rows[3], rows[4], rows[6]):
        assert out.count(row) == 1
    assert sum(again in t for _, t in out) == 1 and not any(again in t for i, t in out if i == 8)
    assert out.count((9, "")) == 1 and [t.strip() for i, t in out if i == 8] == [""]


def brute_lines(rows, least):
    """{place in rows: lines left} by a set of the lines that came before; ranks by id alone, so ids are unique."""
    seen, left = set(), {}
    for i, t in sorted(rows):
        left[i] = []
        for line in t.split("\n"):
            key = " ".join(line.lower().split())
            if len(key.split()) < least or key not in seen:
                left[i].append(line)
            seen.add(key)
    return left


def test_every_line_goes_by_brute_force(spark, work):
    """Lines of up to PART words; ``least=1`` is the exact setting that lets no repeat stay."""
    rng = random.Random(10)
    pool = [" ".join(words(rng, rng.randrange(1, 17))) for _ in range(60)]
    rows = [(i, "\n".join(x.upper() if rng.random() < 0.2 else x for x in rng.choices(pool, k=rng.randrange(1, 9)))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for least in (1, 3):
        out = {r["doc_id"]: r["text"] for r in D.removed(spark, df, f"{work}/{least}", least=least, run_words=10**9).collect()}
        want = brute_lines(rows, least)
        for i, lines in want.items():
            assert [x for x in out[i].split("\n") if x] == lines, (least, i)


def test_a_line_that_many_share(spark, work):
    line = "one line of eleven words that stands in twenty documents here"
    rng = random.Random(3)
    rows = [(i, f"{' '.join(words(rng, 9))}\n{line}") for i in range(20)]
    got = D.repeats(spark, spark.createDataFrame(rows, "doc_id long, text string"), work).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(1, 20)) and {r["kept_doc_id"] for r in got} == {0}


def test_every_part_goes_with_runs_of_one_word(spark, work):
    """The exact setting for parts: whatever unit repeats by its digest goes, at any length."""
    rng = random.Random(12)
    shared = words(rng, 30)
    rows = [(i, " ".join(words(rng, 30) + shared + words(rng, 30))) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r["doc_id"], r["d1"], r["d2"], r["unit"]) for r in D.units(df, F.monotonically_increasing_id()).collect()]
    seen, want = set(), []
    for i, a, b, u in sorted(found, key=lambda x: (x[0], x[3])):
        if (a, b) in seen:
            want.append((i, u))
        seen.add((a, b))
    got = D.repeats(spark, df, work, run_words=1, least=1)
    assert want and {(i, u) for i, u in want} <= {(r["doc_id"], r["unit"]) for r in got.collect()}


def test_the_query_removes_every_repeated_unit(spark, work, tmp_path):
    """By its defaults: a two-word line, a passage of 20 words within lines, and whatever else repeats by its digest."""
    rng = random.Random(13)
    passage, short = " ".join(words(rng, 20)), " ".join(words(rng, 2))
    rows = [(i, f"{' '.join(words(rng, 30))} {passage} {' '.join(words(rng, 30))}\n{short}\n{' '.join(words(rng, 9))}") for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    cut, seen, want = D.Units(), set(), []
    for i, t in rows:
        start, end, _, _, a, b, *_ = cut(t)
        for s, e, *d in zip(start.tolist(), end.tolist(), a.tolist(), b.tolist()):
            if tuple(d) in seen:
                want.append((i, s, e))
            seen.add(tuple(d))
    got = D.query(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["start"], r["end"]) for r in got) == sorted(want)
    text = dict(rows)
    for i in range(1, 20):
        gone = " ".join(text[r["doc_id"]][r["start"] : r["end"]] for r in sorted(got, key=lambda r: r["start"]) if r["doc_id"] == i).split()
        assert set(short.split()) <= set(gone) and set(gone) <= {*short.split(), *passage.split()} and len(set(gone) & set(passage.split())) >= 5


def test_short_parts_of_lines_go_with_their_neighbours_only(spark, work):
    rng = random.Random(14)
    rows = [(i, " ".join(["the", *words(rng, 40)])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert D.repeats(spark, df, work).count() == 0
