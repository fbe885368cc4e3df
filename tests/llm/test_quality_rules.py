import collections
import random
import re

from paperloom.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = list(zip(w, w[1:], w[2:]))
    n = collections.Counter(windows)
    covered = {k + j for k, x in enumerate(windows) if n[x] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)


def test_measures_equal_brute_force():
    rng = random.Random(1)
    one = Q._measurer()
    parts = ["a", "b", "c", "É", "x|", "\n", "\n", "\t", "\x0b", "\x0c", "\r", " ", "漢", "***"]
    for _ in range(3_000):
        text = " ".join(rng.choice(parts) for _ in range(rng.randrange(80)))
        assert one(text)[:6] == brute(text), text


def test_rough_rows(spark, rough, work):
    rows = Q.judge(spark, rough, work).collect()
    want = collections.Counter((r["doc_id"], *brute(r["text"])) for r in rough.collect())
    assert collections.Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in rows) == want
    assert not any(r["kept"] and r["base_failed"] for r in rows)


def test_empty_table(spark, empty, work):
    assert Q.judge(spark, empty, work).count() == 0 and Q.keep_good(spark, empty).count() == 0


def test_clean_stays_and_junk_goes(spark):
    rng = random.Random(2)
    plain = ["the", "of", "and", "river", "stones", "meadow", "walking", "is", "that", "harbour"] + [f"w{a}{b}" for a in "abcdefgh" for b in "ijklmnop"]
    text = lambda mark="": ". ".join(" ".join(rng.choice(plain) + mark for _ in range(9)) for _ in range(20)) + "."
    rows = [(i, text(), i) for i in range(300)] + [(1_000 + i, text("$$$"), i) for i in range(20)] + [(2_000 + i, text().upper().replace(" ", "!! "), i) for i in range(20)]
    kept = {r[0] for r in Q.keep_good(spark, spark.createDataFrame(rows, "doc_id long, text string, extra int")).collect()}
    assert kept == set(range(300))


def test_posterior_is_a_probability_and_em_ends():
    m = Q.estimate({"gggggggggg": 900, "bbgggbgbgg": 60, "----------": 5})
    assert Q.posterior(m, "gggggggggg") > 0.9 > 0.1 > Q.posterior(m, "bbgggbgbgg") and 0 < m["good"] < 1
    assert Q.estimate({})["good"] == 0.9


def plain_em(docs, rounds=500):
    """EM over one document at a time, in plain Python."""
    good, rates = 0.9, [(dict(zip(Q.OUTCOMES, Q.ON_GOOD)), dict(zip(Q.OUTCOMES, Q.ON_BAD)))] * len(Q.RULES)

    def chance(votes):
        odds = good / (1 - good)
        for v, (a, b) in zip(votes, rates):
            odds *= a[v] / b[v]
        return odds / (1 + odds)

    for _ in range(rounds):
        p = [chance(d) for d in docs]
        new = []
        for j in range(len(Q.RULES)):
            a = {k: (sum(x for x, d in zip(p, docs) if d[j] == k) + f * Q.PRIOR[0]) / (sum(p) + Q.PRIOR[0]) for k, f in zip(Q.OUTCOMES, Q.ON_GOOD)}
            b = {k: (sum(1 - x for x, d in zip(p, docs) if d[j] == k) + f * Q.PRIOR[1]) / (len(docs) - sum(p) + Q.PRIOR[1]) for k, f in zip(Q.OUTCOMES, Q.ON_BAD)}
            new.append((a, b))
        moved = max(abs(x[k] - y[k]) for m, n in zip(new, rates) for x, y in zip(m, n) for k in x)
        good, rates = (sum(p) + 9) / (len(docs) + 10), new
        if moved < 1e-9:
            break
    return good, rates, {d: chance(d) for d in docs}


def test_em_equals_plain_em():
    rng = random.Random(4)
    docs = ["".join(rng.choices("gb-", (96, 1, 3) if rng.random() < 0.85 else (50, 40, 10))[0] for _ in Q.RULES) for _ in range(600)]
    good, rates, chances = plain_em(docs)
    m = Q.estimate(collections.Counter(docs))
    assert abs(m["good"] - good) < 1e-7
    assert all(abs(x - want[k]) < 1e-7 for rule, plain in zip(m["rules"], rates) for own, want in zip(rule, plain) for k, x in zip(Q.OUTCOMES, own))
    assert all(abs(Q.posterior(m, d) - p) < 1e-7 for d, p in chances.items())


def test_a_common_bad_vote_alone_is_no_verdict():
    """A rule that often votes bad on documents that all others find good raises false alarms: its rate is free."""
    odd = "bbgggbg-gg"
    m = Q.estimate({"g" * 10: 8_000, "ggbggggggg": 900, "gggbgggggg": 300, odd: 500, "bgggg-g-gg": 200})
    assert m["rules"][2][0][1] > 0.05 and m["rules"][3][0][1] > 0.02
    assert Q.posterior(m, "ggbggggggg") > 0.9 and Q.posterior(m, "gggbgggggg") > 0.9 and Q.posterior(m, odd) < 0.1


def test_labelled_documents_get_their_verdict():
    import pyarrow.parquet as pq

    sf, one = "/root/testdata/sf0.01", Q._measurer()
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    rows = [(r["doc_id"], one(r["text"], r["lang"])) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
    m = Q.estimate(collections.Counter(r[6] for _, r in rows))
    verdicts = collections.Counter((labels[i], Q.posterior(m, r[6]) >= Q.KEEP_FROM) for i, r in rows if i in labels and not r[5])
    assert verdicts[1, False] == 0 and verdicts[0, True] <= 0.05 * (verdicts[0, True] + verdicts[0, False])
    alone = [Q.posterior(m, r[6]) >= Q.KEEP_FROM for _, r in rows if r[6].count("b") == 1 and "b" in (r[6][2], r[6][3]) and not r[5]]
    assert sum(alone) >= 0.9 * len(alone)


def test_verdicts_by_plain_em(spark, work):
    """kept of the query's plan is base rules and the plain posterior of the votes of all documents."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = Q.judge(spark, docs, work).collect()
    one = Q._measurer()
    own = {r["doc_id"]: one(r["text"], r["lang"]) for r in docs.collect()}
    _, _, chances = plain_em([own[i][6] for i in sorted(own)])
    assert len(rows) == len(own)
    for r in rows:
        m = own[r["doc_id"]]
        assert r["votes"] == m[6] and abs(r["p_good"] - chances[m[6]]) < 1e-6 and r["kept"] == (not m[5] and chances[m[6]] >= Q.KEEP_FROM)


def test_a_language_without_a_list_is_no_bad_sign():
    rng = random.Random(5)
    one = Q._measurer()
    text = ". ".join(" ".join(rng.choice(["mono", "vesi", "talo", "kuin", "meri"]) + str(rng.randrange(9)) for _ in range(9)) for _ in range(20)) + "."
    at = Q.RULES.index("stop_words")
    assert one(text, "en")[6][at] == "b" and one(text, "fi")[6][at] == "-" and one(text)[6][at] == "-" and one("of the " + text, "fi")[6][at] == "-"
