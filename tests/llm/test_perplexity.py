import collections
import math
import random

from paperloom.llm import perplexity as P


class Brute:
    """Interpolated modified Kneser-Ney over dictionaries."""

    def __init__(self, texts):
        n = P.ORDER
        self.count = {n: collections.Counter(t[i : i + n] for x in texts for t in [P.PAD * (n - 1) + x] for i in range(len(x)))}
        for k in range(n - 1, 0, -1):
            self.count[k] = collections.Counter(g[1:] for g in self.count[k + 1])
        self.d = {}
        for k, c in self.count.items():
            of = collections.Counter(c.values())
            n1, n2, n3, n4 = (of[i] for i in range(1, 5))
            if not n1 or not n2:
                self.d[k] = (0.5, 0.5, 0.5)
                continue
            y = n1 / (n1 + 2 * n2)
            d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2 - 3 * y * n3 / n2)
            self.d[k] = tuple(min(max(x, 0.05), i + 0.95) for i, x in enumerate(d))
        self.context = {k: collections.defaultdict(list) for k in self.count}
        for k, c in self.count.items():
            for g, m in c.items():
                self.context[k][g[:-1]].append(m)

    def p(self, g):
        if not g:
            return 1.0
        k = len(g)
        own = self.context[k].get(g[:-1])
        off = lambda m: min(self.d[k][min(m, 3) - 1], m)
        if own is None:
            return self.p(g[1:])
        m, total, left = self.count[k].get(g, 0), sum(own), sum(map(off, own))
        lower = 1 / (len(own) + 1) if k == 1 else self.p(g[1:])
        return (max(m - self.d[k][min(m, 3) - 1], 0) if m else 0) / total + left / total * lower

    def perplexity(self, x):
        t = P.PAD * (P.ORDER - 1) + x
        return math.exp(-sum(math.log(self.p(t[i : i + P.ORDER])) for i in range(len(x))) / len(x)) if x else None


def texts(seed, n):
    rng = random.Random(seed)
    return [" ".join(rng.choice(["the", "stone", "of", "river", "größe", "walks", "漢字"]) for _ in range(rng.randrange(1, 60))) for _ in range(n)]


def test_equals_brute_force(spark, work, monkeypatch):
    rows = [(i, t, "en") for i, t in enumerate(texts(3, 60))] + [(100, "zzz qqq Ω", "xx"), (101, "", "en"), (102, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = docs.filter("doc_id < 40").select("doc_id")
    monkeypatch.setattr(P, "HELD_OUT", 10**9)
    got = {r["doc_id"]: r["perplexity"] for r in P.classify(spark, docs, trusted, work).collect()}
    model = Brute([t for i, t, _ in rows if i < 40])
    for i, t, _ in rows:
        want = model.perplexity(t or "")
        assert (got[i] is None) == (want is None) and (want is None or math.isclose(got[i], want, rel_tol=1e-9)), i


def test_probabilities_sum_to_one():
    model = Brute(texts(4, 30))
    known = set(model.count[1])
    for context in ("", "t", "the ", "ston"):
        assert math.isclose(sum(model.p(context + c) for c in known) + model.p(context + "\U0001F600"), 1, rel_tol=1e-9)


def test_held_out_accuracy(spark, work):
    rng = random.Random(8)
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz#$%") for _ in range(200)) for _ in range(40)]
    rows = [(i, t + " " + t[::-1][:0] + "the river walks of stone", "en") for i, t in enumerate(texts(5, 400))] + [(1_000 + i, t, "en") for i, t in enumerate(noise)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = P.classify(spark, docs, docs.filter("doc_id < 300").select("doc_id"), work).collect()
    kept = {r["doc_id"] for r in out if r["kept"]}
    assert not any(i >= 1_000 for i in kept) and len([i for i in kept if 300 <= i < 400]) >= 95


def test_long_texts_are_scored_in_runs(spark, work, monkeypatch):
    long = "the river of stone " * 400
    docs = spark.createDataFrame([(1, long, "en"), (2, "the river", "en"), (3, long, "en")], "doc_id long, text string, lang string")
    monkeypatch.setattr(P, "HELD_OUT", 10**9)
    a = {r["doc_id"]: (r["n_chars"], round(r["perplexity"], 9)) for r in P.classify(spark, docs, docs.select("doc_id"), f"{work}/a").collect()}
    assert a[1] == a[3] and a[1][0] == len(long) and len(a) == 3


def test_rough_and_empty(spark, rough, empty, work):
    out = P.classify(spark, rough, rough.select("doc_id").filter("doc_id in (5, 6, 9)"), f"{work}/a").collect()
    assert len(out) == rough.count() and not any(r["kept"] for r in out if r["n_chars"] == 0)
    none = P.classify(spark, rough, rough.select("doc_id").limit(0), f"{work}/b").collect()
    assert len(none) == rough.count() and not any(r["kept"] for r in none)
    assert P.classify(spark, empty, empty.select("doc_id"), f"{work}/c").count() == 0


def test_other_splits_give_the_same_scores(spark, work, monkeypatch):
    """Tables of splits only save reading: with none of them, or with another split's, scores come from all shards."""
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts(6, 80))], "doc_id long, text string, lang string").repartition(4)
    docs = P.common.cut(spark, docs, f"{work}/docs")
    trusted = docs.filter("doc_id < 50").select("doc_id")
    told = lambda k: {r["doc_id"]: (r["n_chars"], round(r["perplexity"], 9), r["kept"]) for r in P.classify(spark, docs, trusted, f"{work}/{k}").collect()}
    want = told("a")
    write = P.by_split
    monkeypatch.setattr(P, "by_split", lambda s, asked, table, path: write(s, asked.withColumn("split", asked["split"] + 1), table, path))
    assert told("b") == want
    monkeypatch.setattr(P, "by_split", lambda *_: None)
    assert told("c") == want


def test_few_held_out_texts_give_no_quantile_of_their_own(spark, work):
    rows = [(i, t, "en") for i, t in enumerate(texts(7, 300))] + [(1_000 + i, "ein fluss und ein stein", "de") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = P.classify(spark, docs, docs.select("doc_id"), work).groupBy("lang").agg({"threshold": "min"}).collect()
    assert len({r[1] for r in out}) == 1 and len(out) == 2
