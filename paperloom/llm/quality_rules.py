"""Quality rules as weak supervision (operator 4).

Ten rules each vote good, bad or abstain on a document. Expectation-maximisation over the votes of *all* documents
estimates each rule's accuracy on good and on bad documents and the share of good ones, without labels; a document is
kept by its posterior probability of being good instead of by passing every rule. Votes have at most 3**10 = 59,049
patterns, so a count for each pattern is all that EM needs on the driver, whatever the size of the corpus. The rates have
priors of a fixed weight (``PRIOR`` documents), so what the corpus says outweighs them as it grows, and are otherwise free.
An abstention is an outcome of its own with rates of its own: what a rule leaves undecided is seldom so in good documents,
so it tells a document with one common bad vote from one that other rules doubt, too. The classes are told apart by where
the estimate starts; the class whose documents get fewer bad votes is the good one.

The rule on stop words goes by a document's ``lang`` where the table has one: in a language without a list of words, or
without a language, it may vote good by the words of any list but never bad.

Defined results: null text has no words; it fails the base rules (fewer than 50 words), as does any short text. Very long
texts are measured whole. Rows with equal or null ids and repeated rows are judged each on their own; an empty table gives
an empty result; other columns pass through ``keep_good`` untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import common

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP_FROM = 0.5
#: Outcomes of a rule, and their prior rates on a good and on a bad document, with the weight of each in documents.
OUTCOMES = "gb-"
ON_GOOD, ON_BAD = (0.948, 0.002, 0.05), (0.6, 0.3, 0.1)
PRIOR = 200, 10
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"

#: Frequent function words of the corpus languages.
STOP_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he this are or his from at which but have an had they",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son aux d",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si",
}

#: Name of each rule; votes are g (good), b (bad) and - (abstain), in this order.
RULES = ("symbols", "digits", "repeats", "lines", "capitals", "letters", "sentences", "stop_words", "exclamations", "word_length")

FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, votes string"


def _classes():
    import numpy as np

    table = np.full(256, 3, dtype=np.uint8)  # other
    table[128:] = 0  # bytes of letters beyond ASCII
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[[ord(c) for c in SPACES]] = 2
    table[ord(".")] = 4
    table[ord("?")] = 4
    table[ord("!")] = 5
    table[ord("0") : ord("9") + 1] = 6
    return table


def repeated(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more, its first place included."""
    import numpy as np

    if len(words) < 4:
        return 0
    h = np.array(list(map(hash, words)), dtype=np.int64).view(np.uint64)
    w = h[:-2] * np.uint64(0x9E3779B97F4A7C15) + (h[1:-1] ^ (h[1:-1] >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:] * np.uint64(0x165667B19E3779F9)
    s = np.sort(w)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(w, twice))
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[at + k] = True
    return int(covered.sum())


def measure(text: str | None, lang: str | None, classes, stop: dict) -> tuple:
    """The row of FEATURES of one whole text. ``stop``: stop words of each language, those of all under None."""
    import numpy as np

    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    word_chars = len(text) - sum(map(text.count, SPACES))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    n_dup = len(lines) - len(set(lines))
    n_repeat = repeated(words)
    failed = n < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n
    if not n:
        return n, word_chars, n_symbols, n_dup, n_repeat, failed, "-" * len(RULES)
    lower, upper, _, other, stops, bangs, digits = np.bincount(classes[np.frombuffer(raw, np.uint8)], minlength=7).tolist()
    letters, shown = lower + upper, lower + upper + other + stops + bangs + digits
    listed = None if lang is None else stop.get(lang)
    known = sum(map((listed or stop[None]).__contains__, raw.lower().split()))
    ends = stops + bangs

    def vote(x: float, good: float, bad: float) -> str:
        """Good up to ``good``, bad from ``bad``."""
        return "g" if x <= good else "b" if x >= bad else "-"

    mean = word_chars / n
    votes = (
        vote(n_symbols / n, 0.02, 0.1),
        vote(digits / shown, 0.1, 0.3),
        vote(n_repeat / n, 0.1, 0.3),
        vote(n_dup / len(lines), 0.05, 0.3) if len(lines) > 1 else "-",
        vote(upper / letters, 0.2, 0.5) if letters else "b",
        vote((shown - letters - digits) / shown, 0.1, 0.15),  # digits have a rule of their own
        vote(n / ends, 40, 200) if ends else "b" if n >= 100 else "-",
        "g" if known >= 0.05 * n else "b" if listed and known < 0.005 * n and n >= 100 else "-",
        vote(bangs / n, 0.02, 0.2),
        "g" if 3 <= mean <= 10 else "b" if mean < 2 or mean > 15 else "-",
    )
    return n, word_chars, n_symbols, n_dup, n_repeat, failed, "".join(votes)


def _measurer():
    stop: dict = {lang: {w.encode() for w in words.split()} for lang, words in STOP_WORDS.items()}
    stop[None] = set().union(*stop.values())
    classes = _classes()
    return lambda text, lang=None: measure(text, lang, classes, stop)


def _lang(docs: DataFrame) -> Column:
    return docs["lang"].cast("string") if "lang" in docs.columns else F.lit(None).cast("string")


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, FEATURES) of every row of ``docs``."""
    import pyarrow as pa

    numbers = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    kinds = [*((n, pa.int64()) for n in ("doc_id", *numbers)), ("base_failed", pa.bool_()), ("votes", pa.string())]
    schema = pa.schema(kinds)

    def run(batches):
        one = _measurer()
        for b in batches:
            rows = [one(t.as_py(), lang) for t, lang in zip(b.column("text"), b.column("lang").to_pylist())]
            cols = list(zip(*rows)) if rows else [[] for _ in range(7)]
            arrays = [pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *arrays], schema=schema)

    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), _lang(docs).alias("lang"))
    return own.mapInArrow(common.task(run), f"doc_id long, {FEATURES}")


def estimate(counts: dict[str, int], rounds: int = 500) -> dict:
    """EM over vote patterns: {"good": share of good documents, "rules": [(rates on good, rates on bad), ...]}, rates being
    those of OUTCOMES.

    The rates have Dirichlet priors; that of bad documents is worth a few documents only, as a rule may detect one kind of
    bad document and pass the others. The sum over patterns is one product of matrices a round.
    """
    import numpy as np

    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], dtype=float)
    votes = _outcomes(patterns)
    total = n.sum()
    start = np.array([ON_GOOD, ON_BAD])[:, :, None]
    good, rates = 0.9, np.repeat(start, len(RULES), 2)
    weight = np.array(PRIOR)[:, None, None]
    for _ in range(rounds if total else 0):
        p = _posteriors(good, rates, votes)
        shares = np.stack([n * p, n * (1 - p)])
        new = (np.einsum("cp,kpr->ckr", shares, votes) + start * weight) / (shares.sum(axis=1)[:, None, None] + weight)
        moved = np.abs(new - rates).max()
        good, rates = float((shares[0].sum() + 9) / (total + 10)), new
        if moved < 1e-9:
            break
    if rates[0, 1].sum() > rates[1, 1].sum():
        good, rates = 1 - good, rates[::-1]
    return {"good": good, "rules": [(tuple(a), tuple(b)) for a, b in zip(rates[0].T.tolist(), rates[1].T.tolist())]}


def _outcomes(patterns: list[str]):
    """Outcome x pattern x rule, 1 where a pattern's rule has the outcome."""
    import numpy as np

    votes = np.array([list(p) for p in patterns]).reshape(len(patterns), len(RULES))
    return np.stack([votes == k for k in OUTCOMES]).astype(float)


def _posteriors(good: float, rates, votes):
    """P(good | votes) of each pattern."""
    import numpy as np

    alike = np.einsum("kpr,ckr->cp", votes, np.log(rates))
    x = math.log(good / (1 - good)) + alike[0] - alike[1]
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


def posterior(model: dict, pattern: str) -> float:
    """P(good | votes)."""
    import numpy as np

    rates = np.array(model["rules"]).transpose(1, 2, 0)
    return float(_posteriors(model["good"], rates, _outcomes([pattern]))[0])


def counted(rows: DataFrame) -> dict[str, int]:
    """How many documents have each pattern of votes: at most 3**10 rows."""
    return {r["votes"]: r["n"] for r in sorted(rows.groupBy("votes").agg(F.count("*").alias("n")).collect())}


def judge(spark: SparkSession, docs: DataFrame, work: str) -> DataFrame:
    """(doc_id, FEATURES, p_good, kept) of every row of ``docs``."""
    rows = common.cut(spark, features(docs), f"{work}/features")
    counts = counted(rows)
    model = estimate(counts)
    table = spark.createDataFrame([(v, posterior(model, v)) for v in counts] or [("", 0.0)], "votes string, p_good double")
    return rows.join(F.broadcast(table), "votes").withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= KEEP_FROM))


def keep_good(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; texts are measured again, not shuffled or stored."""
    common.small_batches(spark)
    counts = counted(features(docs))
    model = estimate(counts)
    good = {v for v in counts if posterior(model, v) >= KEEP_FROM}

    def run(batches):
        import pyarrow as pa

        one = _measurer()
        for b in batches:
            langs = b.column("lang").to_pylist() if "lang" in b.schema.names else [None] * b.num_rows
            rows = [one(t.as_py(), lang) for t, lang in zip(b.column("text"), langs)]
            yield b.filter(pa.array([not r[5] and r[6] in good for r in rows], pa.bool_()))

    return docs.mapInArrow(common.task(run), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: base measures and the method's verdict for all ``documents``."""
    out = judge(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), common.work_dir(spark, "quality-rules"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "votes", "p_good")
