from paperloom.llm import preferences as P

TURNS = "conv_id long, turn long, role string, text string, pair_id string"
PAIRS = "pair_id long, chosen_id long, rejected_id long"


def brute(chosen, rejected):
    """The output of two lists of (role, text), None for a missing side."""
    sides = [None if s is None else [(r or "", t or "") for r, t in s] for s in (chosen, rejected)]
    n = 0
    if None not in sides:
        while n < min(map(len, sides)) and sides[0][n] == sides[1][n]:
            n += 1
    shown = lambda r, t: f"<|{r}|>\n{t}<|end|>\n"
    out = [n, "".join(shown(*x) for x in (sides[0] or [])[:n])]
    spans = []
    for s in sides:
        text, marks = "", []
        for r, t in (s or [])[n:]:
            text += shown(r, t)
            if r == "assistant":
                marks.append(f"{len(text) - len(t) - 8}:{len(text)}")
        out.append(None if s is None else text)
        spans.append(None if s is None else ",".join(marks))
    return (*out, *spans)


def run(spark, conversations, pairs):
    rows = [(c, k, r, t, "clash") for c, turns in conversations.items() for k, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    out = P.format_pairs(df, spark.createDataFrame(pairs, PAIRS)).collect()
    return {r["pair_id"]: tuple(r[c] for c in ("n_prompt_turns", "prompt", "chosen", "rejected", "chosen_spans", "rejected_spans")) for r in out}


def test_equals_brute_force(spark):
    u, a, b = ("user", "hi é\U0001F600"), ("assistant", "yes"), ("assistant", "no")
    conv = {
        0: [u, a], 1: [u, b], 2: [u, a, u], 3: [u, a], 4: [u, a], 5: [u, a], 6: [u], 8: [("system", None), (None, "x"), a], 9: [("system", ""), ("", "x"), b],
        10: [u] + [a, u] * 300 + [b], 11: [u] + [a, u] * 300 + [a],
    }
    pairs = [(k, 2 * k, 2 * k + 1) for k in (0, 1, 2, 3, 4, 5)]
    got = run(spark, conv, pairs)
    assert got == {k: brute(conv.get(x), conv.get(y)) for k, x, y in pairs}


def test_empty_and_rows_without_id(spark):
    empty = spark.createDataFrame([], TURNS)
    pairs = spark.createDataFrame([(0, 0, 1)], PAIRS)
    assert P.format_pairs(empty, pairs).count() == 0
    assert P.format_pairs(spark.createDataFrame([(None, 0, "user", "x", "")], TURNS), pairs).count() == 0


def test_repeated_rows_and_ties(spark):
    rows = [(0, 0, "user", "q", ""), (0, 0, "user", "q", ""), (1, 0, "user", "q", ""), (1, None, "user", "z", "")]
    out = P.format_pairs(spark.createDataFrame(rows, TURNS), spark.createDataFrame([(7, 0, 1)], PAIRS)).first()
    assert out["n_prompt_turns"] == 0 and out["chosen"].count("q<|end|>") == 2 and out["rejected"].startswith("<|user|>\nz")
