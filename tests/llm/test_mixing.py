import os
import random

import pytest

from leafwork.llm import mixing

pytestmark = pytest.mark.skipif(not os.path.isfile(mixing.TOKENIZER), reason="no tokenizer")


def run(spark, docs, targets):
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id bigint, source string, text string, tokens int")
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    mixture, sizes = mixing.mix(d, t)
    rows = mixture.collect()
    return rows, {r.source: r for r in mixing.shares(mixture, sizes, t).collect()}


def test_shares_and_caps(spark):
    rng = random.Random(1)
    docs = []
    for s, n in (("big", 400), ("mid", 150), ("small", 30), ("other", 50), (None, 20)):
        docs += [(len(docs) + k, s, " ".join(rng.choice(("alpha", "beta", "gamma")) for _ in range(rng.randint(1, 80)))) for k in range(n)]
    docs += [(9001, "big", ""), (9002, "mid", None), (9003, "small", " ")]
    targets = [("big", 0.5, 1), ("mid", 0.28, 2), ("small", 0.2, 4), ("gone", 0.02, 1)]
    rows, report = run(spark, docs, targets)
    caps = {s: c for s, _, c in targets}
    assert all(1 <= r.copies <= caps[r.source] for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)
    assert {r.source for r in rows} == {"big", "mid", "small"}
    for s, share in (("big", 0.5), ("mid", 0.28), ("small", 0.2)):
        assert abs(report[s].actual_share - share / 0.98) < 0.004, report
    assert report["gone"].actual_share == 0 and report["gone"].documents == 0
    assert report["big"].documents == 400


def test_capped_source_is_used_up(spark):
    docs = [(k, "a", "word " * 10) for k in range(50)] + [(100 + k, "b", "word " * 10) for k in range(5)]
    rows, report = run(spark, docs, [("a", 0.5, 1), ("b", 0.5, 3)])
    assert {r.copies for r in rows if r.source == "b"} == {3}
    assert abs(report["a"].mixture_tokens - report["b"].mixture_tokens) <= 11


def test_nothing(spark):
    assert run(spark, [], [("a", 1.0, 1)])[0] == []
    assert run(spark, [(1, "a", "x")], [])[0] == []
    rows, report = run(spark, [(1, "a", "x y z")], [("a", None, 1), ("b", 1.0, None)])
    assert rows == [] and set(report) == {"b"}


def test_tokens_are_the_tokenizers(spark):
    import base64

    import tiktoken

    with open(mixing.TOKENIZER, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=mixing.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", None, "Hello, wörld!\n\n  x", "中文" * 50, "a" * 5000, "<|endoftext|>"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    got = {r.k: r.tokens for r in mixing.count_tokens(df, ["k"]).collect()}
    assert got == {k: len(enc.encode_ordinary(t)) if t else 0 for k, t in enumerate(texts)}


def test_balance_meets_its_goal(spark):
    rng = random.Random(4)
    sizes = [("a", t, rng.randint(1, 9)) for t in range(1, 60)] + [("b", t, 2) for t in range(5, 500, 7)]
    total = {s: sum(t * n for x, t, n in sizes if x == s) for s in "ab"}
    count = {s: sum(n for x, _, n in sizes if x == s) for s in "ab"}
    mean, cap = {s: total[s] / count[s] for s in "ab"}, {"a": 3, "b": 2}
    goal = {"a": 2.7 * total["a"], "b": 0.03 * total["b"]}
    df = spark.createDataFrame(sizes, "source string, tokens bigint, n bigint")
    import math

    lam = mixing.balance(df, goal, mean, cap)
    for s in "ab":
        got = sum(n * t * min(cap[s], math.exp(lam[s] * t / mean[s])) for x, t, n in sizes if x == s)
        assert abs(got - goal[s]) < 1e-6 * goal[s]
