import random

import pytest

from leafwork.llm.furniture import looks_like_furniture
from leafwork.llm import boosting, scan_repair as S

WORDS = "the of and pump mill kiln tram canal ledger survey depot quarry bridge archive laboratory harbour inventory temperature maintenance consumption required reported handled narrow careful modest shallow weekly between during while reached climbed closed committee different greenhouse section percent".split()


def sentence(rng):
    w = [rng.choice(WORDS) for _ in range(rng.randint(8, 16))]
    if rng.random() < 0.3:
        w.insert(3, rng.choice(("long-term", "so-called", "well-known")))
    return " ".join(w).capitalize() + "."


def wrap(text, width=48):
    out, row = [], ""
    for w in text.split():
        if row and len(row) + len(w) >= width:
            out.append(row)
            row = w
        else:
            row = f"{row} {w}".strip()
    return [*out, row]


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(8)
    clean, noisy = [], []
    for _ in range(260):
        clean.append("\n".join(wrap(" ".join(sentence(rng) for _ in range(4)))))
    clean += ["A b of the pump.\n\n- long-term cost\n- so-called mill\n- 35 tickets", "Cost | 2011 | 2012\nKonil Bay | 3 | 4\nNepa | 5 | 6", "See model R2O-91.", "On page 51, a well-known mill is closed.", "the long-\nterm survey of the mill", "x9k2/3a0vb1czcym5sjym5q+1mtbe7 pump"]
    for k in range(60):
        text = " ".join(sentence(rng) for _ in range(4))
        lines = wrap(text)
        if k % 3 == 0:
            lines[1:1] = [rng.choice(("- 13 -", "Seite 365", "147 | Suburban Filter", "Chapter 13   Foreign Bakery   293", "xxii"))]
        elif k % 3 == 1:
            at = next((i for i in range(len(lines) - 1) if len(lines[i + 1].split()[0]) >= 6 and "-" not in lines[i + 1].split()[0] and lines[i + 1].split()[0].isalpha()), None)
            if at is None:
                continue
            first, *rest = lines[at + 1].split(" ")
            lines[at] += " " + first[:3] + rng.choice("-‐¬\xad")
            lines[at + 1] = " ".join([first[3:], *rest])
        else:
            for was, now in (("temperature", "temperafure"), ("maintenance", "rnaintenance"), ("pump", "piimp"), ("closed", "cl0sed"), ("while", "vvhile")):
                if was in text:
                    lines = wrap(text.replace(was, now, 1))
                    break
            else:
                continue
        noisy.append("\n".join(lines))
    return clean, noisy, rng


def frame(spark, pages):
    clean, noisy, _ = pages
    data = [("t", "c", k, x) for k, x in enumerate(clean)] + [("t", "n", k, x) for k, x in enumerate(noisy)] + [("t", "e", 1, None), ("t", "e", 2, ""), ("t", "e", 3, " \n "), ("t", "n", 0, noisy[0])]
    return spark.createDataFrame(data, "table_name string, doc_id string, item_id bigint, text string")


def test_found(spark, pages):
    clean, noisy, _ = pages
    got = {(r.doc_id, r.item_id) for r in S.find_scan_noise(frame(spark, pages), ["table_name", "doc_id", "item_id"]).collect()}
    wrong = [clean[k] for d, k in got if d == "c"]
    missed = [noisy[k] for k in range(len(noisy)) if ("n", k) not in got]
    assert len(wrong) <= 1, wrong
    assert len(missed) <= 2, missed
    assert not [x for x in got if x[0] == "e"]


def test_repaired(spark, pages):
    _, noisy, _ = pages
    got = {r.item_id: r.repaired for r in S.repair(frame(spark, pages), ["table_name", "doc_id", "item_id"]).where("doc_id = 'n'").collect()}
    good = sum(all(w.strip(".").lower() in {*WORDS, "long-term", "so-called", "well-known"} for w in t.split()) for t in got.values())
    assert good >= 0.9 * len(noisy), [t for t in got.values()][:3]


def test_empty(spark):
    df = spark.createDataFrame([], "table_name string, doc_id string, item_id bigint, text string")
    assert S.find_scan_noise(df, ["table_name", "doc_id", "item_id"]).count() == 0
    assert S.repair(df, ["table_name", "doc_id", "item_id"]).count() == 0


def test_reflow_keeps_lists_and_tables():
    text = "A line that goes\n- 3 -\non here.\n\n- x y\n- z\nA | 1\nB | 2"
    assert S.reflow(text, {1}, set(), {}) == "A line that goes on here.\n- x y\n- z\nA | 1\nB | 2"
    assert S.reflow("the har-\nbour was long-\nterm m a r k e t tbe", set(), {0}, {"tbe": "the"}) == "the harbour was long-term market the"
    assert S.reflow("", set(), set(), {}) == ""


def test_costs():
    assert S.confusion_cost("rnaintenance", "maintenance")[0] == pytest.approx(0.3)
    assert S.confusion_cost("clelayed", "delayed")[0] == pytest.approx(0.3)
    assert S.confusion_cost("pump", "pump")[0] == 0 and S.confusion_cost("pumps", "pump")[0] == 1
    assert S.confusion_cost("abc", "xyzw")[0] > 2


def test_boosting_learns_and_travels():
    import pickle

    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(1200, 4))
    y = ((x[:, 0] > 0.2) ^ (x[:, 2] > 0)).astype(int)
    model = pickle.loads(pickle.dumps(boosting.fit(x[:800], y[:800])))
    assert ((boosting.predict(model, x[800:]) > 0.5) == y[800:]).mean() > 0.93
    assert len(boosting.predict(model, np.zeros((0, 4)))) == 0


def test_held_out_words():
    rng = random.Random(5)
    vocabulary = sorted({"".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 5))) + rng.choice(("", "n", "t", "r")) for _ in range(900)})
    sample = [(w, rng.randint(20, 900)) for w in vocabulary]
    model = S.train_ranker(sample[:500])
    x, y = [], []
    for w, n in sample[500:]:
        seen = S.corrupt(w, rng)
        if seen and seen != w:
            x.append(S.rank_features(seen, w, 1, n))
            y.append(1)
            x.append(S.rank_features(seen, rng.choice(sample[500:])[0], 1, n))
            y.append(0)
    assert ((boosting.predict(model, x) > 0.5) == y).mean() > 0.95


def test_headers_with_roman_numbers(spark, pages):
    """Headers that end or begin with a roman number are judged as those with digits are."""
    heads = ("DRAFT CATALOGUE NOTES viii", "DRAFT MILL NOTES   xi", "DRAFT LEDGER NOTES iv", "Foreign Bakery   xvii", "Seite xii", "147 | Suburban Filter")
    for s in (*heads, "p. xii", "Page iii of xii", "xii | Suburban Filter", "cxlviii", "Late Mill xcv", "DRAFT NOTES   Seite xvii", "Tram Office · Konil · Vol. XII"):
        assert looks_like_furniture(s), s
    for s in ("- x axis: season", "handled 2262 vi-", "The kiln handled 2019 i", "I  said so", "X | Y", "Demand = f(x)", "the civil mill", "a line of plain words xi", "noted xi."):
        assert not looks_like_furniture(s), s
    texts = [wrap(p.replace("\n", " ")) for p in pages[0][: len(heads)]]
    df = spark.createDataFrame([(k, "\n".join([*t[:2], h, *t[2:]])) for k, (t, h) in enumerate(zip(texts, heads, strict=True))], "k int, text string")
    got = {r.k: list(r.furniture) for r in S.page_lines(df, ["k"], S.train_furniture(WORDS)).collect()}
    assert got == {k: [2] for k in range(len(heads))}


def test_last_words(spark, pages):
    """A misread last word counts without a mark after it; the beginning of a frequent word is no misread one."""
    clean = pages[0]
    data = [("c", k, x) for k, x in enumerate(clean)] + [("n", 0, "The required rnaintenance"), ("n", 1, "temperafure"), ("n", 2, "A narrow laborafory"), ("o", 0, "The required main"), ("o", 1, "The pump of the arch"), ("o", 2, "The modest tempera")]
    df = spark.createDataFrame(data, "who string, k int, text string")
    got = {(r.who, r.k) for r in S.find_scan_noise(df, ["who", "k"]).collect()}
    assert {x for x in got if x[0] != "c"} == {("n", 0), ("n", 1), ("n", 2)}


def test_held_out_furniture(spark, pages):
    """Forms that no training page has, where a sentence goes on around them; and lines that belong to a text."""
    heads = ("internal draft, do not circulate", "Confidential", "page twelve", "Property of the archive", "FOR REVIEW ONLY")
    texts = [wrap(p.replace("\n", " ")) for p in pages[0][: len(heads)]]
    inner = []
    for t in texts:
        at = next(k for k in range(1, len(t)) if t[k][:1].islower() and t[k - 1][-1] not in ".?!")
        inner.append(at)
    data = [(k, "\n".join([*t[:at], h, *t[at:]])) for k, (t, h, at) in enumerate(zip(texts, heads, inner, strict=True))]
    whole = ["\n".join(t) for t in texts] + ["## Rural pump\n\n" + texts[0][0] + "\n\n## Late mill\n\n" + texts[1][0], "HTTP 504 - Gateway Time-out\nRequest id 16619606", "text\ntext\ntext\ntext", "- one pump\n- two mills\n- 3 kilns", "City | 2018 | 2019\nRome | 1 | 2\nParis | 3 | 4"]
    df = spark.createDataFrame(data + [(100 + k, t) for k, t in enumerate(whole)], "k int, text string")
    got = {r.k: list(r.furniture) for r in S.page_lines(df, ["k"], S.train_furniture(WORDS)).collect() if r.furniture}
    assert got == {k: [at] for k, at in enumerate(inner)}
