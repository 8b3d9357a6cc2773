import random

from hypothesis import given, settings
from hypothesis import strategies as st

from leafwork.llm import contamination as C

WORDS = [f"{a}{b}" for a in ("ka", "re", "mo", "ti", "su", "ne") for b in ("lan", "dor", "vik", "mes", "tan", "rub", "pol", "gar")]
INSTRUCTION = "Read the passage below and answer in one short sentence."


def passage(rng, n=60):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def make():
    rng = random.Random(3)
    items = [(k, f"{INSTRUCTION} {passage(rng)}") for k in range(6)]
    words = [t.split(". ", 1)[1].split() for _, t in items]
    shuffled = words[3][:]
    rng.shuffle(shuffled)
    replaced = [("zzz" if k % 9 == 4 else w) for k, w in enumerate(words[1][:40])]
    divided = " ".join(words[5][:40])
    at = divided.index(" ", 60) - 2
    docs = [
        (1, passage(rng, 100) + "\n+// " + "\n+// ".join(" ".join(words[0][k : k + 8]).upper() for k in range(0, 60, 8))),
        (2, "x " + ", ".join(replaced) + " y"),
        (3, " ".join(words[2][10:36])),
        (4, " ".join(words[2][:10])),
        (5, " ".join(shuffled)),
        (6, INSTRUCTION + " " + passage(rng)),
        (7, "<p>" + "</b> <b>".join(words[4]) + "</p>\\u00a0end"),
        (8, divided[:at] + "-\n  # " + divided[at:]),
        (9, None), (10, ""), (11, passage(rng, 20000)),
        (12, " ".join(words[0][:30]) + " and then " + " ".join(words[1][:30])),
    ]
    return docs, items


WANT = {(1, 0), (2, 1), (3, 2), (7, 4), (8, 5), (12, 0), (12, 1)}


def test_leaks(spark):
    docs, items = make()
    d = spark.createDataFrame([(k, t, "x") for k, t in docs], "doc_id bigint, text string, item_id string")
    i = spark.createDataFrame([*items, (90, None), (91, ""), (92, "too short")], "item_id bigint, text string")
    leaks = C.find_leaks(d, i, spans=True)
    got = leaks.collect()
    assert {(r.doc_id, r.item_id) for r in got} == WANT
    report = {r.item_id: (r.n_docs, r.leaked) for r in C.leaked_items(leaks, i).collect()}
    assert report[0] == (2, True) and report[3] == (0, False) and len(report) == 9
    cut = {r.doc_id: r.text for r in C.without_leaks(d, leaks).collect()}
    assert set(cut) == {1, 2, 3, 7, 8, 12} and cut[3] is None and cut[12] is None
    assert cut[1].split()[:100] == docs[0][1].split()[:100] and not set(x.lower() for x in cut[1].split()[100:]) & set(WORDS)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items = make()
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(C, "BLOCK_WORDS", 150)
    got = {(r.doc_id, r.item_id) for r in C.find_leaks(d, i).collect()}
    assert got == WANT


def test_empty(spark):
    d = spark.createDataFrame([], "doc_id bigint, text string")
    i = spark.createDataFrame([], "item_id bigint, text string")
    assert C.find_leaks(d, i).count() == 0
    docs, items = make()
    assert C.find_leaks(d, spark.createDataFrame(items, "item_id bigint, text string")).count() == 0
    assert C.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), i).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aB ß-\n<>&;İé\\u00a0npl/1") | st.characters(codec="utf-8"), max_size=60))
def test_places_follow_words(text):
    words, places = C.normal_words(text), C.word_places(text)
    assert len(words) == len(places)
    assert all(0 <= a < b <= len(text) for a, b in places)
    assert all(places[k][0] <= places[k + 1][0] for k in range(len(places) - 1))


def test_merged():
    assert C.merged([(5, 9), (1, 3), (4, 4), (20, 21)]) == [(1, 9), (20, 21)]


def test_every_copy_of_a_passage_is_removed(spark):
    rng = random.Random(5)
    other = [" ".join(f"x{n}y{k}" for k in range(150)) for n in range(4)]
    items = [(k, passage(rng)) for k in range(2)]
    p = items[0][1].rstrip(".")
    words = p.split()
    replaced = " ".join("xxx" if k % 9 == 4 and k < 50 else w for k, w in enumerate(words))
    docs = [
        (1, f"{other[0]} {p} {other[1]} {p} {other[2]}"),  # two files of a commit
        (2, f"{other[0]} {p} {p} {other[1]} {other[2]}"),
        (3, f"{other[0]} {' '.join(words[:25])} {other[1]} {' '.join(words[30:])} {other[2]}"),  # two pieces
        (4, f"{other[0]} {p} {other[1]} {replaced} {other[2]} {p} {other[3]}"),
        (5, f"{p} {p} {p} {other[0]}"),
        (6, f"{other[0]} {items[1][1]} {other[1]} {p}"),
    ]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    leaks = C.find_leaks(d, i, spans=True)
    assert leaks.count() == C.find_leaks(d, i).count() == 7
    assert {r.item_id: r.n_docs for r in C.leaked_items(leaks, i).collect()} == {0: 6, 1: 1}
    got = {r.doc_id: (r.text, r.removed_spans) for r in C.without_leaks(d, leaks).collect()}
    left = {k: None if t is None else [w for w in C.normal_words(t) if not w.startswith("x")] for k, (t, _) in got.items()}
    assert left == {1: [], 2: [], 3: [], 4: [], 5: None, 6: []}
    assert {k: n for k, (_, n) in got.items()} == {1: 2, 2: 2, 3: 2, 4: 3, 5: 3, 6: 2}


def test_many_copies_in_a_row():
    rng = random.Random(6)
    words = C.normal_words(passage(rng))
    text = ["x"] * 7 + (words + ["x"]) * 400 + ["x"] * 500 + words[:25]
    places = [at for at in range(len(text)) if "x" not in text[at : at + C.NGRAM]]
    want = [(60, 7 + 61 * k, 66 + 61 * k) for k in range(400)] + [(25, len(text) - 25, len(text) - 1)]
    assert sorted(C._runs(words, text, 0, len(text), places), key=lambda r: r[1]) == want


def test_sentences_shared_across_blocks(spark, monkeypatch):
    rng = random.Random(9)
    instruction = " ".join(f"i{k}" for k in range(30)) + "."
    items = [(k, f"{instruction} {passage(rng)}") for k in range(6)]
    docs = [(1, instruction), (2, items[2][1]), (3, passage(rng))]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = sorted(map(tuple, C.find_leaks(d, i).collect()))
    assert [r[:2] for r in want] == [(2, 2)]
    monkeypatch.setattr(C, "BLOCK_WORDS", 100)
    assert sorted(map(tuple, C.find_leaks(d, i).collect())) == want
