from hypothesis import given, settings
from hypothesis import strategies as st

from leafwork.llm import splitter

TEXT = st.text(st.sampled_from("ab é.!?,;:\n\n 中文。，\"'-—…1") | st.characters(codec="utf-8"), max_size=400)


@settings(max_examples=400, deadline=None)
@given(TEXT, st.integers(1, 60), st.integers(0, 70))
def test_round_trip(text, limit, overlap):
    pieces = splitter.cut(text, limit, overlap)
    over = min(overlap, limit - 1)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    back = ""
    for n, (start, end, _) in enumerate(pieces):
        assert end - start <= limit
        if n:
            assert pieces[n - 1][1] - start == over and end > pieces[n - 1][1]
        back = back[:start] + text[start:end]
    assert back == text


def test_best_boundary_wins():
    assert [k for *_, k in splitter.cut("aaa bbb. ccc\n\nddd eee fff", 16, 0)] == ["paragraph", "end"]
    assert [k for *_, k in splitter.cut("aaa bbb. ccc ddd", 12, 0)] == ["sentence", "end"]
    assert [k for *_, k in splitter.cut("x" * 30, 10, 2)] == ["hard", "hard", "hard", "end"]
    assert [k for *_, k in splitter.cut("今年。" + "水庫" * 5, 8, 0)][0] == "word"
    assert splitter.cut("abc", 3, 1) == [(0, 3, "end")]


def test_every_overlap_below_the_limit_is_kept():
    for overlap in range(10):
        pieces = splitter.cut("one two three four five six seven", 10, overlap)
        assert {a[1] - b[0] for a, b in zip(pieces, pieces[1:])} == {overlap}


def test_boundaries_cover_spaces():
    ranks = splitter.boundaries('He said "no." Then, go\nnow\n\nend')
    assert ranks[0] == [28] and ranks[1] == [23] and 14 in ranks[2] and 20 in ranks[3]


def test_frames(spark):
    kids = spark.createDataFrame([("a", 1, "w " * 30, 1), ("a", 1, "w " * 30, 2), ("b", 2, "x" * 20, 1), ("c", 3, None, 1), ("d", 4, "", 1), (None, 5, "y" * 21, 1)], "doc_id string, id int, content string, start int")
    block = "array<struct<kind:string,text:string,image_id:int>>"
    pages = spark.createDataFrame([("p", 1, [("text", "aaaa", None), ("image", "zz", 1), ("text", None, None), ("text", "", None), ("text", "bbbb", None)]), ("q", 1, None), ("r", 2, [])], f"doc_id string, number int, blocks {block}")
    limits = spark.createDataFrame([("layout_kids", 20, 5), ("page_units", 9, None)], "table_name string, max_chars int, overlap_chars int")
    got = splitter.oversized_pieces(kids, pages, limits).collect()
    assert {(r.table_name, r.doc_id, r.item_id) for r in got} == {("layout_kids", "a", 1), ("layout_kids", None, 5), ("page_units", "p", 1)}
    assert [r.piece for r in sorted((r for r in got if r.doc_id == "p"), key=lambda r: r.piece_no)] == ["aaaa\n\n", "bbbb"]
    assert splitter.oversized_pieces(kids.where("false"), pages.where("false"), limits).count() == 0
    assert splitter.oversized_pieces(kids, pages, limits.where("false")).count() == 0
