import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafwork.operators import nested


def paths(text):
    top = nested.parse_object(text)
    return None if top is None else sorted((r[0], r[1]) for r in nested.shred_object(top)[1:])


def brute(o, path=""):
    """All objects below an object, by plain recursion."""
    out = []

    def walk(v, p, parent):
        if isinstance(v, dict):
            out.append((p, parent))
            for k, x in v.items():
                walk(x, f"{p}/{k}", p)
        elif isinstance(v, list):
            for k, x in enumerate(v):
                walk(x, f"{p}/{k}", parent)

    for k, v in o.items():
        walk(v, f"{path}{k}", "")
    return sorted(out)


JSON = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=5), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(st.characters(codec="utf-8", exclude_characters="/"), max_size=4), x, max_size=4), max_leaves=25)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.text(st.characters(codec="utf-8"), max_size=4), JSON, max_size=5))
def test_paths_equal_recursion(o):
    assert paths(json.dumps(o)) == brute(o)


@settings(max_examples=150, deadline=None)
@given(JSON)
def test_own_parser_equals_library(o):
    def plain(x):
        if isinstance(x, nested._Object):
            return ("o", [(k, plain(v)) for k, v in x.pairs])
        return [plain(v) for v in x] if isinstance(x, list) else x

    text = json.dumps(o)
    assert plain(nested._parse_deep(text)) == plain(json.loads(text, **nested._DECODER))


@pytest.mark.parametrize("bad", [None, "", " ", "null", "[]", "[{}]", '"x"', "{", '{"a":}', '{"a":1,}', '{"a" 1}', "{} {}", '{"a":NaN}', '{"a":Infinity}', '{"a":[1,]}', '{"a":"\n"}'])
def test_no_object(bad):
    assert nested.parse_object(bad) is None
    if bad and bad.strip() and bad != "null":
        try:
            got = nested._parse_deep(bad)
        except ValueError:
            return
        assert not isinstance(got, nested._Object)


def test_deep_nesting():
    n = 200_000
    text = '{"a":' * n + "1" + "}" * n
    top = nested.parse_object(text[: 5 * 3000] + "1" + "}" * 3000)
    assert len(nested.shred_object(top)) == 3000
    deep = nested.parse_object(text)
    assert deep is not None


def test_identity():
    a = nested.shred_object(nested.parse_object('{"x":{"p":1,"q":[true,null]},"y":[{"q":[true,null],"p":1},{"p":"1","q":[true,null]}]}'))
    by = {r[0]: r for r in a}
    assert by["x"][6] == by["y/0"][6] != by["y/1"][6]
    assert by["x"][7] == by[""][6] and by[""][7] is None
    assert by["y/0"][3] == 0 and by["x"][3] is None
    assert [(x[0], x[1], x[2], x[3]) for x in by["x"][8]] == [("p", 0, "number", "1"), ("q", 0, "boolean", "true"), ("q", 1, "null", None)]


def test_hostile_fields():
    top = nested.parse_object('{"a":{"\\ud800":1},"a":{"b":2},"c":[null,[{}]]}')
    assert [r[0] for r in nested.shred_object(top)] == ["", "a", "a", "c/1/0"]


def test_frames(spark, rows):
    data = [(1, '{"a":{"b":{}}}'), (2, None), (3, ""), (4, "[1]"), (5, '{"a":{"b":{}}}'), (5, '{"a":{"b":{}}}')]
    df = spark.createDataFrame([(i, t, "x") for i, t in data], "layout_id bigint, raw string, field string")
    got = rows(nested.shred(df, "layout_id", "raw", with_top=False).select("layout_id", "elem_path", "parent_path"))
    assert got == sorted([(1, "a", ""), (1, "a/b", "a")] + [(5, "a", ""), (5, "a/b", "a")] * 2)
    all_ = nested.shred(df, "layout_id", "raw")
    assert nested.objects(all_).count() == 3
    assert {r["occurrences"] for r in nested.bridge(all_).collect()} == {3}
    empty = nested.shred(df.where("false"), "layout_id", "raw")
    assert empty.count() == 0 and "object_hash" in empty.columns
