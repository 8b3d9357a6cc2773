import base64
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leafwork import settings as env
from leafwork.functions import text as T

SAMPLES = ["", " ", "a", " a b ", " x ", "\x1ca\x1f", "one two\tthree\n", "The cat AND the 3.5 hats, 12", 'a & "b" <c>\'', None, "x\n\n  y \n", "1 | 2 |\n | \nz", "a" * 5000]


def both(spark, build, values=SAMPLES):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r[0] for r in df.orderBy("k").select(build("v").alias("r")).collect()]


def test_strip_and_count_as_python_does(spark):
    assert both(spark, T.strip) == [None if v is None else v.strip() for v in SAMPLES]
    assert both(spark, T.word_count) == [0 if v is None else len(v.split()) for v in SAMPLES]
    assert both(spark, T.non_empty) == [bool(v and v.strip()) for v in SAMPLES]


def test_sets(spark):
    words = lambda v: sorted({w.lower() for w in re.findall(r"[a-zA-Z]{3,}", v)} - set(T.STOP_WORDS))
    assert both(spark, T.word_set) == [None if v is None else words(v) for v in SAMPLES]
    assert both(spark, T.number_set) == [None if v is None else sorted(set(re.findall(r"\d+(?:\.\d+)?", v))) for v in SAMPLES]


def test_paths(spark):
    paths = ["a/b.PPTX", "x.tar.gz", ".env", "noext", "/r/Ä.pdf", None]
    assert both(spark, T.suffix, paths) == [".pptx", ".gz", "", "", ".pdf", None]
    assert both(spark, T.stem, paths) == ["b", "x.tar", ".env", "noext", "Ä", None]
    assert both(spark, T.file_kind, paths) == ["pptx", None, None, None, "pdf", None]


def test_escape_default_mime(spark):
    assert both(spark, T.xml_attr, ['<&">\'', None]) == ["&lt;&amp;&quot;&gt;'", None]
    assert both(spark, lambda c: T.or_default(c, "d"), ["", " ", None, "x"]) == ["d", " ", "d", "x"]
    assert both(spark, T.ext_from_mime, [" IMAGE/JPEG ", "image/x-emf", None]) == ["jpg", None, None]


def test_data_url(spark):
    blob = bytes(range(256)) * 3
    df = spark.createDataFrame([(blob, "JPG"), (blob, "tiff"), (None, "png")], "b binary, e string")
    got = [r[0] for r in df.select(T.data_url("b", "e")).collect()]
    code = base64.b64encode(blob).decode()
    assert got == ["data:image/jpeg;base64," + code, "data:image/png;base64," + code, None]


def test_replies(spark):
    raw = ['```json\n{"1": 2.5}\n```', '{"1": "2"}', '{"1": "x"}', '{"1": null}', "{}", "no", None]
    assert both(spark, lambda c: T.reply_int(T.strip_fence(c), "$['1']"), raw) == [2, 2, None, None, None, None, None]


def test_tables(spark):
    assert both(spark, T.table_text, ["a | b\n | \n c|", " | \n", None]) == ["a | b\nc | ", None, None]
    assert both(spark, T.stripped_lines, ["x\n\n  y \n", "", None]) == ["x\ny", "", None]


def test_weights(spark):
    names = [None, "SUBTITLE (4)", "CENTER_TITLE", "BODY", "OBJECT", "SLIDE_NUMBER", "other", "subtitle"]
    assert both(spark, T.weight_tenths, names) == [8, 12, 15, 10, 10, 0, 8, 12]


def test_settings(tmp_path, monkeypatch):
    assert env.parse("# c\nA=1\nB = 'x y' \nbad\nC=\"q\n=z") == {"A": "1", "B": "x y", "C": '"q', "": "z"}
    (tmp_path / ".env").write_text("LEAF_A=file\n")
    (tmp_path / "in").mkdir()
    monkeypatch.delenv("LEAF_A", raising=False)
    assert env.get("LEAF_A", str(tmp_path / "in")) == "file"
    monkeypatch.setenv("LEAF_A", "env")
    assert env.get("LEAF_A", str(tmp_path / "in")) == "env"


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=30))
def test_settings_never_fail(text):
    env.parse(text)


def test_null_columns(spark):
    df = spark.createDataFrame([(None,)], "v string")
    r = df.select(T.strip("v"), T.word_set("v"), T.table_text("v"), T.suffix("v"), F.lit(1)).first()
    assert list(r) == [None, None, None, None, 1]
