"""Conversions of legacy decks, PDFs and routed decks, with stub backends and models."""

import pytest
from pyspark.sql import functions as F

from leafwork import convert
from leafwork.operators import measure, models
from leafwork.sources import backends


@pytest.fixture
def plugged(monkeypatch):
    monkeypatch.setattr(backends, "_registered", {})
    backends.register("deck_to_pdf", lambda content: b"pdf:" + content)
    backends.register("split_pdf", lambda pdf, numbers: {n: pdf + b"#%d" % n for n in numbers if n != 9})
    backends.register("stitch", lambda top, bottom: top + b"+" + bottom)
    backends.register("render_page", lambda content, n: content + b"@%d" % n)


def figure(blob, ext):
    if b"bad" in blob:
        raise ValueError("no picture")
    return f"<{blob.decode()}.{ext}>" if blob != b"mute" else ""


UNITS = "doc_id string, slide_number int, title string, text string, images array<struct<content_type:string,width:int,height:int,image_index:int,blob:binary>>"


def test_ppt(spark):
    pic = lambda blob, index, mime="image/png", w=200, h=200: (mime, w, h, index, bytearray(blob))
    data = [
        ("a.ppt", 1, " One ", "first", [pic(b"late", 5), pic(b"vector", 0, "image/x-wmf"), pic(b"small", 1, w=149), pic(b"", 2)]),
        ("a.ppt", 2, None, " ", [pic(b"early", 1, " Image/JPG "), pic(b"late", 3, w=0, h=0)]),
        ("a.ppt", 4, "", "last", None), ("b.ppt", 1, None, None, []),
    ]
    prompts = spark.sparkContext.accumulator(0)

    def match(prompt):
        prompts.add(1)
        assert "Slide 1: One first" in prompt and "Figure 1: <early.jpg>" in prompt
        return '```json\n{"1": "2", "2": 3, "9": 1}\n```'

    got = {r.path: r.xml for r in convert.ppt_xml(spark.createDataFrame(data, UNITS), match=match, describer=figure).collect()}
    body = got["a.ppt"].split('data-type="PPT">\n')[1]
    assert body.startswith("Slide 1\n\nOne\n\nfirst\n\nSlide 2\n\n[Image 1 (approximate slide)]\n<early.jpg>\n\nSlide 4\n\nlast\n\n[Image 2 (approximate slide)]\n<late.png>")
    assert prompts.value == 1 and "Slide 1\n  </document>" in got["b.ppt"]
    with pytest.raises(Exception):  # a reply that isn't JSON stops the job
        convert.ppt_xml(spark.createDataFrame(data, UNITS), match=lambda p: "sorry", describer=figure).collect()


PAGES, SPANS = "doc_id string, page int, width double, height double", "doc_id string, page int, block int, line int, span int, text string, x0 double, y0 double, x1 double, y1 double"
IMAGES = "doc_id string, page int, idx int, x0 double, y0 double, x1 double, y1 double, w int, h int, ext string, blob binary"


def test_pdf(spark, plugged):
    pages = spark.createDataFrame([("a.pdf", n, 100.0, 100.0) for n in (1, 2, 3, 4)], PAGES)
    spans = spark.createDataFrame([("a.pdf", 1, 0, 0, 1, "lo ", 0.0, 50.0, 9.0, 60.0), ("a.pdf", 1, 0, 0, 0, " Hel", 0.0, 50.0, 9.0, 60.0), ("a.pdf", 1, 0, 1, 0, "  ", 0.0, 50.0, 9.0, 60.0), ("a.pdf", 1, 0, 2, 0, "again", 0.0, 50.0, 9.0, 60.0), ("a.pdf", 2, 0, 0, 0, "a page of text, and no scan", 0.0, 60.0, 9.0, 70.0)], SPANS)
    pic = lambda page, idx, y0, y1, blob, w=90, h=90: ("a.pdf", page, idx, 10.0, y0, 80.0, y1, w, h, "png", bytearray(blob))
    images = spark.createDataFrame([pic(1, 0, 70.0, 99.0, b"top"), pic(2, 0, 1.0, 30.0, b"bottom"), pic(1, 1, 5.0, 20.0, b"bad"), pic(1, 2, 5.0, 20.0, b"tiny", 63, 90), pic(2, 1, 40.0, 50.0, b"mute"), pic(3, 0, 0.0, 99.0, b"scan"), pic(2, 3, 40.0, 50.0, b"")], IMAGES)
    files = spark.createDataFrame([("a.pdf", bytearray(b"file"))], "doc_id string, content binary")
    run = lambda **k: convert.pdf_xml(pages, spans, images, files, figure=figure, page=lambda b, e: "read " + b.decode(), **k).collect()[0].xml
    xml = run()
    assert "Page 1\n\n" in xml and "Hello\nagain" in xml and "tiny" not in xml
    assert "[image description failed: no picture]</image>" in xml and "<top+bottom.png></image>" in xml and "(no description)</image>" in xml
    assert xml.index("Hello") < xml.index("top+bottom") < xml.index("Page 2") and "Page 3\n\nread file@3\n\nPage 4\n\nread file@4\n" in xml
    assert run(fallback=False).endswith("Page 3\n\nread file@3\n\nPage 4\n  </document>\n</documents>\n")


SHAPES = "path string, slide_no int, ord_path array<int>, shape_type string, ph_type string, width bigint, height bigint, text string, rows array<array<string>>, notes string, slide_width bigint, slide_height bigint, error string"


def shape(path, n, order, kind, text=None, w=1, rows=None, notes=None):
    return (path, n, order, kind, "BODY", w, 1, text, rows, notes, 10, 10, None)


def test_routed(spark, plugged):
    words = "w " * 40
    data = [
        shape("t.pptx", 1, [1], "TEXT_BOX", "second"), shape("t.pptx", 1, [0], "TEXT_BOX", words, notes=" hint "), shape("t.pptx", 1, [2], "TABLE", rows=[["a", " b "], ["", ""]]), shape("t.pptx", 2, None, None),
        shape("t.pptx", 3, [0], "PICTURE", w=90), shape("t.pptx", 4, [0], "TEXT_BOX", "x"), shape("t.pptx", 9, [0], "PICTURE", w=90), shape("v.pptx", 1, [0], "PICTURE", w=90), ("bad.pptx", *[None] * 11, "BadZipFile"),
    ]
    shapes = spark.createDataFrame(data, SHAPES)
    files = spark.createDataFrame([(p, bytearray(p.encode())) for p in ("t.pptx", "v.pptx", "bad.pptx")], "path string, content binary")
    say = lambda pdf: f" seen {pdf.decode()} "
    got = {r.path: (r.mode, r.markdown) for r in convert.deck_routed(files, shapes, page_model=say, deck_model=say).collect()}
    assert got["v.pptx"] == ("whole", "seen pdf:v.pptx\n")
    mode, text = got["t.pptx"]
    assert mode == "routed" and text == (
        f"## Slide 1  (text)\n\n{words.strip()}\n\nsecond\n\na | b\n\n**Speaker notes:** hint\n\n---\n\n## Slide 2  (text)\n\n_[no content]_\n\n---\n\n## Slide 3  (vision)\n\nseen pdf:t.pptx#3"
        "\n\n---\n\n## Slide 4  (text)\n\nx\n\n---\n\n## Slide 9  (vision)\n\n_[slide could not be rendered]_\n"
    )
    assert set(got) == {"t.pptx", "v.pptx"}

    def fails(pdf):
        raise OSError("down")

    routed = {r.path: r.markdown for r in convert.deck_routed(files, shapes, page_model=fails, deck_model=say, mode="routed").collect()}
    assert routed["v.pptx"] == "## Slide 1  (vision)\n\n_[vision call failed: down]_\n"
    assert {r.mode for r in convert.deck_whole(files, shapes, deck_model=say).collect()} == {"whole"}
    with pytest.raises(Exception):
        convert.deck_whole(files, shapes, deck_model=fails).collect()


def test_calls_and_runs(spark):
    def model(text):
        if text == "x":
            raise ValueError("no")
        return f" {text} ", len(text), None

    df = spark.createDataFrame([(1, "ab"), (2, "x"), (3, "abcd")], "k int, prompt string")
    log = models.call(df, ["k"], ["prompt"], model)
    got = {r.k: (r.text, r.input_tokens, r.error) for r in log.collect()}
    assert got == {1: ("ab", 2, None), 2: ("[call failed: no]", 0, "no"), 3: ("abcd", 4, None)}
    assert log.rdd.getNumPartitions() == 1 and models.call(df, ["k"], ["prompt"], model, at_once=20, threads=5).rdd.getNumPartitions() == 4
    tally = measure.tally(log.withColumn("approach", F.lit("a")), ["approach"], ("input_tokens", "output_tokens", "seconds")).collect()[0]
    assert (tally.n_calls, tally.input_tokens, tally.output_tokens) == (3, 6, 0)
    line = measure.report_line({"approach": "routed", "n_calls": 1.25, "input_tokens": 2.5, "output_tokens": 3.5, "cost": None, "render_s": 0.25, "api_s": 1, "wall_s": 2})
    assert "calls   1.2 |" in line and "in         2 |" in line and "add price" in line
    scores = measure.score(spark.createDataFrame([("m", "The mill has 12 doors")], "method string, text string"), spark.createDataFrame([("m", "mill doors roof 12 13")], "method string, text string"), ["method"]).collect()[0]
    assert (scores.words, round(scores.word_recall, 3), scores.num_recall) == (2, 66.667, 50.0)
    prices = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 3.0)], "model string, input double, output double")
    runs = spark.createDataFrame([("a", 1_000_000, 2_000_000), ("b", 1, 1), (None, 1, 1)], "model string, input_tokens bigint, output_tokens bigint")
    assert {r.model: r.cost for r in measure.cost(runs, prices).collect()} == {"a": 8.0, "b": None, None: None}


def test_data_urls(spark):
    df = spark.createDataFrame([("a.JPG", bytearray(b"x" * 90)), ("b.webp", bytearray(b"y"))], "name string, blob binary")
    got = [r[0] for r in df.select(models.file_data_url("name", "blob")).collect()]
    assert got[0].startswith("data:image/jpeg;base64,eHh4") and "\n" not in got[0] and got[1] == "data:image/webp;base64,eQ=="
    assert df.select(models.pdf_data_url("blob")).first()[0].startswith("data:application/pdf;base64,")
    with pytest.raises(Exception):
        spark.createDataFrame([("a.gif", bytearray(b"x"))], "name string, blob binary").select(models.file_data_url("name", "blob")).collect()


def test_collection(spark):
    df = spark.createDataFrame([("b.pdf", "PDF", "two"), ("a&.pdf", "PDF", "one <x>")], "filename string, data_type string, body string")
    xml = convert.collection_xml(df, ["filename"]).first().xml
    assert xml == '<documents>\n  <document index="1" filename="a&amp;.pdf" data-type="PDF">\none <x>\n  </document>\n  <document index="2" filename="b.pdf" data-type="PDF">\ntwo\n  </document>\n</documents>\n'
