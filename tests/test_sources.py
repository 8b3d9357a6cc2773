import io
import os

import pytest
import zipfile

from pyspark.sql import functions as F

from leafwork import convert, sinks
from leafwork.__main__ import main
from leafwork.sources import backends, layout, pptx
from leafwork.streaming import incoming

NS = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def box(top, left, w=100, h=50):
    return f'<a:xfrm><a:off x="{left}" y="{top}"/><a:ext cx="{w}" cy="{h}"/></a:xfrm>'


def text_shape(text, top, left, ph="", extra=""):
    paragraphs = "".join(f"<a:p><a:r><a:t>{t}</a:t></a:r></a:p>" for t in text.split("\n"))
    return f'<p:sp><p:nvSpPr><p:cNvPr id="1" name="x"/><p:cNvSpPr txBox="1"/><p:nvPr>{ph}</p:nvPr></p:nvSpPr><p:spPr>{box(top, left)}{extra}</p:spPr><p:txBody>{paragraphs}</p:txBody></p:sp>'


def deck():
    picture = f'<p:pic><p:blipFill><a:blip r:embed="rId7"/></p:blipFill><p:spPr>{box(30, 0)}</p:spPr></p:pic>'
    filled = text_shape("hidden by the picture", 40, 0, extra='<a:blipFill><a:blip r:embed="rId7"/></a:blipFill>')
    table = f'<p:graphicFrame><p:xfrm><a:off x="0" y="90"/><a:ext cx="9" cy="9"/></p:xfrm><a:graphic><a:graphicData><a:tbl><a:tr><a:tc><a:txBody><a:p><a:r><a:t>c1</a:t></a:r></a:p></a:txBody></a:tc><a:tc><a:txBody><a:p><a:r><a:t>c2</a:t></a:r></a:p></a:txBody></a:tc></a:tr></a:tbl></a:graphicData></a:graphic></p:graphicFrame>'
    group = f"<p:grpSp><p:grpSpPr>{box(10, 0)}</p:grpSpPr>{text_shape('in group', 500, 0)}</p:grpSp>"
    one = f'<p:sld {NS}><p:cSld><p:spTree>{table}{picture}{text_shape("body", 20, 0)}{group}{text_shape("Title", 0, 0, ph="<p:ph type=" + chr(34) + "title" + chr(34) + "/>")}{filled}</p:spTree></p:cSld></p:sld>'
    two = f"<p:sld {NS}><p:cSld><p:spTree/></p:cSld></p:sld>"
    notes = f'<p:notes {NS}><p:cSld><p:spTree>{text_shape("my notes", 0, 0, ph="<p:ph type=" + chr(34) + "body" + chr(34) + "/>")}</p:spTree></p:cSld></p:notes>'
    rel = lambda *rs: '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="{i}" Type="{REL}/{k}" Target="{t}"/>' for i, k, t in rs) + "</Relationships>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("ppt/presentation.xml", f'<p:presentation {NS}><p:sldIdLst><p:sldId id="1" r:id="rId2"/><p:sldId id="2" r:id="rId1"/></p:sldIdLst><p:sldSz cx="1000" cy="500"/></p:presentation>')
        z.writestr("ppt/_rels/presentation.xml.rels", rel(("rId1", "slide", "slides/slide1.xml"), ("rId2", "slide", "slides/slide2.xml")))
        z.writestr("ppt/slides/slide2.xml", one)
        z.writestr("ppt/slides/slide1.xml", two)
        z.writestr("ppt/slides/_rels/slide2.xml.rels", rel(("rId7", "image", "../media/p.PNG"), ("rId8", "notesSlide", "../notesSlides/n.xml")))
        z.writestr("ppt/notesSlides/n.xml", notes)
        z.writestr("ppt/media/p.PNG", b"pixels")
    return out.getvalue()


def test_scan_and_convert(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "A & B.pptx").write_bytes(deck())
    (tmp_path / "in" / "sub" / "broken.PPTX").write_bytes(b"no zip")
    shapes = pptx.scan(spark, str(tmp_path / "in"))
    rows = shapes.collect()
    assert {r.shape_type for r in rows if r.slide_no == 1} == {"TABLE", "PICTURE", "TEXT_BOX", "PLACEHOLDER"}
    assert [r.error is not None for r in rows if "broken" in r.path] == [True]
    assert {r.slide_width for r in rows if r.error is None} == {1000}
    xml = convert.deck_xml(shapes).collect()
    assert len(xml) == 1
    body = xml[0].xml
    order = [body.index(x) for x in ("Slide 1", "Title", "in group", "body", "[Image 1]", "c1 | c2", "Slide 2")]
    assert order == sorted(order) and "hidden" not in body and body.count("[Image 1]") == 2 and "notes" not in body
    md = convert.deck_markdown(shapes).first().markdown
    assert "**Speaker notes:** my notes" in md and "## Slide 2\n\n_[no content]_\n" in md
    lean = pptx.scan(spark, str(tmp_path / "in"), need_text=False, need_images=False).where("error IS NULL").collect()
    assert all(r.text is None and r.blob is None for r in lean)


def test_command_line_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "deck.one.pptx").write_bytes(deck())
    assert main([str(tmp_path / "in"), str(tmp_path / "out" / "deep"), "--format", "md"]) == 0
    assert os.listdir(tmp_path / "out" / "deep") == ["deck.one.md"]
    df = spark.createDataFrame([("a/x.txt", "é\r\n"), ("b/x.txt", "two"), ("n.txt", None), ("e.txt", "")], "name string, body string")
    for write, folder in ((sinks.write_files, str(tmp_path / "files")), (sinks.write_files, "file://" + str(tmp_path / "more"))):
        assert write(df, folder, "name", "body") == 3
        assert sinks.write_files(df.where("false"), folder, "name", "body") == 0
    assert sinks._write_hadoop(df.where("body IS NOT NULL"), "file://" + str(tmp_path / "store")) == 3
    for folder in ("files", "more", "store"):
        assert (tmp_path / folder / "a" / "x.txt").read_bytes() == "é\r\n".encode() and (tmp_path / folder / "b" / "x.txt").read_bytes() == (b"two\n" if folder == "store" else b"two")
    for bad in ([("../x.txt", "a")], [("/x.txt", "a")], [("x", "a"), ("x", "b")]):
        with pytest.raises(ValueError):
            sinks.write_files(spark.createDataFrame(bad, "name string, body string"), str(tmp_path / "bad"), "name", "body")
    assert not (tmp_path / "bad").exists()


def test_equal_names_in_two_folders(spark, tmp_path):
    for d in ("a", "b"):
        (tmp_path / "in" / d).mkdir(parents=True)
        (tmp_path / "in" / d / "x.pptx").write_bytes(deck())
    assert main([str(tmp_path / "in"), str(tmp_path / "out")]) == 0
    assert sorted(str(f.relative_to(tmp_path / "out")) for f in (tmp_path / "out").rglob("*.xml")) == ["a/x.xml", "b/x.xml"]


def test_stream_leaves_nothing(spark, tmp_path):
    from leafwork import runtime

    (tmp_path / "in").mkdir()
    for k in range(10):
        (tmp_path / "in" / f"{k}.pptx").write_bytes(deck())
    before = list(runtime._written)
    folder = runtime.shared_dir(spark).removeprefix("file://") + "/leafwork"
    there = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    q = incoming.render_incoming(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), at_a_time=1)
    q.awaitTermination()
    assert len([d for d in os.listdir(tmp_path / "out") if d.startswith("batch=")]) == 10
    assert runtime._written == before and set(os.listdir(folder)) <= there


def test_slide_counts(spark):
    df = spark.createDataFrame([("a.pptx", bytearray(deck())), ("b.pptx", bytearray(b"no zip"))], "path string, content binary")
    got = {r.path: r.n_slides for r in pptx.slide_counts(df).collect()}
    assert got["a.pptx"] >= 1 and got["b.pptx"] is None


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pptx").write_bytes(deck())
    run = lambda: incoming.render_incoming(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    run()
    (tmp_path / "in" / "b.pptx").write_bytes(deck())
    run()
    run()
    got = spark.read.parquet(str(tmp_path / "out")).select(F.regexp_extract("path", r"([^/]+)$", 1)).collect()
    assert sorted(r[0] for r in got) == ["a.pptx", "b.pptx"]


def test_layout_exports(spark, tmp_path):
    data = [(1, '{"file name":"a.pdf","number of pages":2,"author":null,"kids":[]}'), (2, "[]"), (3, "{broken"), (4, None), (5, "")]
    got = layout.read_exports(spark.createDataFrame(data, "layout_id int, raw string")).collect()
    assert [(r.layout_id, r.file_name, r.number_of_pages, r.author) for r in got] == [(1, "a.pdf", 2, None)]
    (tmp_path / "x.json").write_text(data[0][1])
    assert layout.read_export_files(spark, str(tmp_path)).first().raw == data[0][1]


def test_backends():
    try:
        backends.get("ppt")
        raise AssertionError
    except LookupError:
        pass
    backends.register("svg", bytes)
    assert backends.get("svg") is bytes


def test_inherited_places(spark):
    """A placeholder without a place of its own stands where its layout puts it, else its master."""
    ns = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    rel = lambda *pairs: '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="rId{k}" Type="http://x/{kind}" Target="{to}"/>' for k, (kind, to) in enumerate(pairs, 1)) + "</Relationships>"
    box = lambda x, y: f'<p:spPr><a:xfrm><a:off x="{x}" y="{y}"/><a:ext cx="5" cy="6"/></a:xfrm></p:spPr>'
    sp = lambda ph, place="<p:spPr/>", text="": f"<p:sp><p:nvSpPr><p:nvPr>{ph}</p:nvPr></p:nvSpPr>{place}<p:txBody><a:p><a:r><a:t>{text}</a:t></a:r></a:p></p:txBody></p:sp>"
    page = lambda tag, *shapes: f"<p:{tag} {ns}><p:cSld><p:spTree>{''.join(shapes)}</p:spTree></p:cSld></p:{tag}>"
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("ppt/presentation.xml", f'<p:presentation {ns}><p:sldIdLst><p:sldId id="1" r:id="rId1"/></p:sldIdLst></p:presentation>')
        z.writestr("ppt/_rels/presentation.xml.rels", rel(("slide", "slides/slide1.xml")))
        z.writestr("ppt/slides/slide1.xml", page("sld", sp('<p:ph type="body" idx="3"/>', text="low"), sp('<p:ph type="ctrTitle"/>', text="high"), sp("", text="none"), sp('<p:ph idx="9"/>', box(1, 50), "own")))
        z.writestr("ppt/slides/_rels/slide1.xml.rels", rel(("slideLayout", "../slideLayouts/l.xml")))
        z.writestr("ppt/slideLayouts/l.xml", page("sldLayout", sp('<p:ph type="body" idx="3"/>', box(2, 90)), sp('<p:ph type="ctrTitle"/>')))
        z.writestr("ppt/slideLayouts/_rels/l.xml.rels", rel(("slideMaster", "../slideMasters/m.xml")))
        z.writestr("ppt/slideMasters/m.xml", page("sldMaster", sp('<p:ph type="title"/>', box(3, 10))))
    got = {r[10]: (r[6], r[7], r[8], r[9]) for r in pptx.parse_deck("d", data.getvalue())}
    assert got == {"low": (90, 2, 5, 6), "high": (10, 3, 5, 6), "none": (None, None, None, None), "own": (50, 1, 5, 6)}
