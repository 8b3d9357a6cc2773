"""Presentations (.pptx) as rows of shapes: an OOXML scan with the standard library only.

One row a leaf shape, with the path that orders it among nested groups, its text, table and picture (its own or the
one that fills it).  Files that can't be read have one row with ``error`` and nothing else; they never stop the scan.
"""

from __future__ import annotations

import io
import posixpath
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SHAPES = (
    "path string, slide_no int, sort_path array<struct<top:bigint,left:bigint,ord:int>>, ord_path array<int>, shape_type string, ph_type string, top bigint, left bigint, "
    "width bigint, height bigint, text string, rows array<array<string>>, blob binary, ext string, notes string, slide_width bigint, slide_height bigint, error string"
)
_NAMES = [c.split()[0] for c in re.sub(r"<[^<>]*(?:<[^<>]*>[^<>]*)*>", "", SHAPES).split(", ")]
#: The namespaces of the format.
_A, _P, _R = "{http://schemas.openxmlformats.org/drawingml/2006/main}", "{http://schemas.openxmlformats.org/presentationml/2006/main}", "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}Relationship"
#: Placeholder types of the format and the names that weights are given by.
PLACEHOLDERS = {"title": "TITLE", "ctrTitle": "CENTER_TITLE", "subTitle": "SUBTITLE", "body": "BODY", "obj": "OBJECT", "ftr": "FOOTER", "sldNum": "SLIDE_NUMBER", "dt": "DATE", "pic": "PICTURE", "tbl": "TABLE", "chart": "CHART"}


def _relations(z: zipfile.ZipFile, part: str) -> dict[str, tuple[str, str]]:
    """Relation id -> (part, kind) of a part of the package."""
    folder, name = posixpath.split(part)
    try:
        root = ET.fromstring(z.read(f"{folder}/_rels/{name}.rels"))
    except KeyError:
        return {}
    out = {}
    for r in root.iter(_REL):
        target = r.get("Target", "")
        full = target[1:] if target.startswith("/") else posixpath.normpath(posixpath.join(folder, target))
        out[r.get("Id", "")] = (full, r.get("Type", "").rsplit("/", 1)[-1])
    return out


def _paragraphs(body) -> str:
    lines = []
    for p in body.iter(f"{_A}p"):
        parts = []
        for e in p.iter():
            if e.tag == f"{_A}t":
                parts.append(e.text or "")
            elif e.tag == f"{_A}br":
                parts.append("\v")
        lines.append("".join(parts))
    return "\n".join(lines)


def _box(e) -> tuple:
    xfrm = next((x for x in e.iter() if x.tag in (f"{_A}xfrm", f"{_P}xfrm")), None)
    off, size = (xfrm.find(f"{_A}off"), xfrm.find(f"{_A}ext")) if xfrm is not None else (None, None)
    number = lambda x, k: int(x.get(k)) if x is not None and (x.get(k) or "").lstrip("-").isdigit() else None
    return number(off, "y"), number(off, "x"), number(size, "cx"), number(size, "cy")


def _holders(z: zipfile.ZipFile, part: str, known: dict) -> tuple[list, str | None]:
    """The placeholders of a layout or master, as (type, index, box), and the part that it inherits from in turn."""
    if part not in known:
        try:
            root, above = ET.fromstring(z.read(part)), next((t for t, kind in _relations(z, part).values() if kind == "slideMaster"), None)
        except KeyError:
            known[part] = ([], None)
            return known[part]
        found = [(ph.get("type", "obj"), ph.get("idx", "0"), _box(e)) for e in root.iter() if e.tag in (f"{_P}sp", f"{_P}pic", f"{_P}graphicFrame") for ph in e.iter(f"{_P}ph")]
        known[part] = (found, above)
    return known[part]


#: What a placeholder's type is called on a master, where it is another.
_ON_MASTER = {"ctrTitle": "title", "subTitle": "body", "obj": "body", "tbl": "body", "chart": "body", "pic": "body"}


def _inherited(z: zipfile.ZipFile, layout: str | None, ph, known: dict) -> tuple:
    """The box of a placeholder that has none of its own: the layout's of the same index, else type; then the master's of its type."""
    kind, index = ph.get("type", "obj"), ph.get("idx", "0")
    part = layout
    for level in range(2):
        if part is None:
            break
        found, above = _holders(z, part, known)
        same = [b for k, i, b in found if i == index and (level == 0)] or [b for k, _, b in found if k == kind] or ([b for k, _, b in found if k == _ON_MASTER.get(kind)] if level else [])
        box = next((b for b in same if b[0] is not None), None)
        if box:
            return box
        part = above
    return None, None, None, None


def parse_deck(path: str, content: bytes, *, need_text: bool = True, need_images: bool = True) -> Iterator[tuple]:
    """The rows of one file, slides in the deck's order."""
    z = zipfile.ZipFile(io.BytesIO(content))
    main = "ppt/presentation.xml"
    root, relations = ET.fromstring(z.read(main)), _relations(z, main)
    size = root.find(f"{_P}sldSz")
    wide, high = (int(size.get("cx", 0)) or None, int(size.get("cy", 0)) or None) if size is not None else (None, None)
    known: dict = {}
    for number, ref in enumerate(root.iter(f"{_P}sldId"), 1):
        part = relations[ref.get(f"{_R}id")][0]
        slide, rels = ET.fromstring(z.read(part)), _relations(z, part)
        notes, layout = None, next((t for t, kind in rels.values() if kind == "slideLayout"), None)
        for target, kind in rels.values():
            if kind == "notesSlide":
                for sp in ET.fromstring(z.read(target)).iter(f"{_P}sp"):
                    ph = next(sp.iter(f"{_P}ph"), None)
                    body = sp.find(f"{_P}txBody")
                    if ph is not None and ph.get("type") == "body" and body is not None:
                        notes = _paragraphs(body)
        tree = slide.find(f"{_P}cSld/{_P}spTree")
        found = 0
        stack = [(tree, (), ())] if tree is not None else []
        while stack:
            group, above, order = stack.pop()
            kids = [e for e in group if e.tag in (f"{_P}sp", f"{_P}pic", f"{_P}grpSp", f"{_P}graphicFrame", f"{_P}cxnSp")]
            for k, e in enumerate(kids):
                top, left, w, h = _box(e)
                here, place = (*above, {"top": top or 0, "left": left or 0, "ord": k}), (*order, k)
                if e.tag == f"{_P}grpSp":
                    stack.append((e, here, place))
                    continue
                ph = next(e.iter(f"{_P}ph"), None)
                if ph is not None and top is None:
                    top, left, w, h = _inherited(z, layout, ph, known)
                    here = (*above, {"top": top or 0, "left": left or 0, "ord": k})
                body, table = e.find(f"{_P}txBody"), next(e.iter(f"{_A}tbl"), None)
                own = e.tag == f"{_P}pic"
                blip = next((b for b in e.iter(f"{_A}blip") if own or e.find(f"{_P}spPr/{_A}blipFill") is not None), None)
                blob = ext = None
                if blip is not None and need_images and blip.get(f"{_R}embed") in rels:
                    target = rels[blip.get(f"{_R}embed")][0]
                    try:
                        blob, ext = z.read(target), target.rsplit(".", 1)[-1].lower()
                    except KeyError:
                        blob = None
                if own:
                    kind = "PICTURE"
                elif table is not None:
                    kind = "TABLE"
                elif e.tag == f"{_P}graphicFrame":
                    kind = "CHART"
                elif e.find(f"{_P}spPr/{_A}custGeom") is not None:
                    kind = "FREEFORM"
                elif ph is not None:
                    kind = "PLACEHOLDER"
                elif e.find(f"{_P}nvSpPr/{_P}cNvSpPr") is not None and e.find(f"{_P}nvSpPr/{_P}cNvSpPr").get("txBox") == "1":
                    kind = "TEXT_BOX"
                else:
                    kind = "AUTO_SHAPE"
                rows = [[_paragraphs(c) for c in r.iter(f"{_A}tc")] for r in table.iter(f"{_A}tr")] if table is not None and need_text else None
                text = _paragraphs(body) if body is not None and need_text else None
                yield path, number, list(here), list(place), kind, None if ph is None else PLACEHOLDERS.get(ph.get("type", "obj"), "OBJECT"), top, left, w, h, text, rows, blob, ext, notes if not found else None, wide, high, None
                found += 1
        if not found:
            yield path, number, None, None, None, None, None, None, None, None, None, None, None, None, notes, wide, high, None


def files(spark: SparkSession, path: str, suffix: str = "pptx") -> DataFrame:
    """``path, content`` of every file below ``path`` with the suffix in any case."""
    anyhow = "".join(f"[{c}{c.upper()}]" for c in suffix)
    return spark.read.format("binaryFile").option("pathGlobFilter", f"*.{anyhow}").option("recursiveFileLookup", "true").load(path).select("path", "content")


def scan(spark: SparkSession, path: str, *, need_text: bool = True, need_images: bool = True) -> DataFrame:
    """Every .pptx below ``path`` as SHAPES; what isn't needed isn't read."""
    return shapes(files(spark, path), need_text=need_text, need_images=need_images)


def slide_counts(decks: DataFrame) -> DataFrame:
    """``path, n_slides`` from the list of slides alone: no slide is parsed; null for files that can't be read."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            out = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    root = ET.fromstring(zipfile.ZipFile(io.BytesIO(bytes(content))).read("ppt/presentation.xml"))
                    out.append((path, sum(1 for _ in root.iter(f"{_P}sldId"))))
                except Exception:
                    out.append((path, None))
            yield pd.DataFrame(out, columns=["path", "n_slides"]).astype({"n_slides": "Int64"})

    return decks.select("path", "content").mapInPandas(run, "path string, n_slides bigint")


def shapes(files: DataFrame, *, need_text: bool = True, need_images: bool = True) -> DataFrame:
    """The same for a frame (also a stream) of path and content."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):  # a deck at a time: pictures are large
                try:
                    rows = list(parse_deck(path, bytes(content), need_text=need_text, need_images=need_images))
                except Exception as e:
                    rows = [(path, *[None] * (len(_NAMES) - 2), f"{type(e).__name__}: {e}")]
                if rows:
                    yield pd.DataFrame(rows, columns=_NAMES).astype({c: "Int64" for c in ("slide_no", "top", "left", "width", "height", "slide_width", "slide_height")})

    return files.mapInPandas(run, SHAPES)
