"""python -m leafwork IN OUT [--format xml|md|routed|whole|pdf|ppt]: converts every file of the format's kind below IN into files below OUT.

Files keep their place below IN.  ``--plug`` names a module that registers backends and may define the models
``figure``, ``page``, ``page_model``, ``deck_model`` and ``match``; figures have a deterministic stub by default.
``--stdout`` prints the one document instead of writing it.
"""

from __future__ import annotations

import argparse
import sys

_SPANS = "page int, block int, line int, span int, text string, x0 double, y0 double, x1 double, y1 double"
_UNITS = "slide_number int, title string, text string, images array<struct<content_type:string,width:int,height:int,image_index:int,blob:binary>>"


def _needed(plug, name: str):
    found = getattr(plug, name, None)
    if found is None:
        raise SystemExit(f"this format needs --plug with a function {name}")
    return found


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="leafwork", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("source")
    p.add_argument("target", nargs="?")
    p.add_argument("--format", choices=("xml", "md", "routed", "whole", "pdf", "ppt"), default="xml")
    p.add_argument("--mode", choices=("auto", "routed"), default="auto", help="of --format routed")
    p.add_argument("--notes", action="store_true", help="with speaker notes")
    p.add_argument("--no-fallback", action="store_true", help="of --format pdf: empty pages aren't rendered")
    p.add_argument("--plug", help="module of backends and models")
    p.add_argument("--stdout", action="store_true")
    a = p.parse_args(args)
    if bool(a.target) == a.stdout:
        p.error("a target folder or --stdout")
    import importlib

    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from leafwork import convert, sinks
    from leafwork.operators import describe
    from leafwork.sources import backends, pptx

    spark = SparkSession.builder.appName("leafwork").getOrCreate()
    plug = importlib.import_module(a.plug) if a.plug else None
    figure, ending = getattr(plug, "figure", describe.stub), {"xml": "xml", "pdf": "xml", "ppt": "xml"}.get(a.format, "md")
    if a.format in ("pdf", "ppt"):
        files = pptx.files(spark, a.source, a.format).select(F.col("path").alias("doc_id"), "content")
    if a.format == "ppt":
        done = convert.ppt_xml(backends.rows_of(files, "ppt", _UNITS), match=_needed(plug, "match"), describer=figure)
    elif a.format == "pdf":
        read = {name: backends.rows_of(files, name, schema) for name, schema in (("pdf_pages", "page int, width double, height double"), ("pdf_spans", _SPANS), ("pdf_images", "page int, idx int, x0 double, y0 double, x1 double, y1 double, w int, h int, ext string, blob binary"))}
        done = convert.pdf_xml(read["pdf_pages"], read["pdf_spans"], read["pdf_images"], files, figure=figure, page=getattr(plug, "page", figure), fallback=not a.no_fallback)
    else:
        shapes = pptx.scan(spark, a.source)
        if a.format == "xml":
            done = convert.deck_xml(shapes, describer=figure, include_notes=a.notes)
        elif a.format == "md":
            done = convert.deck_markdown(shapes, describer=figure, include_notes=a.notes)
        else:
            decks, deck_model = pptx.files(spark, a.source, "pptx"), _needed(plug, "deck_model")
            done = convert.deck_whole(decks, shapes, deck_model=deck_model) if a.format == "whole" else convert.deck_routed(decks, shapes, page_model=_needed(plug, "page_model"), deck_model=deck_model, mode=a.mode)
    body = "xml" if ending == "xml" else "markdown"
    if a.stdout:
        sinks.print_one(done, body)
        return 0
    name = F.concat(F.regexp_replace(sinks.relative("path", a.source), r"(?<=[^/])\.[^./]+$", ""), F.lit(f".{ending}"))
    print(f"{sinks.write_files(done.withColumn('file', name), a.target, 'file', body)} documents written", file=sys.stderr)
    return 0


if __name__ == "__main__":
    sys.exit(main())
