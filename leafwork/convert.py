"""Whole conversions: decks, legacy decks and PDFs from their rows to XML or Markdown; the operators put together.

What needs a library that isn't here (rendering, splitting and stitching) comes from ``sources.backends``; it is looked
up in the driver and travels with the job.  Models are plain functions, see ``operators.models``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.config import DEFAULTS, Config
from leafwork.functions import text as T
from leafwork.operators import describe, models, pages, placement, registry, rendering, routing, units
from leafwork.runtime import materialize
from leafwork.sources import backends


def deck_blocks(shapes: DataFrame, *, include_notes: bool = False) -> DataFrame:
    """``doc_id, number, pos, kind, text, blob, ext, digest`` in reading order."""
    good = shapes.where("error IS NULL").withColumn("doc_id", F.col("path")).withColumn("number", F.col("slide_no"))
    ranked = units.tree_order(good.where("sort_path IS NOT NULL"), ["doc_id", "number"])
    notes = good.where("notes IS NOT NULL").select("doc_id", "number", "notes") if include_notes else None
    decode = backends.get("decode", lambda b: None)
    exact = registry.pixel_digest(F.col("blob"), decode) if backends.has("decode") else F.sha1("blob")
    return units.shape_blocks(ranked, ["doc_id", "number"], notes=notes).withColumn("digest", exact)


def _described(shapes: DataFrame, describer: Callable, include_notes: bool) -> tuple[DataFrame, DataFrame]:
    kept = materialize(shapes, "shapes")
    found = registry.register(deck_blocks(kept, include_notes=include_notes), "doc_id", "digest", "number", "pos")
    slides = kept.where("error IS NULL").select(F.col("path").alias("doc_id"), F.col("slide_no").alias("number")).distinct()
    return slides, describe.describe(found, figure=describer)


def _xml(bodies: DataFrame, escape_body: bool = False) -> DataFrame:
    doc = rendering.xml_document(F.lit(1), T.name("doc_id"), F.upper(T.ext_of("doc_id")), F.col("body"), escape_body=escape_body)
    return bodies.select(F.col("doc_id").alias("path"), rendering.xml_file(doc).alias("xml"))


def deck_xml(shapes: DataFrame, *, describer: Callable[[bytes, str], str] = describe.stub, include_notes: bool = False, escape_body: bool = False) -> DataFrame:
    """``path, xml``: each deck as one XML file."""
    slides, blocks = _described(shapes, describer, include_notes)
    parts = blocks.select("doc_id", "number", "pos", rendering.deck_part().alias("part"))
    return _xml(rendering.document_texts(rendering.unit_texts(slides, parts, F.concat(F.lit("Slide "), F.col("number").cast("string")))), escape_body)


def deck_markdown(shapes: DataFrame, *, describer: Callable[[bytes, str], str] = describe.stub, include_notes: bool = True) -> DataFrame:
    """``path, markdown``: each deck as Markdown, pictures described in their place."""
    slides, blocks = _described(shapes, describer, include_notes)
    part = blocks.select("doc_id", "number", "pos", rendering.markdown_part().alias("part"))
    bodies = rendering.document_texts(rendering.unit_texts(slides, part, F.concat(F.lit("## Slide "), F.col("number").cast("string")), DEFAULTS.no_content), rendering.RULE)
    return bodies.select(F.col("doc_id").alias("path"), F.concat("body", F.lit("\n")).alias("markdown"))


def slide_texts(shapes: DataFrame) -> DataFrame:
    """``doc_id, number, body``: all text of a slide in the order of the file, each row of a table a part of its own, the notes last."""
    rows = F.filter(F.transform("rows", lambda r: F.when(F.exists(r, lambda c: T.strip(c) != ""), F.array_join(F.transform(r, T.strip), " | "))), lambda r: r.isNotNull())
    own = F.filter(F.array(T.strip("text")), lambda x: F.coalesce(x != "", F.lit(False)))
    parts = shapes.where("ord_path IS NOT NULL").select("doc_id", "number", F.col("ord_path").alias("_o"), F.posexplode(F.concat(own, F.coalesce(rows, F.array().cast("array<string>")))).alias("_k", "part"))
    notes = shapes.where(T.non_empty("notes")).select("doc_id", "number", F.array(F.lit(2**31 - 1)).alias("_o"), F.lit(0).alias("_k"), F.concat(F.lit("**Speaker notes:** "), T.strip("notes")).alias("part"))
    return parts.unionByName(notes).groupBy("doc_id", "number").agg(units.ordered_concat(F.col("part"), "\n\n", F.col("_o"), F.col("_k")).alias("body"))


def deck_routes(shapes: DataFrame, cfg: Config = DEFAULTS) -> DataFrame:
    """``doc_id, number, route`` of every slide; an empty one is text."""
    sized = shapes.withColumn("area", F.greatest(F.coalesce("slide_width", F.lit(0)), F.lit(1)) * F.greatest(F.coalesce("slide_height", F.lit(0)), F.lit(1)))
    slides = sized.groupBy("doc_id", "number").agg(F.max("area").alias("area"))
    scored = routing.score_slides(sized.where("ord_path IS NOT NULL"), ["doc_id", "number"], cfg)
    known = slides.join(scored, ["doc_id", "number"], "left").fillna({"text_score": 0.0, "pic_area": 0, "graphic_shapes": 0})
    return routing.route(known, "area", cfg).select("doc_id", "number", "route")


def _page_calls(decks: DataFrame, wanted: DataFrame, model: Callable) -> DataFrame:
    """``doc_id, number, body`` of the pages wanted (doc_id, numbers): each deck is rendered once, in one task, and its pages go to the model."""
    to_pdf, split = backends.get("deck_to_pdf"), backends.get("split_pdf")

    def render(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            for key, content, numbers in batch.itertuples(index=False, name=None):
                made = split(to_pdf(bytes(content)), [int(n) for n in numbers])
                yield pd.DataFrame([(key, int(n), made.get(int(n))) for n in numbers], columns=["doc_id", "number", "pdf"])

    rendered = materialize(wanted.join(decks, "doc_id").select("doc_id", "content", "numbers").mapInPandas(render, "doc_id string, number int, pdf binary"), "pages")
    said = models.call(rendered.where("pdf IS NOT NULL"), ["doc_id", "number"], ["pdf"], model, failed="_[vision call failed: {}]_")
    lost = rendered.where("pdf IS NULL").select("doc_id", "number", F.lit("_[slide could not be rendered]_").alias("body"))
    return said.select("doc_id", "number", F.col("text").alias("body")).unionByName(lost)


def deck_routed(files: DataFrame, shapes: DataFrame, *, page_model: Callable[[bytes], str], deck_model: Callable[[bytes], str], mode: str = "auto", cfg: Config = DEFAULTS) -> DataFrame:
    """``path, mode, markdown``: slides by text or by the model, or the whole deck by one call where most slides are visual.

    files: path, content; ``mode`` is auto, routed or whole.  A page's failed call leaves a note in its place; a
    deck's failed call stops the job.
    """
    decks = files.select(F.col("path").alias("doc_id"), "content")
    good = materialize(shapes.where("error IS NULL").withColumn("doc_id", F.col("path")).withColumn("number", F.col("slide_no")), "shapes")
    routes = materialize(deck_routes(good, cfg), "routes")
    chosen = materialize(routing.deck_mode(routes, mode=mode, cfg=cfg, page="number"), "modes")
    routed = routes.join(chosen.where("mode = 'routed'").select("doc_id"), "doc_id", "left_semi")
    wanted = chosen.where("mode = 'routed' AND n_vision > 0").select("doc_id", F.col("vision_pages").alias("numbers"))
    visions = _page_calls(decks, wanted, page_model) if wanted.head() else routes.select("doc_id", "number", F.lit("").alias("body")).where("false")
    merged = routing.merge_routed(routed, slide_texts(good), visions, ["doc_id", "number"], cfg)
    part = F.concat(F.lit("## Slide "), F.col("number").cast("string"), F.lit("  ("), "route", F.lit(")\n\n"), "body")
    by_slide = merged.groupBy("doc_id").agg(F.concat(units.ordered_concat(part, rendering.RULE, F.col("number")), F.lit("\n")).alias("markdown"))
    out = by_slide.select(F.col("doc_id").alias("path"), F.lit("routed").alias("mode"), "markdown")
    whole = chosen.where("mode = 'whole'").select("doc_id")
    if whole.head():
        to_pdf = backends.get("deck_to_pdf")
        said = models.call(whole.join(decks, "doc_id"), ["doc_id"], ["content"], lambda content: deck_model(to_pdf(content)), failed=None)
        out = out.unionByName(said.select(F.col("doc_id").alias("path"), F.lit("whole").alias("mode"), F.concat("text", F.lit("\n")).alias("markdown")))
    return out


def deck_whole(files: DataFrame, shapes: DataFrame, *, deck_model: Callable[[bytes], str]) -> DataFrame:
    """``path, mode, markdown`` with one call a deck."""
    return deck_routed(files, shapes, page_model=deck_model, deck_model=deck_model, mode="whole")


def ppt_xml(ppt_units: DataFrame, *, match: Callable[[str], str], describer: Callable[[bytes, str], str] = describe.stub, cfg: Config = DEFAULTS) -> DataFrame:
    """``path, xml`` of legacy decks: doc_id, slide_number, title, text, images (content_type, width, height, image_index, blob).

    Pictures of no raster type, small ones and empty ones are left out; the others are numbered by their own index,
    described, and put at the end of the slide that ``match`` names in its reply to the prompt (a JSON object, maybe in
    a code fence), with a label that says that the place is approximate.  A reply that isn't JSON stops the job.
    """
    u = materialize(ppt_units.withColumn("number", F.col("slide_number")), "ppt_units")
    text = F.filter(F.array(T.strip("title"), T.strip("text")), lambda x: F.coalesce(x != "", F.lit(False)))
    texts = u.select("doc_id", "number", F.posexplode(text).alias("_p", "text")).select("doc_id", "number", (F.col("_p") + 1).cast("long").alias("pos"), F.lit("text").alias("kind"), "text")
    i = u.select("doc_id", "number", F.posexplode("images").alias("_at", "i")).select("doc_id", "number", "_at", "i.*").withColumn("ext", T.ext_from_mime("content_type"))
    w, h = F.coalesce("width", F.lit(0)), F.coalesce("height", F.lit(0))
    small = (w != 0) & (h != 0) & (F.least(w, h) < cfg.min_image_dim)
    kept = i.where(F.col("ext").isNotNull() & ~small & (F.octet_length("blob") > 0)).withColumn("digest", F.sha1("blob")).withColumn("_index", F.coalesce("image_index", F.lit(0)))
    found = registry.register(kept, "doc_id", "digest", "_index", "number", "_at")
    unique = registry.unique(found, "doc_id", "digest", ["blob", "ext"], "_index", "number", "_at")
    told = materialize(describe.describe(unique, figure=describer).select("doc_id", F.col("image_id").alias("figure"), "digest", "description"), "told")
    lines = u.select("doc_id", "number").join(texts.groupBy("doc_id", "number").agg(units.ordered_concat(F.col("text"), " ", F.col("pos")).alias("text")), ["doc_id", "number"], "left")
    said = models.call(placement.prompt(lines, told, cfg.placement_text_cap), ["doc_id"], ["prompt"], match, failed=None)
    reply = F.parse_json(T.strip_fence("text"))
    answers = told.join(said.select("doc_id", reply.alias("_reply")), "doc_id").select("doc_id", "figure", F.explode_outer(F.map_entries(F.variant_get("_reply", "$", "map<string,variant>"))).alias("e"))
    answers = answers.where(F.col("e.key") == F.col("figure").cast("string")).select("doc_id", "figure", F.try_variant_get("e.value", "$", "int").alias("reply"))
    placed = placement.place(told.join(answers, ["doc_id", "figure"], "left").select("doc_id", "figure", "reply"), u.select("doc_id", "number"))
    at_end = placed.join(told, ["doc_id", "figure"]).select("doc_id", F.col("slide").alias("number"), (F.col("figure") + 1_000_000).alias("pos"), F.lit("image").alias("kind"), F.lit(None).cast("string").alias("text"), F.col("figure").alias("image_id"), "description")
    blocks = texts.select("*", F.lit(None).cast("long").alias("image_id"), F.lit(None).cast("string").alias("description")).unionByName(at_end)
    parts = blocks.select("doc_id", "number", "pos", rendering.deck_part(F.lit(True)).alias("part"))
    return _xml(rendering.document_texts(rendering.unit_texts(u.select("doc_id", "number").distinct(), parts, F.concat(F.lit("Slide "), F.col("number").cast("string")))))


def span_texts(spans: DataFrame) -> DataFrame:
    """``doc_id, page, idx, x0, y0, text`` of text blocks: spans joined as they are, lines stripped, empty ones dropped."""
    line = spans.groupBy("doc_id", "page", "block", "line").agg(units.ordered_concat(F.col("text"), "", F.col("span")).alias("_l"), F.min("x0").alias("x0"), F.min("y0").alias("y0"))
    block = line.withColumn("_l", F.nullif(T.strip("_l"), F.lit(""))).groupBy("doc_id", "page", "block").agg(units.ordered_concat(F.col("_l"), "\n", F.col("line")).alias("text"), F.min("x0").alias("x0"), F.min("y0").alias("y0"))
    return block.where("text <> ''").select("doc_id", "page", F.col("block").alias("idx"), "x0", "y0", "text")


def pdf_xml(pdf_pages: DataFrame, spans: DataFrame, images: DataFrame, files: DataFrame, *, figure: Callable = describe.stub, page: Callable = describe.stub, fallback: bool = True, cfg: Config = DEFAULTS) -> DataFrame:
    """``path, xml`` of PDFs from their pages, text spans and pictures; files: doc_id, content, for pages taken as a whole.

    Pictures cut by a page break are stitched, whole pages rendered (both by backends, only where there are any).
    """
    texts, pics = materialize(span_texts(spans), "texts"), materialize(images.where(F.octet_length("blob") > 0), "pictures")
    items = materialize(pages.assemble(pdf_pages, texts, pics, cfg, fallback=fallback), "items")
    part = items.select("doc_id", F.col("page").alias("number"), "pos", "kind", F.col("ref").cast("int").alias("idx"))
    said = part.where("kind = 'text'").join(texts.select("doc_id", F.col("page").alias("number"), "idx", "text"), ["doc_id", "number", "idx"])
    blank = F.lit(None).cast("binary")
    picture = lambda df, kind: df.select("doc_id", "number", "pos", F.lit(kind).alias("image_kind"), "blob", "ext")
    own = pics.select("doc_id", F.col("page").alias("number"), "idx", "blob", "ext")
    found = picture(part.where("kind = 'figure'").join(own, ["doc_id", "number", "idx"]), "figure")
    if part.where("kind = 'stitched'").head():
        stitch = F.pandas_udf(_pairwise(backends.get("stitch")), "binary", F.PandasUDFType.SCALAR)
        flat = pics.join(pages.classify(pdf_pages, texts, pics, cfg).where("NOT scanned").select("doc_id", "page"), ["doc_id", "page"])
        both = pages.consume(pages.split_pairs(flat, pdf_pages, cfg))
        halves = both.join(own.select("doc_id", F.col("number").alias("n"), F.col("idx").alias("i"), F.col("blob").alias("_top")), ["doc_id", "n", "i"]).join(own.select("doc_id", F.col("number").alias("m"), F.col("idx").alias("j"), F.col("blob").alias("_bottom")), ["doc_id", "m", "j"])
        made = halves.select("doc_id", F.col("n").alias("number"), F.col("i").alias("idx"), stitch("_top", "_bottom").alias("blob"), F.lit("png").alias("ext"))
        found = found.unionByName(picture(part.where("kind = 'stitched'").join(made, ["doc_id", "number", "idx"]), "figure"))
    if part.where("kind = 'page'").head():
        render = F.pandas_udf(_pairwise(backends.get("render_page")), "binary", F.PandasUDFType.SCALAR)
        drawn = part.where("kind = 'page'").join(files.select("doc_id", "content"), "doc_id").select("doc_id", "number", "pos", render("content", "number").alias("blob"), F.lit("png").alias("ext"))
        found = found.unionByName(picture(drawn, "page"))
    seen = registry.register(materialize(found.withColumn("digest", F.sha2("blob", 256)), "found"), "doc_id", "digest", "number", "pos")
    first = registry.unique(seen, "doc_id", "digest", ["blob", "ext", "image_kind"], "number", "pos")  # a picture keeps the kind it came with first
    told = describe.describe(first, figure=figure, page=page, kind="image_kind").select("doc_id", "image_id", "image_kind", "description", F.octet_length("blob").cast("string").alias("size_bytes"))
    shown = seen.select("doc_id", "number", "pos", "digest", "image_id").join(told, ["doc_id", "image_id"])
    none = F.lit(None).cast("string")
    blocks = said.select("doc_id", "number", "pos", F.lit("text").alias("kind"), "text", F.lit(None).cast("long").alias("image_id"), none.alias("digest"), none.alias("size_bytes"), none.alias("image_kind"), none.alias("description"))
    blocks = blocks.unionByName(shown.select("doc_id", "number", "pos", F.lit("image").alias("kind"), none.alias("text"), "image_id", "digest", "size_bytes", "image_kind", "description"))
    parts = blocks.select("doc_id", "number", "pos", rendering.page_part().alias("part"))
    every = pdf_pages.select("doc_id", F.col("page").alias("number")).distinct()
    return _xml(rendering.document_texts(rendering.unit_texts(every, parts, F.concat(F.lit("Page "), F.col("number").cast("string")))))


def _pairwise(function: Callable) -> Callable:
    import pandas as pd

    def run(a, b):
        return pd.Series([function(bytes(x), bytes(y) if isinstance(y, (bytes, bytearray, memoryview)) else int(y)) for x, y in zip(a, b, strict=True)])

    return run


def collection_xml(documents: DataFrame, order: list[str]) -> DataFrame:
    """One ``xml`` of all documents (filename, data_type, body), numbered by ``order``: it is one string, so they have to fit one task."""
    rows = F.array_sort(F.collect_list(F.struct(*[F.col(c).alias(f"o{k}") for k, c in enumerate(order)], "filename", "data_type", "body")))
    inner = F.transform(F.col("_rows"), lambda r, k: rendering.xml_document(k + 1, r["filename"], r["data_type"], r["body"]))
    return documents.agg(rows.alias("_rows")).select(rendering.xml_file(F.array_join(inner, "")).alias("xml"))
