"""Routing slides to text extraction or to vision, and decks to one call or many."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.config import DEFAULTS, Config
from leafwork.functions import text as T


def score_slides(shapes: DataFrame, keys: list[str], cfg: Config = DEFAULTS) -> DataFrame:
    """``keys, text_score, pic_area, graphic_shapes`` from leaf shapes: shape_type, ph_type, text, width, height.

    Pictures give area, pictures and vector shapes count as graphics, text of anything but a picture, table or
    chart is scored by weight and capped words.
    """
    picture = F.coalesce(F.col("shape_type") == "PICTURE", F.lit(False))
    vector = F.coalesce(F.col("shape_type").isin("FREEFORM", "AUTO_SHAPE"), F.lit(False))
    native = F.coalesce(F.col("shape_type").isin("TABLE", "CHART"), F.lit(False))
    area = F.coalesce("width", F.lit(0)).cast("long") * F.coalesce("height", F.lit(0)).cast("long")
    tenths = T.weight_tenths("ph_type") * T.capped_word_count("text", cfg.word_cap)
    return shapes.groupBy(*keys).agg(
        (F.sum(F.when(~picture & ~native, tenths).otherwise(0)) / 10.0).alias("text_score"),
        F.sum(F.when(picture, area).otherwise(0)).alias("pic_area"),
        F.count_if(picture | vector).alias("graphic_shapes"),
    )


def route(scored: DataFrame, slide_area: str, cfg: Config = DEFAULTS) -> DataFrame:
    """``scored`` with ``pic_fraction`` (0 for an area of 0) and ``route``, text or vision; the rules in this order."""
    fraction = F.when(F.col(slide_area) != 0, F.col("pic_area") / F.col(slide_area)).otherwise(0.0)
    kind = (
        F.when((F.col("pic_fraction") > cfg.vision_pic_fraction) & (F.col("text_score") < cfg.vision_text_below), "vision")
        .when((F.col("text_score") < cfg.sparse_text) & (F.col("pic_fraction") > cfg.sparse_pic_fraction), "vision")
        .when(F.col("graphic_shapes") >= cfg.vision_graphic_shapes, "vision")
        .otherwise("text")
    )
    return scored.withColumn("pic_fraction", F.coalesce(fraction, F.lit(0.0))).withColumn("route", kind)


def deck_mode(routes: DataFrame, doc: str = "doc_id", mode: str = "auto", cfg: Config = DEFAULTS, *, page: str = "page_number") -> DataFrame:
    """``doc, n_slides, n_vision, vision_pages, vision_fraction, mode``: whole or routed; the pages (``page``) are sorted, null ones are left out."""
    seen = F.col("route") == "vision"
    by = routes.groupBy(doc).agg(F.count(F.lit(1)).alias("n_slides"), F.count_if(seen).alias("n_vision"), F.array_sort(F.collect_list(F.when(seen, F.col(page)))).alias("vision_pages"))
    by = by.withColumn("vision_fraction", F.col("n_vision") / F.col("n_slides"))
    whole = F.lit(mode == "whole") | (F.lit(mode == "auto") & (F.col("n_vision") > 0) & (F.col("vision_fraction") >= cfg.vision_deck_fraction))
    return by.withColumn("mode", F.when(whole, "whole").otherwise("routed"))


def merge_routed(routes: DataFrame, texts: DataFrame, visions: DataFrame, keys: list[str], cfg: Config = DEFAULTS) -> DataFrame:
    """``keys, route, body``: the text of text slides, the vision text of the others, or the marker for none.

    The two kinds of rows are split before they are joined, so neither side is computed for the other's slides.
    """
    text = routes.where("route = 'text'").join(texts, keys, "left")
    vision = routes.where("route = 'vision'").join(visions, keys, "left")
    return text.select(*keys, "route", "body").unionByName(vision.select(*keys, "route", "body")).withColumn("body", T.strip(T.or_default("body", cfg.no_content)))
