"""Placing figures that lost their slide, by a model's replies, in deck order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def place(figures: DataFrame, slides: DataFrame) -> DataFrame:
    """``doc_id, figure, slide``; figures: doc_id, figure, reply (null: omitted); slides: doc_id, number.

    The sequential rule (not before the figure before, not beyond the last slide, forward to a slide that
    exists) has a closed form: a running maximum, clamped, then the least slide not below it.  Documents without
    slides or without figures have no rows.
    """
    valid = slides.groupBy("doc_id").agg(F.array_sort(F.collect_set("number")).alias("_valid"))
    so_far = F.max("reply").over(Window.partitionBy("doc_id").orderBy("figure").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    clamped = figures.withColumn("_max", so_far).join(valid, "doc_id")
    clamped = clamped.withColumn("_x", F.least(F.greatest(F.element_at("_valid", 1), F.col("_max")), F.element_at("_valid", -1)))
    return clamped.select("doc_id", "figure", F.array_min(F.filter("_valid", lambda n: n >= F.col("_x"))).alias("slide"))


def prompt(slide_lines: DataFrame, figure_lines: DataFrame, cap: int = 600) -> DataFrame:
    """``doc_id, prompt``: the slides' texts (cut at ``cap`` characters) and the figures' descriptions, in order.

    slide_lines: doc_id, number, text; figure_lines: doc_id, figure, description.
    """
    from leafwork.functions.text import or_default
    from leafwork.operators.units import ordered_concat

    line = F.concat(F.lit("Slide "), F.col("number").cast("string"), F.lit(": "), F.substring(F.coalesce("text", F.lit("")), 1, cap))
    s = slide_lines.groupBy("doc_id").agg(ordered_concat(line, "\n", F.col("number")).alias("s"))
    line = F.concat(F.lit("Figure "), F.col("figure").cast("string"), F.lit(": "), or_default("description", "(no description)"))
    f = figure_lines.groupBy("doc_id").agg(ordered_concat(line, "\n", F.col("figure")).alias("f"))
    return s.join(f, "doc_id").select("doc_id", F.concat(F.lit("Slides:\n"), "s", F.lit("\n\nFigures (in deck order):\n"), "f").alias("prompt"))
