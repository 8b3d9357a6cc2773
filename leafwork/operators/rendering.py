"""Documents as XML or Markdown: ordered concatenation of blocks into units and of units into documents.

Bodies aren't escaped by default, attributes are; ``escape_body`` makes well-formed XML.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwork.config import DEFAULTS, Config
from leafwork.functions import text as T
from leafwork.operators.units import ordered_concat

BLANK, RULE = "\n\n", "\n\n---\n\n"


def splice(blocks: DataFrame, images: DataFrame, keep: list[str]) -> DataFrame:
    """Blocks with the attributes ``keep`` of their image; every block stays, and a missing image gives nulls."""
    return blocks.join(images.select("doc_id", "image_id", *keep), ["doc_id", "image_id"], "left")


def deck_part(approximate: Column | None = None, cfg: Config = DEFAULTS) -> Column:
    label = F.concat(F.lit("[Image "), F.col("image_id").cast("string"), F.when(approximate, " (approximate slide)").otherwise("") if approximate is not None else F.lit(""), F.lit("]\n"))
    return F.when(F.col("kind") == "text", F.col("text")).otherwise(F.concat(label, T.or_default("description", cfg.no_description)))


def page_part(cfg: Config = DEFAULTS) -> Column:
    described = T.or_default("description", cfg.no_description)
    figure = F.concat(F.lit('<image id="'), F.col("image_id").cast("string"), F.lit('" sha256="'), F.coalesce("digest", F.lit("")), F.lit('" size_bytes="'), F.coalesce("size_bytes", F.lit("")), F.lit('">'), described, F.lit("</image>"))
    return F.when(F.col("kind") == "text", F.col("text")).when(F.col("image_kind") == "page", described).otherwise(figure)


def markdown_part(cfg: Config = DEFAULTS) -> Column:
    image = F.concat(F.lit("**[Image "), F.col("image_id").cast("string"), F.lit("]**\n\n"), T.or_default("description", cfg.no_md_description))
    return F.when(F.col("kind") == "text", F.col("text")).otherwise(image)


def unit_texts(units: DataFrame, parts: DataFrame, heading: Column, empty: str | None = None) -> DataFrame:
    """``doc_id, number, body``: heading and parts, blank lines between; units without parts have the heading only.

    parts: doc_id, number, pos, part; ``empty`` stands where a unit has no parts.
    """
    joined = parts.where("part IS NOT NULL").groupBy("doc_id", "number").agg(ordered_concat(F.col("part"), BLANK, F.col("pos")).alias("_parts"))
    out = units.join(joined, ["doc_id", "number"], "left")
    return out.select("doc_id", "number", F.concat_ws(BLANK, heading, F.coalesce("_parts", F.lit(empty))).alias("body"))


def document_texts(unit_rows: DataFrame, sep: str = BLANK) -> DataFrame:
    return unit_rows.groupBy("doc_id").agg(ordered_concat(F.col("body"), sep, F.col("number")).alias("body"))


def xml_document(index: Column, filename: Column, data_type: Column, body: Column, *, escape_body: bool = False) -> Column:
    inner = T.xml_attr(body) if escape_body else body
    return F.concat(
        F.lit('  <document index="'), index.cast("string"), F.lit('" filename="'), T.xml_attr(F.coalesce(filename, F.lit(""))), F.lit('" data-type="'), T.xml_attr(F.coalesce(data_type, F.lit(""))), F.lit('">\n'), inner, F.lit("\n  </document>\n")
    )


def xml_file(document: Column) -> Column:
    return F.concat(F.lit("<documents>\n"), document, F.lit("</documents>\n"))


def layout_markdown(kids: DataFrame, *order: str) -> DataFrame:
    """``doc_id, markdown`` from layout elements: headings by level, images as links numbered in order, other content as it is."""
    from pyspark.sql import Window

    number = F.sum(F.when(F.col("type") == "image", 1).otherwise(0)).over(Window.partitionBy("doc_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    line = (
        F.when(F.col("type") == "image", F.concat(F.lit("![image "), F.col("_n").cast("string"), F.lit("](<"), F.coalesce("source", F.lit("")), F.lit(">)")))
        .when((F.col("type") == "heading") & T.non_empty("content"), F.concat(F.repeat(F.lit("#"), F.coalesce("heading_level", F.lit(1))), F.lit(" "), F.col("content")))
        .when(T.non_empty("content"), F.col("content"))
    )
    return kids.withColumn("_n", number).withColumn("_line", line).groupBy("doc_id").agg(F.concat(ordered_concat(F.col("_line"), BLANK, *map(F.col, order)), F.lit("\n")).alias("markdown"))
