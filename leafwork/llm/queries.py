"""Queries of the operators for training data, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafwork.llm import contamination, mixing, residue, scan_repair, splitter, stuffing, truncation
from leafwork.runtime import materialize, table


IMAGE = ["doc_id", "image_id"]


def _truncated(spark, root):
    """The truncated descriptions that aren't residue."""
    images = table(spark, root, "images")
    cut = materialize(truncation.find_truncated(images, IMAGE, "description"), "cut")
    return cut.join(residue.detect_residue(images, IMAGE, "description", within=cut), IMAGE, "left_anti")


def p1_found(spark, root):
    return _truncated(spark, root).select("doc_id", F.col("image_id").cast("long").alias("image_id"))


def p1_rates(spark, root):
    """For each describer the share of its descriptions that were cut."""
    return truncation.rates(table(spark, root, "images"), IMAGE, "description", "describer", _truncated(spark, root))


TEXT = ["table_name", "doc_id", "item_id"]


def _scanned(spark, root):
    return scan_repair.scanned_texts(table(spark, root, "images"), table(spark, root, "layout_kids"))


def p2_found(spark, root):
    return scan_repair.find_scan_noise(_scanned(spark, root), TEXT)


def p2_repaired(spark, root):
    """Each noisy text as continuous paragraphs."""
    return scan_repair.repair(_scanned(spark, root), TEXT)


def p3_found(spark, root):
    return residue.detect_residue(table(spark, root, "images"), IMAGE, "description").select("doc_id", F.col("image_id").cast("long").alias("image_id"))


def p3_kinds(spark, root):
    """How many records of each describer are residue, by kind."""
    images = table(spark, root, "images")
    cases = residue.detect_residue(images, IMAGE, "description").select("doc_id", "image_id", F.explode("kinds").alias("kind"))
    who = images.groupBy("doc_id", "image_id").agg(F.max("describer").alias("describer"))
    return cases.join(who, ["doc_id", "image_id"]).groupBy("describer", "kind").agg(F.count(F.lit(1)).alias("records"))


def p3_kept(spark, root):
    """The descriptions that stay: content, and no residue."""
    images = table(spark, root, "images")
    cases = residue.detect_residue(images, IMAGE, "description").select("doc_id", "image_id")
    kept = images.where(residue.has_content(F.col("description"))).groupBy("doc_id", "image_id").agg(F.max("description").alias("description"))
    return kept.join(cases, ["doc_id", "image_id"], "left_anti")


def _pieces(spark, root):
    return splitter.oversized_pieces(*(table(spark, root, t) for t in ("layout_kids", "page_units", "size_limits")))


def p4_found(spark, root):
    return _pieces(spark, root).where("piece_no = 0").select("table_name", "doc_id", "item_id")


def p4_pieces(spark, root):
    return _pieces(spark, root)


_P4_SQL = """
WITH items AS (
  SELECT 'layout_kids' AS table_name, doc_id, CAST(id AS BIGINT) AS item_id, content AS body FROM layout_kids
  UNION ALL
  SELECT 'page_units', doc_id, CAST(number AS BIGINT),
         array_to_string(list_transform(list_filter(blocks, lambda b: b.kind = 'text' AND length(b.text) > 0), lambda b: b.text), chr(10) || chr(10))
  FROM page_units
)
SELECT DISTINCT i.table_name, i.doc_id, i.item_id FROM items i JOIN size_limits s USING (table_name) WHERE length(i.body) > s.max_chars
"""


def p6_found(spark, root):
    return contamination.find_leaks(table(spark, root, "documents"), table(spark, root, "eval_items")).select("doc_id", "item_id").distinct()


def p6_items(spark, root):
    """Every test item: whether it leaked, into how many documents, and how much of it."""
    items = table(spark, root, "eval_items")
    return contamination.leaked_items(contamination.find_leaks(table(spark, root, "documents"), items), items)


def p6_removed(spark, root):
    """The documents with leaks, with the passages cut out; null where too little would be left."""
    documents = table(spark, root, "documents")
    return contamination.without_leaks(documents, contamination.find_leaks(documents, table(spark, root, "eval_items"), spans=True))


def p7_mixture(spark, root):
    """How many copies of which document the mixture has."""
    return mixing.mix(table(spark, root, "documents"), table(spark, root, "mix_targets"))[0]


def p7_shares(spark, root):
    """Target and actual shares of the sources."""
    targets = table(spark, root, "mix_targets")
    return mixing.shares(*mixing.mix(table(spark, root, "documents"), targets), targets)


def p8_found(spark, root):
    return stuffing.find_stuffed(table(spark, root, "documents"))


def p8_parts(spark, root):
    """The stuffed messages and added texts with their share, words, links and number of shapes."""
    return stuffing.stuffed_parts(table(spark, root, "documents"))


QUERIES = {
    "p1_found": (p1_found, None),
    "p1_rates": (p1_rates, None),
    "p2_found": (p2_found, None),
    "p2_repaired": (p2_repaired, None),
    "p3_found": (p3_found, None),
    "p3_kinds": (p3_kinds, None),
    "p3_kept": (p3_kept, None),
    "p4_found": (p4_found, _P4_SQL),
    "p4_pieces": (p4_pieces, None),
    "p6_found": (p6_found, None),
    "p6_items": (p6_items, None),
    "p6_removed": (p6_removed, None),
    "p7_mixture": (p7_mixture, None),
    "p7_shares": (p7_shares, None),
    "p8_found": (p8_found, None),
    "p8_parts": (p8_parts, None),
}
