"""Queries of the nested-record operator over ``layout_json``."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafwork.operators import nested
from leafwork.runtime import table


def p5_found(spark, root):
    rows = nested.shred(table(spark, root, "layout_json"), "layout_id", "raw", with_top=False, attributes=False)
    return rows.select("layout_id", "elem_path", "parent_path")


def p5_elements(spark, root):
    """Each occurrence with the identity of its object and the four attributes that downstream tables join on."""
    rows = nested.shred(table(spark, root, "layout_json"), "layout_id", "raw")
    four = [nested.attribute("attrs", n).alias(a) for n, a in (("type", "elem_type"), ("id", "elem_id"), ("level", "elem_level"), ("content", "content"))]
    return rows.select("layout_id", "elem_path", "parent_path", "field", "ordinal", "depth", "object_hash", "parent_hash", *four)


def p5_attributes(spark, root):
    """Every scalar attribute of every distinct object."""
    rows = nested.objects(nested.shred(table(spark, root, "layout_json"), "layout_id", "raw"))
    return rows.select("object_hash", "occurrences", F.explode("attrs").alias("a")).select("object_hash", "occurrences", "a.name", "a.pos", "a.kind", "a.value")


def p5_objects(spark, root):
    """Each distinct object once, with how often it occurs."""
    rows = nested.shred(table(spark, root, "layout_json"), "layout_id", "raw", attributes=False)
    return rows.groupBy("object_hash").agg(F.count(F.lit(1)).alias("occurrences"), F.count_distinct("layout_id").alias("records"))


def p5_bridge(spark, root):
    """The distinct parent-child links."""
    return nested.bridge(nested.shred(table(spark, root, "layout_json"), "layout_id", "raw", attributes=False))


_WALK = """
WITH RECURSIVE walk(layout_id, elem_path, up, val) AS (
  SELECT layout_id, '' AS elem_path, '' AS up, raw::JSON AS val FROM layout_json
  WHERE raw IS NOT NULL AND raw <> '' AND json_valid(raw) AND json_type(raw) = 'OBJECT'
  UNION ALL
  SELECT w.layout_id, CASE WHEN w.elem_path = '' THEN e.key ELSE w.elem_path || '/' || e.key END,
         CASE WHEN json_type(w.val) = 'OBJECT' THEN w.elem_path ELSE w.up END, e.value
  FROM walk w, json_each(w.val) e WHERE json_type(e.value) IN ('OBJECT', 'ARRAY')
)
"""

#: The same with the top level and, for each object, its field, its place in the innermost array and its depth.
_WALK_ALL = """
WITH RECURSIVE walk(layout_id, elem_path, up, val, field, ordinal, depth) AS (
  SELECT layout_id, '' AS elem_path, NULL::VARCHAR AS up, raw::JSON AS val, NULL::VARCHAR AS field, NULL::INT AS ordinal, 0 AS depth FROM layout_json
  WHERE raw IS NOT NULL AND raw <> '' AND json_valid(raw) AND json_type(raw) = 'OBJECT'
  UNION ALL
  SELECT w.layout_id, CASE WHEN w.elem_path = '' THEN e.key ELSE w.elem_path || '/' || e.key END,
         CASE WHEN json_type(w.val) = 'OBJECT' THEN w.elem_path ELSE w.up END, e.value,
         CASE WHEN json_type(w.val) = 'OBJECT' THEN e.key ELSE w.field END, CASE WHEN json_type(w.val) = 'OBJECT' THEN NULL ELSE CAST(e.key AS INT) END,
         CASE WHEN json_type(e.value) = 'OBJECT' THEN w.depth + 1 ELSE w.depth END
  FROM walk w, json_each(w.val) e WHERE json_type(e.value) IN ('OBJECT', 'ARRAY')
)
"""


def p5_children(spark, root):
    """Each object, the top level too, with its field, ordinal and depth, the number of its children, and the four attributes where they are texts."""
    rows = nested.shred(table(spark, root, "layout_json"), "layout_id", "raw")
    text = lambda n: F.get(F.filter("attrs", lambda a: (a["name"] == n) & (a["kind"] == "string")), F.lit(0))["value"]
    own = rows.select("layout_id", "elem_path", "parent_path", "field", "ordinal", "depth", text("type").alias("elem_type"), text("content").alias("content"))
    kids = rows.where("parent_path IS NOT NULL").groupBy("layout_id", F.col("parent_path").alias("elem_path")).agg(F.count(F.lit(1)).alias("n_children"))
    return own.join(kids, ["layout_id", "elem_path"], "left").fillna(0, ["n_children"])


def p5_totals(spark, root):
    """Objects, distinct objects stored, and links kept, over all records: what storing identical objects once leaves."""
    rows = nested.shred(table(spark, root, "layout_json"), "layout_id", "raw", attributes=False)
    return rows.agg(F.count(F.lit(1)).alias("occurrences"), F.count("parent_path").alias("links"), F.count_distinct("layout_id").alias("records"))


QUERIES = {
    "p5_found": (p5_found, _WALK + "SELECT layout_id, elem_path, up AS parent_path FROM walk WHERE elem_path <> '' AND json_type(val) = 'OBJECT'"),
    "p5_elements": (p5_elements, None),
    "p5_attributes": (p5_attributes, None),
    "p5_objects": (p5_objects, None),
    "p5_bridge": (p5_bridge, None),
    "p5_children": (p5_children, _WALK_ALL + ", o AS (SELECT * FROM walk WHERE json_type(val) = 'OBJECT'), k AS (SELECT layout_id, up AS elem_path, count(*) AS n_children FROM o WHERE up IS NOT NULL GROUP BY 1, 2) SELECT o.layout_id, o.elem_path, o.up AS parent_path, o.field, o.ordinal, o.depth, CASE WHEN json_type(o.val, '$.type') = 'VARCHAR' THEN json_extract_string(o.val, '$.type') END AS elem_type, CASE WHEN json_type(o.val, '$.content') = 'VARCHAR' THEN json_extract_string(o.val, '$.content') END AS content, coalesce(k.n_children, 0) AS n_children FROM o LEFT JOIN k ON k.layout_id = o.layout_id AND k.elem_path = o.elem_path"),
    "p5_totals": (p5_totals, _WALK_ALL + "SELECT count(*) AS occurrences, count(up) AS links, count(DISTINCT layout_id) AS records FROM walk WHERE json_type(val) = 'OBJECT'"),
}
