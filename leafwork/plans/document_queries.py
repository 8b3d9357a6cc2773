"""The document operators over the driver's tables, each with the same query in SQL.

Decks are ``decks``, pages and slides ``page_units`` with their blocks, pictures ``images``, shapes and page geometry
``layout_kids`` (a page of 500 x 630 points, y upward), calls of a model ``events``.  Every query reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwork.functions import text as T
from leafwork.operators import measure, pages, placement, registry, rendering, routing, units
from leafwork.runtime import materialize, table

WIDTH, HEIGHT = 500.0, 630.0


# --- tables as the operators take them ------------------------------------------------------------
def _decks(s: SparkSession, d: str) -> DataFrame:
    return units.latest(table(s, d, "decks"), ["doc_id"], "scanned_at", ["filename", "data_type", "number_of_pages"])


def _units(s, d):
    return units.units(table(s, d, "page_units"))


def _images(s, d, *columns):
    """The latest delivery of each picture with the columns named, and no other is read."""
    return units.latest(table(s, d, "images").withColumnRenamed("kind", "image_kind"), ["doc_id", "image_id"], "loaded_at", list(columns))


def _kids(s, d, *columns):
    return units.latest(table(s, d, "layout_kids"), ["doc_id", "id"], "loaded_at", list(columns))


def _blocks(s, d):
    return units.blocks(_units(s, d))


def _boxes(s, d):
    """layout_kids with whole-number boxes, y downward; elements without a full box have none."""
    k = _kids(s, d, "type", "level", "content", "page_number", "bounding_box")
    at = lambda i: F.floor(F.get("bounding_box", F.lit(i))).cast("long")
    return k.select("doc_id", "id", "type", "level", "content", "page_number", at(0).alias("bx0"), at(1).alias("by0"), at(2).alias("bx1"), at(3).alias("by1"))


def _elements(s, d):
    """What the page geometry needs of layout_kids, de-duplicated once and written: narrow rows, y downward."""
    b = _boxes(s, d).where("page_number IS NOT NULL")
    text = F.when((F.coalesce("type", F.lit("")) != "image") & T.non_empty("content"), T.stripped_lines("content"))
    return materialize(b.select("doc_id", F.col("page_number").alias("page"), "id", text.alias("text"), "bx0", "by0", "bx1", "by1"), "elements")


def _pictures_of(elements):
    """Every element with a full box as a picture, y downward, on a coarse grid so that edges meet; idx is the order in the page."""
    from pyspark.sql import Window

    b = elements.where("bx0 IS NOT NULL AND by0 IS NOT NULL AND bx1 IS NOT NULL AND by1 IS NOT NULL")
    b = b.withColumns({"bx0": F.col("bx0") - F.col("bx0") % 100, "by0": F.col("by0") - F.col("by0") % 63, "bx1": F.col("bx1") - F.col("bx1") % 100, "by1": F.col("by1") - F.col("by1") % 63 + 63})
    idx = F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("id")) - 1
    return b.select("doc_id", "page", idx.alias("idx"), F.col("bx0").cast("double").alias("x0"), (F.lit(HEIGHT) - F.col("by1")).alias("y0"), F.col("bx1").cast("double").alias("x1"), (F.lit(HEIGHT) - F.col("by0")).alias("y1"), (F.col("bx1") - F.col("bx0")).alias("w"), ((F.col("by1") - F.col("by0")) * 3).alias("h"))


def _geometry(s, d):
    """(pages, texts, pictures), all from one written table; the numbered pictures are written too, as three joins read them."""
    e = _elements(s, d)
    pages_ = e.select("doc_id", "page").distinct().select("doc_id", "page", F.lit(WIDTH).alias("width"), F.lit(HEIGHT).alias("height"))
    texts = e.where("text IS NOT NULL").select("doc_id", "page", F.col("id").alias("idx"), F.coalesce(F.col("bx0"), F.lit(0)).cast("double").alias("x0"), (F.lit(HEIGHT) - F.coalesce("by1", F.lit(0))).alias("y0"), "text")
    return pages_, texts, materialize(_pictures_of(e), "pictures")


_STRIP = r"regexp_replace(regexp_replace({0}, '^[\s\x1c-\x1f\x85\p{{Z}}]+', ''), '[\s\x1c-\x1f\x85\p{{Z}}]+$', '')"


def _strip(x: str) -> str:
    return _STRIP.format(x)


SQL_UNITS = "units AS (SELECT doc_id, number, arg_max(unit_kind, scanned_at) AS unit_kind, arg_max(blocks, scanned_at) AS blocks FROM page_units GROUP BY doc_id, number)"
SQL_BLOCKS = SQL_UNITS + ", blocks AS (SELECT u.doc_id, u.number, g.i AS pos, u.blocks[g.i].kind AS kind, u.blocks[g.i].text AS text, u.blocks[g.i].image_id AS image_id FROM units u, LATERAL (SELECT unnest(range(1, len(u.blocks) + 1)) AS i) g)"
SQL_IMAGES = "pics AS (SELECT doc_id, image_id, arg_max(digest, loaded_at) AS digest, arg_max(ext, loaded_at) AS ext, arg_max(kind, loaded_at) AS image_kind, arg_max(size_bytes, loaded_at) AS size_bytes, arg_max(blob, loaded_at) AS blob, arg_max(describer, loaded_at) AS describer, arg_max(description, loaded_at) AS description FROM images GROUP BY doc_id, image_id)"
SQL_DECKS = "deck AS (SELECT doc_id, arg_max(filename, scanned_at) AS filename, arg_max(data_type, scanned_at) AS data_type, arg_max(slide_width, scanned_at) AS slide_width, arg_max(slide_height, scanned_at) AS slide_height, arg_max(number_of_pages, scanned_at) AS number_of_pages FROM decks GROUP BY doc_id)"
SQL_KIDS = "kids AS (SELECT doc_id, id, arg_max(type, loaded_at) AS type, arg_max(level, loaded_at) AS level, arg_max(heading_level, loaded_at) AS heading_level, arg_max(page_number, loaded_at) AS page_number, arg_max(bounding_box, loaded_at) AS box, arg_max(content, loaded_at) AS content, arg_max(source, loaded_at) AS source, arg_max(linked_content_id, loaded_at) AS linked_content_id FROM layout_kids GROUP BY doc_id, id)"
SQL_BOXES = SQL_KIDS + ", boxes AS (SELECT *, CAST(floor(box[1]) AS BIGINT) AS bx0, CAST(floor(box[2]) AS BIGINT) AS by0, CAST(floor(box[3]) AS BIGINT) AS bx1, CAST(floor(box[4]) AS BIGINT) AS by1 FROM kids)"
SQL_PICTURES = (
    SQL_BOXES
    + ", grid AS (SELECT doc_id, id, page_number, bx0 - bx0 % 100 AS bx0, by0 - by0 % 63 AS by0, bx1 - bx1 % 100 AS bx1, by1 - by1 % 63 + 63 AS by1 FROM boxes)"
    + ", pictures AS (SELECT doc_id, page_number AS page, row_number() OVER (PARTITION BY doc_id, page_number ORDER BY id) - 1 AS idx, bx0::DOUBLE AS x0, 630.0::DOUBLE - by1 AS y0, bx1::DOUBLE AS x1, 630.0::DOUBLE - by0 AS y1, bx1 - bx0 AS w, (by1 - by0) * 3 AS h FROM grid"
    + " WHERE page_number IS NOT NULL AND bx0 IS NOT NULL AND by0 IS NOT NULL AND bx1 IS NOT NULL AND by1 IS NOT NULL)"
    + ", gpages AS (SELECT DISTINCT doc_id, page_number AS page FROM kids WHERE page_number IS NOT NULL)"
    + f", gtexts AS (SELECT doc_id, page_number AS page, id AS idx, coalesce(bx0, 0)::DOUBLE AS x0, 630.0::DOUBLE - coalesce(by1, 0) AS y0, array_to_string(list_filter(list_transform(string_split(content, chr(10)), lambda l: {_strip('l')}), lambda l: l <> ''), chr(10)) AS text FROM boxes WHERE page_number IS NOT NULL AND coalesce(type, '') <> 'image' AND {_strip('content')} <> '')"
)
SQL_CLASSIFIED = (
    SQL_PICTURES
    + ", classified AS (SELECT p.doc_id, p.page, coalesce(t.text_len, 0) AS text_len, coalesce(i.image_area, 0.0::DOUBLE) AS image_area, coalesce(i.n_images, 0) AS n_images,"
    + " coalesce(t.text_len, 0) <= 20 AND coalesce(i.image_area, 0) / (500.0::DOUBLE * 630.0::DOUBLE) >= 0.6::DOUBLE AS scanned, coalesce(t.text_len, 0) = 0 AND coalesce(i.n_images, 0) = 0 AS empty"
    + " FROM gpages p LEFT JOIN (SELECT doc_id, page, CAST(sum(length(text)) AS BIGINT) AS text_len FROM gtexts GROUP BY 1, 2) t USING (doc_id, page)"
    + " LEFT JOIN (SELECT doc_id, page, sum(greatest(0.0::DOUBLE, x1 - x0) * greatest(0.0::DOUBLE, y1 - y0)) AS image_area, count(*) AS n_images FROM pictures GROUP BY 1, 2) i USING (doc_id, page))"
)
SQL_PAIRS = (
    SQL_CLASSIFIED
    + ", flat AS (SELECT x.* FROM pictures x JOIN classified c USING (doc_id, page) WHERE NOT c.scanned)"
    + ", pairs AS (SELECT a.doc_id, a.page AS n, a.idx AS i, b.page AS m, min(b.idx) AS j FROM flat a JOIN flat b ON a.doc_id = b.doc_id AND b.page = a.page + 1"
    + " WHERE 630.0::DOUBLE - a.y1 <= 0.06::DOUBLE * 630.0::DOUBLE AND b.y0 <= 0.06::DOUBLE * 630.0::DOUBLE AND abs(a.x0 - b.x0) <= 0.05::DOUBLE * 500.0::DOUBLE AND abs(a.x1 - b.x1) <= 0.05::DOUBLE * 500.0::DOUBLE GROUP BY ALL)"
)
SQL_KEPT = (
    SQL_PAIRS
    + ", seq AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n, i) AS k FROM pairs)"
    + ", fold(doc_id, k, used, n, i, m, j, keep) AS (SELECT doc_id, k, [n || ':' || i, m || ':' || j], n, i, m, j, true FROM seq WHERE k = 1"
    + " UNION ALL SELECT s.doc_id, s.k, CASE WHEN list_has_any(f.used, [s.n || ':' || s.i, s.m || ':' || s.j]) THEN f.used ELSE list_concat(f.used, [s.n || ':' || s.i, s.m || ':' || s.j]) END, s.n, s.i, s.m, s.j, NOT list_has_any(f.used, [s.n || ':' || s.i, s.m || ':' || s.j]) FROM fold f JOIN seq s ON s.doc_id = f.doc_id AND s.k = f.k + 1)"
    + ", kept AS (SELECT doc_id, n, i, m, j FROM fold WHERE keep)"
    + ", ends AS (SELECT doc_id, n AS page, i AS idx FROM kept UNION SELECT doc_id, m, j FROM kept)"
)
SQL_STITCHED = (
    SQL_KEPT
    + ", stitched AS (SELECT k.doc_id, k.n AS page, k.i AS idx, k.m, k.j, a.x0, a.y0, greatest(a.w, b.w) AS w,"
    + " CASE WHEN a.w = greatest(a.w, b.w) THEN a.h ELSE CAST(round_even(a.h * greatest(a.w, b.w) / a.w, 0) AS BIGINT) END + CASE WHEN b.w = greatest(a.w, b.w) THEN b.h ELSE CAST(round_even(b.h * greatest(a.w, b.w) / b.w, 0) AS BIGINT) END AS h"
    + " FROM kept k JOIN pictures a ON a.doc_id = k.doc_id AND a.page = k.n AND a.idx = k.i JOIN pictures b ON b.doc_id = k.doc_id AND b.page = k.m AND b.idx = k.j)"
)

QUERIES: dict = {}


def _add(sql: str | None):
    def put(f):
        QUERIES[f.__name__] = (f, sql)
        return f

    return put


# --- files ------------------------------------------------------------------------------------------
@_add(f"WITH {SQL_DECKS} SELECT doc_id, filename, CASE WHEN lower(filename) LIKE '%_.pdf' THEN 'pdf' WHEN lower(filename) LIKE '%_.pptx' THEN 'pptx' WHEN lower(filename) LIKE '%_.ppt' THEN 'ppt' END AS file_kind FROM deck")
def classify_file(s, d):
    return _decks(s, d).select("doc_id", "filename", T.file_kind("filename").alias("file_kind"))


@_add(f"WITH {SQL_DECKS} SELECT doc_id, regexp_replace(filename, '\\.[^.]+$', '') AS stem, lower(regexp_extract(filename, '(\\.[^.]+)$', 1)) AS suffix, lower(regexp_extract(filename, '([^.]*)$', 1)) AS ext FROM deck")
def path_parts(s, d):
    return _decks(s, d).select("doc_id", T.stem("filename").alias("stem"), T.suffix("filename").alias("suffix"), T.ext_of("filename").alias("ext"))


@_add(f"WITH {SQL_DECKS} SELECT doc_id, replace(replace(replace(replace(filename, '&', '&amp;'), '\"', '&quot;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM deck")
def xml_attr(s, d):
    return _decks(s, d).select("doc_id", T.xml_attr("filename").alias("escaped"))


@_add(f"WITH {SQL_IMAGES} SELECT doc_id, image_id, CAST(octet_length(blob) AS BIGINT) AS n_bytes, sha256(blob) AS sha256, sha1(blob) AS sha1, sha256(blob) = digest AS matches FROM pics")
def image_metadata(s, d):
    facts = table(s, d, "images").select("doc_id", "image_id", "loaded_at", F.octet_length("blob").cast("long").alias("n_bytes"), F.sha2("blob", 256).alias("sha256"), F.sha1("blob").alias("sha1"), "digest")
    one = units.latest(facts, ["doc_id", "image_id"], "loaded_at", ["n_bytes", "sha256", "sha1", "digest"])  # the pictures themselves aren't shuffled
    return one.select("doc_id", "image_id", "n_bytes", "sha256", "sha1", (F.col("sha256") == F.col("digest")).alias("matches"))


@_add(f"WITH {SQL_IMAGES} SELECT doc_id, image_id, 'data:image/' || CASE WHEN lower(ext) IN ('jpg', 'jpeg') THEN 'jpeg' WHEN lower(ext) IN ('png', 'gif', 'webp') THEN lower(ext) ELSE 'png' END || ';base64,' || base64(blob) AS url FROM pics")
def data_url(s, d):
    return _images(s, d, "blob", "ext").select("doc_id", "image_id", T.data_url("blob", "ext").alias("url"))


@_add("SELECT layout_id, regexp_extract(raw, '\"file name\": *\"([^\"]*)\"', 1) AS file_name FROM layout_json")
def regex_extract_attr(s, d):
    return table(s, d, "layout_json").select("layout_id", F.regexp_extract("raw", '"file name": *"([^"]*)"', 1).alias("file_name"))


@_add("SELECT layout_id, json_extract_string(raw, '$.\"file name\"') AS file_name, try_cast(json_extract_string(raw, '$.\"number of pages\"') AS INT) AS number_of_pages, json_extract_string(raw, '$.author') AS author, json_extract_string(raw, '$.title') AS title FROM layout_json WHERE raw IS NOT NULL AND raw <> '' AND json_valid(raw) AND json_type(raw) = 'OBJECT'")
def read_layout_json(s, d):
    from leafwork.sources.layout import read_exports

    return read_exports(table(s, d, "layout_json")).select("layout_id", "file_name", "number_of_pages", "author", "title")


@_add(f"WITH {SQL_IMAGES} SELECT ext, count(*) AS pictures, count(*) FILTER ('image/' || ext IN ('image/png', 'image/jpeg', 'image/jpg', 'image/gif', 'image/webp', 'image/bmp')) AS kept, count(*) FILTER (NOT coalesce('image/' || ext IN ('image/png', 'image/jpeg', 'image/jpg', 'image/gif', 'image/webp', 'image/bmp'), false)) AS skipped FROM pics GROUP BY ext")
def mime_filter(s, d):
    known = T.ext_from_mime(F.concat(F.lit("image/"), "ext")).isNotNull()
    return _images(s, d, "ext").groupBy("ext").agg(F.count(F.lit(1)).alias("pictures"), F.count_if(known).alias("kept"), F.count_if(~known).alias("skipped"))


# --- text ---------------------------------------------------------------------------------------------
@_add(f"WITH {SQL_BLOCKS} SELECT doc_id, number, pos, {_strip('text')} AS stripped FROM blocks WHERE kind = 'text'")
def strip_text(s, d):
    return _blocks(s, d).where("kind = 'text'").select("doc_id", "number", "pos", T.strip("text").alias("stripped"))


@_add(f"WITH {SQL_BLOCKS} SELECT doc_id, number, count(*) AS kept FROM blocks WHERE kind = 'text' AND {_strip('text')} <> '' GROUP BY doc_id, number")
def drop_empty_text(s, d):
    return _blocks(s, d).where("kind = 'text'").where(T.non_empty("text")).groupBy("doc_id", "number").agg(F.count(F.lit(1)).alias("kept"))


@_add(f"WITH {SQL_BLOCKS} SELECT doc_id, number, pos, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda l: {_strip('l')}), lambda l: l <> ''), chr(10)) AS lines FROM blocks WHERE kind = 'text'")
def block_text(s, d):
    return _blocks(s, d).where("kind = 'text'").select("doc_id", "number", "pos", T.stripped_lines("text").alias("lines"))


@_add(f"WITH {SQL_KIDS} SELECT doc_id, id, CAST(least(60, coalesce(len(list_filter(regexp_split_to_array(content, '[\\s\\p{{Z}}\\x1c-\\x1f\\x85]+'), lambda w: w <> '')), 0)) AS INT) AS words FROM kids")
def capped_word_count(s, d):
    return _kids(s, d, "content").select("doc_id", "id", T.capped_word_count("content").alias("words"))


@_add(f"WITH {SQL_KIDS} SELECT doc_id, id, CASE WHEN level IS NULL THEN 8 WHEN upper(level) LIKE '%SUBTITLE%' THEN 12 WHEN upper(level) LIKE '%TITLE%' THEN 15 WHEN upper(level) LIKE '%BODY%' OR upper(level) LIKE '%OBJECT%' THEN 10 WHEN upper(level) LIKE '%FOOTER%' OR upper(level) LIKE '%SLIDE_NUMBER%' OR upper(level) LIKE '%DATE%' THEN 0 ELSE 8 END AS weight_tenths FROM kids")
def text_weight(s, d):
    return _kids(s, d, "level").select("doc_id", "id", T.weight_tenths("level").alias("weight_tenths"))


@_add(f"WITH {SQL_IMAGES} SELECT doc_id, image_id, CASE WHEN description IS NULL OR description = '' THEN '(no description)' ELSE description END AS description FROM pics")
def default_text(s, d):
    return _images(s, d, "description").select("doc_id", "image_id", T.or_default("description", "(no description)").alias("description"))


_SQL_WORDS = "list_sort(list_distinct(list_filter(list_transform(regexp_extract_all({0}, '[a-zA-Z]{{3,}}'), lambda w: lower(w)), lambda w: w NOT IN (" + ", ".join(f"'{w}'" for w in T.STOP_WORDS) + "))))"


@_add(f"WITH {SQL_IMAGES} SELECT doc_id, image_id, array_to_string({_SQL_WORDS.format('description')}, ' ') AS words FROM pics")
def word_set(s, d):
    return _images(s, d, "description").select("doc_id", "image_id", F.array_join(T.word_set("description"), " ").alias("words"))


@_add(f"WITH {SQL_IMAGES} SELECT doc_id, image_id, array_to_string(list_sort(list_distinct(regexp_extract_all(description, '\\d+(?:\\.\\d+)?'))), ' ') AS numbers FROM pics")
def number_set(s, d):
    return _images(s, d, "description").select("doc_id", "image_id", F.array_join(T.number_set("description"), " ").alias("numbers"))


def _recall(s, d, of):
    reference = measure.tokens(_kids(s, d, "content").select("doc_id", "content"), ["doc_id"], of("content"))
    output = measure.tokens(_blocks(s, d).where("kind = 'text'").select("doc_id", "text"), ["doc_id"], of("text"))
    return measure.recall(reference, output, ["doc_id"], every=table(s, d, "layout_kids").select("doc_id").distinct())


def _sql_recall(tokens: str) -> str:
    return f"WITH {SQL_BLOCKS}, {SQL_KIDS}, r AS (SELECT DISTINCT doc_id, unnest({tokens.format('content')}) AS t FROM kids), o AS (SELECT DISTINCT doc_id, unnest({tokens.format('text')}) AS t FROM blocks WHERE kind = 'text') SELECT k.doc_id, count(r.t) AS n_reference, count(o.t) AS n_found, CASE WHEN count(r.t) > 0 THEN 100.0::DOUBLE * count(o.t) / count(r.t) ELSE 0.0::DOUBLE END AS recall FROM (SELECT DISTINCT doc_id FROM layout_kids) k LEFT JOIN r ON r.doc_id = k.doc_id LEFT JOIN o ON r.doc_id = o.doc_id AND r.t = o.t GROUP BY k.doc_id"


@_add(_sql_recall(_SQL_WORDS))
def word_recall(s, d):
    return _recall(s, d, T.word_set)


@_add(_sql_recall("list_distinct(regexp_extract_all({0}, '\\d+(?:\\.\\d+)?'))"))
def number_recall(s, d):
    return _recall(s, d, T.number_set)


_CELLS = f"list_filter(list_transform(string_split(content, chr(10)), lambda row: list_transform(string_split(row, '|'), lambda c: {_strip('c')})), lambda row: len(list_filter(row, lambda c: c <> '')) > 0)"


@_add(f"WITH {SQL_KIDS} SELECT doc_id, id, nullif(array_to_string(list_transform({_CELLS}, lambda row: array_to_string(row, ' | ')), chr(10)), '') AS table_text FROM kids WHERE content LIKE '%|%'")
def table_rows(s, d):
    return _kids(s, d, "content").where(F.col("content").contains("|")).select("doc_id", "id", T.table_text("content").alias("table_text"))


# --- units and reading order -----------------------------------------------------------------------------
@_add(f"WITH {SQL_UNITS} SELECT doc_id, number, row_number() OVER (PARTITION BY doc_id ORDER BY number) AS position FROM units")
def number_units(s, d):
    return units.number_units(_units(s, d))


_SQL_RANKED = SQL_BOXES + ", ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_number ORDER BY CASE WHEN by1 IS NULL THEN 0 ELSE 630 - by1 END, coalesce(bx0, 0), id) AS rank FROM boxes)"


def _ranked(s, d):
    shapes = _boxes(s, d).withColumn("top", F.lit(630) - F.col("by1"))
    return units.reading_order(shapes, ["doc_id", "page_number"], "top", "bx0", "id")


@_add(f"WITH {_SQL_RANKED} SELECT doc_id, id, page_number, rank FROM ranked")
def reading_order_blocks(s, d):
    return _ranked(s, d).select("doc_id", "id", "page_number", "rank")


@_add(f"WITH {_SQL_RANKED} SELECT doc_id, page_number, string_agg({_strip('content')}, chr(10) || chr(10) ORDER BY rank) AS body FROM ranked WHERE {_strip('content')} <> '' GROUP BY doc_id, page_number")
def ordered_page_text(s, d):
    r = _ranked(s, d).where(T.non_empty("content"))
    return r.groupBy("doc_id", "page_number").agg(units.ordered_concat(T.strip("content"), "\n\n", F.col("rank")).alias("body"))


@_add(f"WITH {SQL_KIDS} SELECT doc_id, page_number, string_agg({_strip('content')}, chr(10) || chr(10) ORDER BY id) AS body FROM kids WHERE {_strip('content')} <> '' GROUP BY doc_id, page_number")
def slide_text_extract(s, d):
    """In the order of the file, not of the page."""
    return _kids(s, d, "page_number", "content").where(T.non_empty("content")).groupBy("doc_id", "page_number").agg(units.ordered_concat(T.strip("content"), "\n\n", F.col("id")).alias("body"))


@_add(f"WITH {SQL_KIDS}, b AS (SELECT doc_id, page_number, id, 0 AS last, {_strip('content')} AS part FROM kids WHERE coalesce(type, '') <> 'caption' AND {_strip('content')} <> '' UNION ALL SELECT doc_id, page_number, id, 1, '**Speaker notes:** ' || {_strip('content')} FROM kids WHERE type = 'caption' AND {_strip('content')} <> '') SELECT doc_id, page_number, string_agg(part, chr(10) || chr(10) ORDER BY last, id) AS body FROM b GROUP BY doc_id, page_number")
def blocks_with_notes(s, d):
    k = _kids(s, d, "page_number", "type", "content").where(T.non_empty("content"))
    note = F.coalesce(F.col("type") == "caption", F.lit(False))
    part = F.when(note, F.concat(F.lit("**Speaker notes:** "), T.strip("content"))).otherwise(T.strip("content"))
    return k.groupBy("doc_id", "page_number").agg(units.ordered_concat(part, "\n\n", note, F.col("id")).alias("body"))


@_add(f"WITH {SQL_KIDS} SELECT c.doc_id, c.id AS caption_id, i.id AS image_id, c.content AS caption, i.source FROM kids c JOIN kids i ON i.doc_id = c.doc_id AND i.id = c.linked_content_id WHERE c.type = 'caption'")
def caption_link(s, d):
    k = _kids(s, d, "type", "linked_content_id", "content", "source")
    caption = k.where("type = 'caption'").select("doc_id", F.col("id").alias("caption_id"), F.col("linked_content_id").alias("image_id"), F.col("content").alias("caption"))
    return caption.join(k.select("doc_id", F.col("id").alias("image_id"), "source"), ["doc_id", "image_id"]).select("doc_id", "caption_id", "image_id", "caption", "source")


@_add(f"WITH {SQL_DECKS}, {SQL_UNITS}, want AS (SELECT d.doc_id, g.n AS number FROM deck d, LATERAL (SELECT CAST(unnest(range(1, coalesce(d.number_of_pages, 0) + 1)) AS INT) AS n) g) SELECT w.doc_id, w.number, u.number IS NOT NULL AS exists_, coalesce(u.unit_kind, 'missing') AS unit_kind FROM want w LEFT JOIN units u USING (doc_id, number)")
def page_select(s, d):
    """The pages that a deck says it has against those there are; missing ones are marked."""
    want = _decks(s, d).where("number_of_pages >= 1").select("doc_id", F.explode(F.sequence(F.lit(1), F.col("number_of_pages"))).alias("number"))
    have = _units(s, d).select("doc_id", "number", "unit_kind", F.lit(True).alias("_there"))
    return want.join(have, ["doc_id", "number"], "left").select("doc_id", "number", F.col("_there").isNotNull().alias("exists_"), F.coalesce("unit_kind", F.lit("missing")).alias("unit_kind"))


# --- registry of pictures ------------------------------------------------------------------------------------
SQL_PLACED = SQL_BLOCKS + ", " + SQL_IMAGES + ", placed AS (SELECT b.doc_id, b.number, b.pos, b.image_id AS old_id, p.digest, p.ext, p.image_kind FROM blocks b JOIN pics p ON p.doc_id = b.doc_id AND p.image_id = b.image_id WHERE b.kind = 'image')"
SQL_REGISTERED = SQL_PLACED + ", seen AS (SELECT *, min((number, pos)) OVER (PARTITION BY doc_id, digest) AS first FROM placed), registered AS (SELECT *, CASE WHEN digest IS NOT NULL THEN dense_rank() OVER (PARTITION BY doc_id, digest IS NULL ORDER BY first) END AS image_id FROM seen)"


def _placed(s, d):
    return _blocks(s, d).where("kind = 'image'").select("doc_id", "number", "pos", F.col("image_id").alias("old_id")).join(_images(s, d, "digest", "ext", "image_kind").select("doc_id", F.col("image_id").alias("old_id"), "digest", "ext", "image_kind"), ["doc_id", "old_id"])


def _registered(s, d):
    return registry.register(_placed(s, d), "doc_id", "digest", "number", "pos")


@_add(f"WITH {SQL_REGISTERED} SELECT doc_id, number, pos, digest, image_id FROM registered")
def image_registry(s, d):
    return _registered(s, d).select("doc_id", "number", "pos", "digest", "image_id")


@_add(f"WITH {SQL_REGISTERED} SELECT doc_id, image_id, any_value(digest) AS digest, arg_min(ext, (number, pos)) AS ext, arg_min(image_kind, (number, pos)) AS image_kind FROM registered WHERE image_id IS NOT NULL GROUP BY doc_id, image_id")
def unique_images(s, d):
    return registry.unique(_registered(s, d), "doc_id", "digest", ["ext", "image_kind"], "number", "pos")


@_add(f"WITH {SQL_PLACED} SELECT doc_id, count(digest) AS refs, count(DISTINCT digest) AS unique_images, count(digest) - count(DISTINCT digest) AS deduped FROM placed GROUP BY doc_id")
def parse_stats(s, d):
    return registry.parse_stats(_placed(s, d), "doc_id", "digest")


@_add(f"WITH {SQL_PLACED}, p AS (SELECT doc_id, count(digest) AS refs, count(DISTINCT digest) AS unique_images FROM placed GROUP BY doc_id), k AS (SELECT doc_id, count(*) AS skipped FROM pics WHERE NOT coalesce('image/' || ext IN ('image/png', 'image/jpeg', 'image/jpg', 'image/gif', 'image/webp', 'image/bmp'), false) GROUP BY doc_id) SELECT u.doc_id, count(*) AS slides, coalesce(any_value(p.refs), 0) AS refs, coalesce(any_value(p.unique_images), 0) AS unique_images, coalesce(any_value(p.refs) - any_value(p.unique_images), 0) AS deduped, coalesce(any_value(k.skipped), 0) AS skipped FROM units u LEFT JOIN p USING (doc_id) LEFT JOIN k USING (doc_id) GROUP BY u.doc_id")
def parse_log(s, d):
    """Slides, placements, pictures and skipped pictures (no raster type) of each document."""
    unknown = _images(s, d, "ext").where(T.ext_from_mime(F.concat(F.lit("image/"), "ext")).isNull())
    return registry.parse_log(_units(s, d), _placed(s, d), unknown, "doc_id", "digest")


@_add(f"WITH {SQL_IMAGES}, o AS (SELECT *, (coalesce(try_cast(size_bytes AS INT), 0), image_id) AS seq FROM pics), f AS (SELECT *, min(seq) OVER (PARTITION BY doc_id, digest) AS first FROM o) SELECT doc_id, image_id AS old_id, CASE WHEN digest IS NOT NULL THEN dense_rank() OVER (PARTITION BY doc_id, digest IS NULL ORDER BY first) END AS image_id FROM f")
def register_in_deck_order(s, d):
    """By an index of its own (here the size; a missing one is 0), then by arrival."""
    p = _images(s, d, "digest", "size_bytes").select("doc_id", F.col("image_id").alias("old_id"), "digest", F.coalesce(F.expr("try_cast(size_bytes AS int)"), F.lit(0)).alias("at"))
    return registry.register(p, "doc_id", "digest", "at", "old_id").select("doc_id", "old_id", "image_id")


@_add(f"WITH {SQL_BLOCKS}, {SQL_IMAGES} SELECT b.doc_id, b.number, b.pos, CASE WHEN b.kind = 'text' THEN b.text ELSE coalesce(nullif(p.description, ''), '(no description)') END AS part FROM blocks b LEFT JOIN pics p ON p.doc_id = b.doc_id AND p.image_id = b.image_id")
def splice_descriptions(s, d):
    spliced = rendering.splice(_blocks(s, d), _images(s, d, "description"), ["description"])
    return spliced.select("doc_id", "number", "pos", F.when(F.col("kind") == "text", F.col("text")).otherwise(T.or_default("description", "(no description)")).alias("part"))


# --- routing ---------------------------------------------------------------------------------------------------
_AREA = 500 * 630
SQL_ROUTES = (
    SQL_BOXES
    + ", shapes AS (SELECT doc_id, page_number, CASE type WHEN 'image' THEN 'PICTURE' WHEN 'caption' THEN 'AUTO_SHAPE' ELSE 'TEXT' END AS st, CASE WHEN level IS NULL THEN 8 WHEN upper(level) LIKE '%SUBTITLE%' THEN 12 WHEN upper(level) LIKE '%TITLE%' THEN 15 ELSE 8 END AS wt, least(60, coalesce(len(list_filter(regexp_split_to_array(content, '[\\s\\p{Z}\\x1c-\\x1f\\x85]+'), lambda w: w <> '')), 0)) AS words, coalesce(bx1 - bx0, 0) * coalesce(by1 - by0, 0) * 12 AS area FROM boxes)"
    + ", scored AS (SELECT doc_id, page_number, sum(CASE WHEN st <> 'PICTURE' THEN wt * words ELSE 0 END) / 10.0::DOUBLE AS text_score, CAST(sum(CASE WHEN st = 'PICTURE' THEN area ELSE 0 END) AS BIGINT) AS pic_area, count(*) FILTER (st IN ('PICTURE', 'AUTO_SHAPE')) AS graphic_shapes FROM shapes GROUP BY 1, 2)"
    + f", routes AS (SELECT *, pic_area / {_AREA}::DOUBLE AS pic_fraction, CASE WHEN pic_area / {_AREA}::DOUBLE > 0.45::DOUBLE AND text_score < 30 THEN 'vision' WHEN text_score < 5 AND pic_area / {_AREA}::DOUBLE > 0.1::DOUBLE THEN 'vision' WHEN graphic_shapes >= 2 THEN 'vision' ELSE 'text' END AS route FROM scored)"
)


def _routes(s, d):
    b = _boxes(s, d)
    shape = F.when(F.col("type") == "image", "PICTURE").when(F.col("type") == "caption", "AUTO_SHAPE").otherwise("TEXT")
    shapes = b.select("doc_id", "page_number", shape.alias("shape_type"), F.col("level").alias("ph_type"), F.col("content").alias("text"), (F.col("bx1") - F.col("bx0")).alias("width"), ((F.col("by1") - F.col("by0")) * 12).alias("height"))
    return routing.route(routing.score_slides(shapes, ["doc_id", "page_number"]).withColumn("slide_area", F.lit(float(_AREA))), "slide_area").drop("slide_area")


@_add(f"WITH {SQL_ROUTES} SELECT doc_id, page_number, text_score, pic_area, graphic_shapes, pic_fraction, route FROM routes")
def route_slide(s, d):
    return _routes(s, d)


@_add(f"WITH {SQL_ROUTES} SELECT doc_id, count(*) AS n_slides, count(*) FILTER (route = 'vision') AS n_vision, coalesce(string_agg(page_number::VARCHAR, ',' ORDER BY page_number) FILTER (route = 'vision'), '') AS vision_pages, count(*) FILTER (route = 'vision')::DOUBLE / count(*) AS vision_fraction, CASE WHEN count(*) FILTER (route = 'vision') > 0 AND count(*) FILTER (route = 'vision')::DOUBLE / count(*) >= 0.5 THEN 'whole' ELSE 'routed' END AS mode FROM routes GROUP BY doc_id")
def deck_mode(s, d):
    return routing.deck_mode(_routes(s, d)).withColumn("vision_pages", F.array_join(F.transform("vision_pages", lambda n: n.cast("string")), ","))


_SQL_MERGED = (
    SQL_ROUTES
    + f", t AS (SELECT doc_id, page_number, string_agg({_strip('content')}, chr(10) || chr(10) ORDER BY id) AS body FROM kids WHERE {_strip('content')} <> '' GROUP BY 1, 2), v AS (SELECT doc_id, image_id AS page_number, max(description) AS body FROM images GROUP BY 1, 2)"
    + f", merged AS (SELECT r.doc_id, r.page_number, r.route, {_strip('coalesce(nullif(t.body, ' + chr(39) * 2 + '), ' + chr(39) + '_[no content]_' + chr(39) + ')')} AS body FROM routes r LEFT JOIN t USING (doc_id, page_number) WHERE r.route = 'text' UNION ALL SELECT r.doc_id, r.page_number, r.route, {_strip('coalesce(nullif(v.body, ' + chr(39) * 2 + '), ' + chr(39) + '_[no content]_' + chr(39) + ')')} FROM routes r LEFT JOIN v USING (doc_id, page_number) WHERE r.route = 'vision')"
)


def _merged(s, d):
    visions = table(s, d, "images").groupBy("doc_id", F.col("image_id").alias("page_number")).agg(F.max("description").alias("body"))
    return routing.merge_routed(_routes(s, d), slide_text_extract(s, d), visions, ["doc_id", "page_number"])


@_add(f"WITH {_SQL_MERGED} SELECT doc_id, page_number, route, body FROM merged")
def merge_routed(s, d):
    return _merged(s, d)


def _routed_markdown(s, d, gap):
    m = _merged(s, d).where("page_number IS NOT NULL")
    body = F.concat(F.lit("## Slide "), F.col("page_number").cast("string"), F.lit(gap + "("), "route", F.lit(")\n\n"), "body")
    return m.groupBy("doc_id").agg(F.concat(units.ordered_concat(body, rendering.RULE, F.col("page_number")), F.lit("\n")).alias("markdown"))


def _sql_routed(gap: str) -> str:
    return f"WITH {_SQL_MERGED} SELECT doc_id, string_agg('## Slide ' || page_number || '{gap}(' || route || ')' || chr(10) || chr(10) || body, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY page_number) || chr(10) AS markdown FROM merged WHERE page_number IS NOT NULL GROUP BY doc_id"


@_add(_sql_routed("  "))
def render_routed_md(s, d):
    return _routed_markdown(s, d, "  ")


@_add(_sql_routed(" "))
def render_benchmark_md(s, d):
    return _routed_markdown(s, d, " ")


# --- page geometry ------------------------------------------------------------------------------------------------
def _pairs(geometry):
    p, t, i = geometry
    plain = pages.classify(p, t, i).where(~F.col("scanned")).select("doc_id", "page")
    return pages.split_pairs(i.join(plain, ["doc_id", "page"]), p)


@_add(f"WITH {SQL_CLASSIFIED} SELECT doc_id, page, text_len, image_area, n_images, scanned, empty, scanned OR empty AS whole FROM classified")
def page_classify(s, d):
    return pages.classify(*_geometry(s, d)).drop("width", "height")


@_add(f"WITH {SQL_PICTURES} SELECT doc_id, page, idx, NOT (w > 0 AND h > 0 AND least(w, h) < 150) AS kept FROM pictures")
def min_dim_filter(s, d):
    """Pictures with an unknown side stay."""
    return _geometry(s, d)[2].select("doc_id", "page", "idx", (~((F.col("w") > 0) & (F.col("h") > 0) & (F.least("w", "h") < 150))).alias("kept"))


@_add(f"WITH RECURSIVE {SQL_KEPT} SELECT x.doc_id, x.page, x.idx FROM pictures x LEFT JOIN ends e USING (doc_id, page, idx) WHERE e.doc_id IS NULL AND least(x.w, x.h) >= 64")
def pdf_figure_filter(s, d):
    """Small figures are dropped only after the halves of split ones are taken."""
    g = _geometry(s, d)
    return pages.unconsumed(g[2], pages.consume(_pairs(g))).where(F.least("w", "h") >= 64).select("doc_id", "page", "idx")


@_add(f"WITH {SQL_PAIRS} SELECT doc_id, n, i, m, j FROM pairs")
def split_pairs(s, d):
    return _pairs(_geometry(s, d))


@_add(f"WITH RECURSIVE {SQL_KEPT} SELECT doc_id, n, i, m, j FROM kept")
def split_consume(s, d):
    return pages.consume(_pairs(_geometry(s, d)))


@_add(f"WITH RECURSIVE {SQL_KEPT} SELECT x.doc_id, x.page, x.idx FROM pictures x LEFT JOIN ends e USING (doc_id, page, idx) WHERE e.doc_id IS NULL")
def unconsumed_images(s, d):
    g = _geometry(s, d)
    return pages.unconsumed(g[2], pages.consume(_pairs(g))).select("doc_id", "page", "idx")


@_add(f"WITH RECURSIVE {SQL_STITCHED} SELECT doc_id, page, idx, m, j, x0, y0, w, h FROM stitched")
def stitched_size(s, d):
    g = _geometry(s, d)
    return pages.stitched(g[2], pages.consume(_pairs(g)))


@_add(f"WITH RECURSIVE {SQL_STITCHED}, items AS (SELECT doc_id, page, y0, x0, 0 AS o, idx, 'text' AS kind FROM gtexts UNION ALL SELECT x.doc_id, x.page, x.y0, x.x0, 1, x.idx, 'figure' FROM pictures x LEFT JOIN ends e USING (doc_id, page, idx) WHERE e.doc_id IS NULL AND least(x.w, x.h) >= 64 UNION ALL SELECT doc_id, page, y0, x0, 2, idx, 'stitched' FROM stitched), every AS (SELECT i.* FROM items i JOIN classified c USING (doc_id, page) WHERE NOT (c.scanned OR c.empty) UNION ALL SELECT doc_id, page, 0, 0, 0, 0, 'page' FROM classified WHERE scanned OR empty) SELECT doc_id, page, row_number() OVER (PARTITION BY doc_id, page ORDER BY y0, x0, o, idx) AS pos, kind, CAST(idx AS BIGINT) AS ref FROM every")
def build_pages(s, d):
    return pages.assemble(*_geometry(s, d))


# --- placement -----------------------------------------------------------------------------------------------------
def _figures(s, d):
    reply = F.expr("CASE WHEN try_cast(size_bytes AS int) % 5 = 0 THEN NULL ELSE try_cast(size_bytes AS int) % 12 END")
    return _images(s, d, "size_bytes", "description").select("doc_id", F.col("image_id").alias("figure"), reply.alias("reply"), "description")


_SQL_FIGURES = SQL_IMAGES + ", figures AS (SELECT doc_id, image_id AS figure, CASE WHEN try_cast(size_bytes AS INT) % 5 = 0 THEN NULL ELSE try_cast(size_bytes AS INT) % 12 END AS reply, description FROM pics)"


@_add(f"WITH {SQL_UNITS}, {_SQL_FIGURES}, v AS (SELECT doc_id, list_sort(list(number)) AS valid FROM units GROUP BY doc_id), c AS (SELECT f.doc_id, f.figure, v.valid, least(greatest(v.valid[1], max(f.reply) OVER (PARTITION BY f.doc_id ORDER BY f.figure ROWS UNBOUNDED PRECEDING)), v.valid[len(v.valid)]) AS x FROM figures f JOIN v USING (doc_id)) SELECT doc_id, figure, list_min(list_filter(valid, lambda n: n >= x)) AS slide FROM c")
def place_figures(s, d):
    return placement.place(_figures(s, d).drop("description"), _units(s, d).select("doc_id", "number"))


@_add(f"WITH {SQL_BLOCKS}, {_SQL_FIGURES}, t AS (SELECT doc_id, number, string_agg(text, ' ' ORDER BY pos) AS text FROM blocks WHERE kind = 'text' GROUP BY 1, 2), sl AS (SELECT u.doc_id, string_agg('Slide ' || u.number || ': ' || substring(coalesce(t.text, ''), 1, 600), chr(10) ORDER BY u.number) AS s FROM units u LEFT JOIN t USING (doc_id, number) GROUP BY u.doc_id), fl AS (SELECT doc_id, string_agg('Figure ' || figure || ': ' || coalesce(nullif(description, ''), '(no description)'), chr(10) ORDER BY figure) AS f FROM figures GROUP BY doc_id) SELECT doc_id, 'Slides:' || chr(10) || s || chr(10) || chr(10) || 'Figures (in deck order):' || chr(10) || f AS prompt FROM sl JOIN fl USING (doc_id)")
def placement_prompt(s, d):
    u = _units(s, d)
    texts = units.blocks(u).where("kind = 'text'").groupBy("doc_id", "number").agg(units.ordered_concat(F.col("text"), " ", F.col("pos")).alias("text"))
    return placement.prompt(u.select("doc_id", "number").join(texts, ["doc_id", "number"], "left"), _figures(s, d))


# --- rendering -------------------------------------------------------------------------------------------------------
_N = "chr(10)"
_NN = "chr(10) || chr(10)"
_SQL_SPLICED = SQL_BLOCKS + ", " + SQL_IMAGES + ", spliced AS (SELECT b.*, p.description, p.digest, p.size_bytes, p.image_kind FROM blocks b LEFT JOIN pics p ON p.doc_id = b.doc_id AND p.image_id = b.image_id)"


def _sql_rendered(part: str, heading: str, sep: str, empty: str = "NULL") -> str:
    return f"{_SQL_SPLICED}, parts AS (SELECT doc_id, number, string_agg({part}, {_NN} ORDER BY pos) AS parts FROM spliced GROUP BY 1, 2), bodies AS (SELECT u.doc_id, string_agg(concat_ws({_NN}, {heading}, coalesce(p.parts, {empty})), {sep} ORDER BY u.number) AS body FROM units u LEFT JOIN parts p USING (doc_id, number) GROUP BY u.doc_id)"


def _bodies(s, d, part, heading, sep=rendering.BLANK, empty=None):
    u = _units(s, d)
    spliced = rendering.splice(units.blocks(u), _images(s, d, "description", "digest", "size_bytes", "image_kind"), ["description", "digest", "size_bytes", "image_kind"])
    return rendering.document_texts(rendering.unit_texts(u.select("doc_id", "number"), spliced.select("doc_id", "number", "pos", part.alias("part")), heading, empty), sep)


def _xml(s, d, part, unit):
    bodies = _bodies(s, d, part, F.concat(F.lit(unit + " "), F.col("number").cast("string")))
    doc = rendering.xml_document(F.lit(1), F.col("filename"), F.col("data_type"), F.col("body"))
    return bodies.join(_decks(s, d), "doc_id").select("doc_id", rendering.xml_file(doc).alias("xml"))


_ESC = "replace(replace(replace(replace(coalesce({0}, ''), '&', '&amp;'), '\"', '&quot;'), '<', '&lt;'), '>', '&gt;')"
_SQL_XML = f"'  <document index=\"' || {{i}} || '\" filename=\"' || {_ESC.format('filename')} || '\" data-type=\"' || {_ESC.format('data_type')} || '\">' || {_N} || body || {_N} || '  </document>' || {_N}"
_DECK_PART = f"CASE WHEN kind = 'text' THEN text ELSE '[Image ' || image_id || ']' || {_N} || coalesce(nullif(description, ''), '(no description)') END"
_PAGE_PART = "CASE WHEN kind = 'text' THEN text WHEN image_kind = 'page' THEN coalesce(nullif(description, ''), '(no description)') ELSE '<image id=\"' || image_id || '\" sha256=\"' || coalesce(digest, '') || '\" size_bytes=\"' || coalesce(size_bytes, '') || '\">' || coalesce(nullif(description, ''), '(no description)') || '</image>' END"
_MD_PART = f"CASE WHEN kind = 'text' THEN text ELSE '**[Image ' || image_id || ']**' || {_NN} || coalesce(nullif(description, ''), '_[no description]_') END"


@_add(f"WITH {_sql_rendered(_DECK_PART, chr(39) + 'Slide ' + chr(39) + ' || u.number', _NN)}, {SQL_DECKS} SELECT doc_id, '<documents>' || {_N} || {_SQL_XML.format(i=1)} || '</documents>' || {_N} AS xml FROM bodies JOIN deck USING (doc_id)")
def render_xml(s, d):
    return _xml(s, d, rendering.deck_part(), "Slide")


@_add(f"WITH {_sql_rendered(_PAGE_PART, chr(39) + 'Page ' + chr(39) + ' || u.number', _NN)}, {SQL_DECKS} SELECT doc_id, '<documents>' || {_N} || {_SQL_XML.format(i=1)} || '</documents>' || {_N} AS xml FROM bodies JOIN deck USING (doc_id)")
def render_pdf_xml(s, d):
    return _xml(s, d, rendering.page_part(), "Page")


@_add(f"WITH {_sql_rendered(_MD_PART, chr(39) + '## Slide ' + chr(39) + ' || u.number', _NN + ' || ' + chr(39) + '---' + chr(39) + ' || ' + _NN, chr(39) + '_[no content]_' + chr(39))} SELECT doc_id, body || {_N} AS markdown FROM bodies")
def render_placeholder_md(s, d):
    b = _bodies(s, d, rendering.markdown_part(), F.concat(F.lit("## Slide "), F.col("number").cast("string")), rendering.RULE, "_[no content]_")
    return b.select("doc_id", F.concat("body", F.lit("\n")).alias("markdown"))


@_add(f"WITH {_sql_rendered(_DECK_PART, chr(39) + 'Slide ' + chr(39) + ' || u.number', _NN)}, {SQL_DECKS} SELECT doc_id, data_type, CAST(row_number() OVER (PARTITION BY data_type ORDER BY filename, doc_id) AS BIGINT) AS index, length(body) AS n_chars FROM bodies JOIN deck USING (doc_id)")
def document_collection(s, d):
    """The place of each document in its collection (here one for each data type) and the length of its body."""
    bodies = _bodies(s, d, rendering.deck_part(), F.concat(F.lit("Slide "), F.col("number").cast("string")))
    sized = bodies.select("doc_id", F.length("body").cast("long").alias("n_chars")).join(_decks(s, d), "doc_id")
    return units.numbered(sized, "data_type", ["filename", "doc_id"], "index").select("doc_id", "data_type", "index", "n_chars")


@_add(f"WITH {SQL_KIDS}, n AS (SELECT *, sum(CASE WHEN type = 'image' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY id ROWS UNBOUNDED PRECEDING) AS k FROM kids), l AS (SELECT doc_id, id, CASE WHEN type = 'image' THEN '![image ' || k || '](<' || coalesce(source, '') || '>)' WHEN type = 'heading' AND {_strip('content')} <> '' THEN repeat('#', coalesce(heading_level, 1)) || ' ' || content WHEN {_strip('content')} <> '' THEN content END AS line FROM n) SELECT doc_id, coalesce(string_agg(line, {_NN} ORDER BY id), '') || {_N} AS markdown FROM l GROUP BY doc_id")
def layout_json_to_md(s, d):
    return rendering.layout_markdown(_kids(s, d, "type", "content", "heading_level", "source"), "id")


# --- replies and usage -----------------------------------------------------------------------------------------------------
@_add("SELECT event_id, props AS bare FROM events")
def strip_fence(s, d):
    return table(s, d, "events").select("event_id", T.strip_fence(F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).alias("bare"))


@_add("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS INT) AS k, CAST(NULL AS INT) AS missing FROM events")
def parse_reply(s, d):
    bare = T.strip_fence(F.concat(F.lit("```"), "props", F.lit("```")))
    return table(s, d, "events").select("event_id", T.reply_int(bare, "$.k").alias("k"), T.reply_int(bare, "$.missing").alias("missing"))


def _calls(s, d):
    tokens_in = F.floor("value").cast("long")
    reply = F.concat(F.lit('{"prompt_tokens": '), tokens_in.cast("string"), F.lit(', "completion_tokens": '), F.get_json_object("props", "$.k"), F.lit("}"))
    n_in, n_out = measure.usage(reply)
    seconds = F.floor("value") % 90 / 1.0
    return table(s, d, "events").select("event_id", "ts", F.col("event_type").alias("approach"), F.col("user_id").alias("trial"), n_in.alias("input_tokens"), n_out.alias("output_tokens"), seconds.alias("api_s"), (F.col("event_id") % 7 / 1.0).alias("render_s"))


def _runs(s, d):
    """A run of each approach and trial over a deck of as many slides as the trial's number modulo 40; seconds are whole."""
    runs = measure.tally(_calls(s, d), ["approach", "trial"], ("input_tokens", "output_tokens", "api_s", "render_s"))
    return runs.withColumn("wall_s", F.col("api_s") + F.col("render_s")).withColumn("n_slides", F.col("trial") % 40)


def _prices(s, d):
    """A price list in the form the operator takes: a model and the prices of a million tokens."""
    return table(s, d, "region").select(F.col("r_regionkey").cast("long").alias("model"), (F.col("r_regionkey") + 0.5).alias("input"), (F.col("r_regionkey") * 4 + 2.0).alias("output"))


_SQL_CALLS = (
    "calls AS (SELECT event_id, ts, event_type AS approach, user_id AS trial, CAST(floor(value) AS BIGINT) AS input_tokens, coalesce(try_cast(json_extract_string(props, '$.k') AS BIGINT), 0) AS output_tokens, CAST(CAST(floor(value) AS BIGINT) % 90 AS DOUBLE) AS api_s, CAST(event_id % 7 AS DOUBLE) AS render_s FROM events)"
    ", runs AS (SELECT approach, trial, count(*) AS n_calls, CAST(sum(coalesce(input_tokens, 0)) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens, sum(coalesce(api_s, 0)) AS api_s, sum(render_s) AS render_s, sum(coalesce(api_s, 0)) + sum(render_s) AS wall_s, trial % 40 AS n_slides FROM calls GROUP BY 1, 2)"
    ", prices AS (SELECT CAST(r_regionkey AS BIGINT) AS model, r_regionkey + 0.5::DOUBLE AS input, r_regionkey * 4 + 2.0::DOUBLE AS output FROM region)"
    ", means AS (SELECT approach, arg_min(n_slides, trial) AS n_slides, count(*) AS trials, avg(n_calls) AS n_calls, avg(input_tokens) AS input_tokens, avg(output_tokens) AS output_tokens, avg(render_s) AS render_s, avg(api_s) AS api_s, avg(wall_s) AS wall_s FROM runs GROUP BY approach)"
)


@_add(f"WITH {_SQL_CALLS} SELECT event_id, coalesce(input_tokens, 0) AS input_tokens, output_tokens FROM calls")
def usage_of(s, d):
    return _calls(s, d).select("event_id", "input_tokens", "output_tokens")


@_add(f"WITH {_SQL_CALLS} SELECT approach, trial, n_calls, input_tokens, output_tokens FROM runs")
def usage_tally(s, d):
    return measure.tally(_calls(s, d), ["approach", "trial"])


@_add(f"WITH {_SQL_CALLS} SELECT * FROM means")
def mean_stats(s, d):
    return measure.mean_runs(_runs(s, d))


@_add(f"WITH {_SQL_CALLS} SELECT r.approach, r.trial, r.trial % 6 AS model, r.input_tokens / 1e6::DOUBLE * p.input + r.output_tokens / 1e6::DOUBLE * p.output AS cost FROM runs r LEFT JOIN prices p ON p.model = r.trial % 6")
def cost_by_model(s, d):
    """The cost of each run by its model; one of six isn't on the price list and has none."""
    return measure.cost(_runs(s, d).withColumn("model", F.col("trial") % 6), _prices(s, d)).select("approach", "trial", "model", "cost")


@_add(
    f"WITH {_SQL_CALLS}, c AS (SELECT m.*, m.input_tokens / 1e6::DOUBLE * p.input + m.output_tokens / 1e6::DOUBLE * p.output AS cost FROM means m JOIN prices p ON p.model = 1), w AS (SELECT * FROM c WHERE approach = 'view'), r AS (SELECT * FROM c WHERE approach = 'click')"
    " SELECT CASE WHEN r.cost <> 0 AND w.cost <> 0 THEN r.cost / w.cost * 100 END AS cost_pct, CASE WHEN r.cost <> 0 AND w.cost <> 0 THEN (1 - r.cost / w.cost) * 100 END AS saving_pct, r.input_tokens / greatest(w.input_tokens, 1.0::DOUBLE) * 100 AS input_tokens_pct, r.wall_s / greatest(w.wall_s, 1e-9::DOUBLE) * 100 AS wall_pct FROM w, r"
)
def compare_runs(s, d):
    priced = measure.cost(mean_stats(s, d).withColumn("model", F.lit(1).cast("long")), _prices(s, d))
    return measure.compare(priced, "view", "click")


@_add("SELECT event_type AS approach, arg_max(props, (ts, event_id)) AS last_reply FROM events GROUP BY event_type")
def last_output(s, d):
    return table(s, d, "events").groupBy(F.col("event_type").alias("approach")).agg(F.max_by("props", F.struct("ts", "event_id")).alias("last_reply"))
