"""Page geometry: classification, figures split by a page break, and assembly in reading order.

Pictures have ``doc_id, page, idx, x0, y0, x1, y1`` with y growing downward; pages ``doc_id, page, width, height``.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.config import DEFAULTS, Config


def classify(pages: DataFrame, texts: DataFrame, images: DataFrame, cfg: Config = DEFAULTS, *, fallback: bool = True) -> DataFrame:
    """``pages`` with ``text_len, image_area, n_images, scanned, empty, whole``; texts: doc_id, page, text.

    A scanned page is taken as a whole, an empty one only with ``fallback`` (else it is a page without items).  Overlapping pictures count twice; a page area of 0 counts as 1.
    """
    by_text = texts.groupBy("doc_id", "page").agg(F.sum(F.length("text")).alias("text_len"))
    w, h = F.greatest(F.lit(0.0), F.col("x1") - F.col("x0")), F.greatest(F.lit(0.0), F.col("y1") - F.col("y0"))
    by_image = images.groupBy("doc_id", "page").agg(F.sum(w * h).alias("image_area"), F.count(F.lit(1)).alias("n_images"))
    out = pages.join(by_text, ["doc_id", "page"], "left").join(by_image, ["doc_id", "page"], "left").fillna({"text_len": 0, "image_area": 0.0, "n_images": 0})
    area = F.col("width") * F.col("height")
    scanned = (F.col("text_len") <= cfg.scanned_text_max_chars) & (F.col("image_area") / F.when(area != 0, area).otherwise(1.0) >= cfg.scanned_image_cover)
    out = out.withColumn("scanned", scanned).withColumn("empty", (F.col("text_len") == 0) & (F.col("n_images") == 0))
    return out.withColumn("whole", F.col("scanned") | F.col("empty") if fallback else F.col("scanned"))


def split_pairs(images: DataFrame, pages: DataFrame, cfg: Config = DEFAULTS) -> DataFrame:
    """``doc_id, n, i, m, j``: a picture at the foot of page n and the first picture at the head of page m = n + 1 under it.

    An equi-join on document and page with the tolerances as its residue; scanned pages must be left out before.
    """
    sized = images.join(pages.select("doc_id", "page", "width", "height"), ["doc_id", "page"])
    top = sized.where(F.col("height") - F.col("y1") <= cfg.edge_tol * F.col("height")).select("doc_id", F.col("page").alias("n"), F.col("idx").alias("i"), F.col("x0").alias("ax0"), F.col("x1").alias("ax1"), "width")
    bottom = sized.where(F.col("y0") <= cfg.edge_tol * F.col("height")).select("doc_id", F.col("page").alias("m"), (F.col("page") - 1).alias("n"), F.col("idx").alias("j"), F.col("x0").alias("bx0"), F.col("x1").alias("bx1"))
    near = top.join(bottom, ["doc_id", "n"]).where((F.abs(F.col("ax0") - F.col("bx0")) <= cfg.x_align_tol * F.col("width")) & (F.abs(F.col("ax1") - F.col("bx1")) <= cfg.x_align_tol * F.col("width")))
    return near.groupBy("doc_id", "n", "i", "m").agg(F.min("j").alias("j"))


def consume(pairs: DataFrame) -> DataFrame:
    """The pairs that are stitched: in order of (n, i), a pair is skipped if either end is taken already.

    Pairs join neighbouring pages, so a pair can only meet ends of its own two pages: one pass over a document's
    sorted pairs with the taken ends of two pages in hand, in time linear in the pairs whatever a document's size.
    """
    typed = pairs.select("doc_id", *[F.col(c).cast("int").alias(c) for c in "nimj"])

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        doc, page, here, there = None, None, set(), set()  # taken ends on page n and on page n + 1
        for batch in batches:
            kept = []
            for row in batch.itertuples(index=False, name=None):
                key, n, i, m, j = row
                if key != doc or n != page:
                    here, there = (there if key == doc and page is not None and n == page + 1 else set()), set()
                    doc, page = key, n
                if i not in here and j not in there:
                    here.add(i)
                    there.add(j)
                    kept.append(row)
            yield pd.DataFrame(kept, columns=["doc_id", "n", "i", "m", "j"])

    return typed.repartition("doc_id").sortWithinPartitions("doc_id", "n", "i").mapInPandas(run, typed.schema)


def unconsumed(images: DataFrame, kept: DataFrame) -> DataFrame:
    """The pictures that are no half of a stitched figure."""
    ends = kept.select("doc_id", F.explode(F.array(F.struct(F.col("n").alias("page"), F.col("i").alias("idx")), F.struct(F.col("m").alias("page"), F.col("j").alias("idx")))).alias("e")).select("doc_id", "e.page", "e.idx")
    return images.join(ends, ["doc_id", "page", "idx"], "left_anti")


def stitched(images: DataFrame, kept: DataFrame) -> DataFrame:
    """Stitched figures on the first page, with the wider half's width and both heights scaled to it (half-even)."""
    top = images.select("doc_id", F.col("page").alias("n"), F.col("idx").alias("i"), "x0", "y0", F.col("w").alias("tw"), F.col("h").alias("th"))
    bottom = images.select("doc_id", F.col("page").alias("m"), F.col("idx").alias("j"), F.col("w").alias("bw"), F.col("h").alias("bh"))
    both = kept.join(top, ["doc_id", "n", "i"]).join(bottom, ["doc_id", "m", "j"])
    w = F.greatest("tw", "bw")
    scaled = lambda width, height: F.when(F.col(width) == w, F.col(height)).otherwise(F.rint(F.col(height) * w / F.col(width)).cast("long"))
    return both.select("doc_id", F.col("n").alias("page"), F.col("i").alias("idx"), F.col("m"), F.col("j"), "x0", "y0", w.alias("w"), (scaled("tw", "th") + scaled("bw", "bh")).alias("h"))


def assemble(pages: DataFrame, texts: DataFrame, images: DataFrame, cfg: Config = DEFAULTS, *, fallback: bool = True) -> DataFrame:
    """``doc_id, page, pos, kind, ref``: each page's items in reading order.

    Whole pages are one item of kind page.  Else texts (doc_id, page, idx, x0, y0), figures that are no half of a
    stitched one and not tiny, and stitched figures; ties keep text before figure before stitched, then the index.
    """
    marked = classify(pages, texts, images, cfg, fallback=fallback)
    plain = marked.where(~F.col("whole")).select("doc_id", "page")
    flat = images.join(marked.where(~F.col("scanned")).select("doc_id", "page"), ["doc_id", "page"])
    kept = consume(split_pairs(flat, pages, cfg))
    figures = unconsumed(images, kept).where(F.least("w", "h") >= cfg.min_figure_dim)
    item = lambda df, kind, order: df.select("doc_id", "page", "y0", "x0", F.lit(order).alias("_o"), "idx", F.lit(kind).alias("kind"))
    items = item(texts, "text", 0).unionByName(item(figures, "figure", 1)).unionByName(item(stitched(images, kept), "stitched", 2)).join(plain, ["doc_id", "page"])
    whole = marked.where("whole").select("doc_id", "page", F.lit(0.0).alias("y0"), F.lit(0.0).alias("x0"), F.lit(0).alias("_o"), F.lit(0).alias("idx"), F.lit("page").alias("kind"))
    from pyspark.sql import Window

    w = Window.partitionBy("doc_id", "page").orderBy("y0", "x0", "_o", "idx")
    return items.unionByName(whole).select("doc_id", "page", F.row_number().over(w).cast("long").alias("pos"), "kind", F.col("idx").cast("long").alias("ref"))
