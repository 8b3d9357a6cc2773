"""First-seen registry of pictures: one id for each digest of a document, in order of first occurrence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def register(placements: DataFrame, doc: str, digest: str, *order: str) -> DataFrame:
    """``placements`` with ``image_id`` from 1 in each document; null digests have none.

    Ids are given to the distinct digests (an aggregate that combines first, so copies don't reach the window)
    and joined back.
    """
    seq = F.struct(*order)
    first = placements.where(F.col(digest).isNotNull()).groupBy(doc, digest).agg(F.min(seq).alias("_first"))
    ids = first.withColumn("image_id", F.row_number().over(Window.partitionBy(doc).orderBy("_first")).cast("long")).drop("_first")
    return placements.join(ids, [doc, digest], "left")


def unique(registered: DataFrame, doc: str, digest: str, keep: list[str], *order: str) -> DataFrame:
    """One row for each document and id, with the attributes of the first occurrence; later ones are ignored."""
    first = F.min_by(F.struct(digest, *keep), F.struct(*order))
    return registered.where(F.col("image_id").isNotNull()).groupBy(doc, "image_id").agg(first.alias("_r")).select(doc, "image_id", f"_r.{digest}", *[f"_r.{c}" for c in keep])


def parse_stats(placements: DataFrame, doc: str, digest: str) -> DataFrame:
    """Placements, distinct pictures and the difference, by document."""
    by = placements.groupBy(doc).agg(F.count(digest).alias("refs"), F.count_distinct(digest).alias("unique_images"))
    return by.withColumn("deduped", F.col("refs") - F.col("unique_images"))


def parse_log(units: DataFrame, placements: DataFrame, skipped: DataFrame, doc: str, digest: str) -> DataFrame:
    """``doc, slides, refs, unique_images, deduped, skipped``: every document of ``units`` (one row a slide), with 0 where there is nothing."""
    slides = units.groupBy(doc).agg(F.count(F.lit(1)).alias("slides"))
    out = slides.join(parse_stats(placements, doc, digest), doc, "left").join(skipped.groupBy(doc).agg(F.count(F.lit(1)).alias("skipped")), doc, "left")
    return out.fillna(0)


def pixel_digest(blob: Column, decode=None) -> Column:
    """SHA-1 of the decoded picture, or of the raw bytes where there is no decoder or it fails.

    ``decode`` takes bytes and gives bytes of a canonical form; it runs in an Arrow batch on the workers.
    """
    if decode is None:
        return F.sha1(blob)

    @F.pandas_udf("string")
    def digest(blobs):
        import hashlib

        def one(b):
            if b is None:
                return None
            try:
                return hashlib.sha1(decode(bytes(b))).hexdigest()
            except Exception:
                return hashlib.sha1(bytes(b)).hexdigest()

        return blobs.map(one)

    return digest(blob)
