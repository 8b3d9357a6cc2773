"""Describing pictures with a pluggable function, once for each distinct picture.

The default function is a deterministic stub, so results are reproducible without a network.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafwork.config import DEFAULTS
from leafwork.operators import models


def stub(blob: bytes, ext: str) -> str:
    """A text that depends on the bytes only."""
    import hashlib

    return f"Picture {hashlib.sha1(blob).hexdigest()[:8]} ({ext}, {len(blob)} bytes)."


def describe(images: DataFrame, digest: str = "digest", blob: str = "blob", ext: str = "ext", *, figure: Callable[[bytes, str], str] = stub, page: Callable[[bytes, str], str] | None = None, kind: str | None = None, at_once: int = DEFAULTS.max_workers) -> DataFrame:
    """``images`` with ``description``: each distinct digest is described once and joined back.

    Pages (``kind`` = page) go to ``page``, the rest to ``figure``.  A function that fails gives a bracketed note and
    stops nothing.  ``at_once`` calls run at a time over the whole cluster.  Null and empty bytes give a null description.  The distinct pictures are aggregated first, which also keeps the calls from being repeated.
    """
    is_page = F.coalesce(F.col(kind) == "page", F.lit(False)) if kind else F.lit(False)
    distinct = images.where(F.col(digest).isNotNull() & (F.octet_length(blob) > 0)).groupBy(digest).agg(F.first(blob).alias("_blob"), F.first(ext).alias("_ext"), F.max(is_page).alias("_page"))
    of_page = page or figure

    def one(data: bytes, suffix: str, whole: bool) -> str:
        try:
            return (of_page if whole else figure)(data, suffix)
        except Exception as e:
            return f"[{'page' if whole else 'image'} description failed: {e}]"

    described = models.call(distinct, [digest], ["_blob", "_ext", "_page"], one, at_once=at_once).select(digest, F.col("text").alias("description"))
    return images.drop("description").join(described, digest, "left")
