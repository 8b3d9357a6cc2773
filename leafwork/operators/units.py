"""Units (pages and slides), their blocks, and reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafwork.functions import text as T
from leafwork.runtime import materialize


def latest(df: DataFrame, keys: list[str], at: str, columns: list[str] | None = None) -> DataFrame:
    """One row for each key with ``columns`` (default: all others): the latest by ``at``; a null time is the earliest.

    Of equal times the greatest values in the order of ``columns`` win, so the result doesn't hang on the order of
    rows.  An aggregate, not a window: it combines before it shuffles, and a hot key is no hot task.  Only ``columns``
    are read, since what stands in one struct can't be pruned later: name those that are needed.
    """
    rest = [c for c in df.columns if c not in keys and c != at] if columns is None else columns
    if not rest:
        return df.select(*keys).distinct()
    best = df.groupBy(*keys).agg(F.max(F.struct(F.col(at).alias("_at"), *[F.col(c).alias(f"_{k}") for k, c in enumerate(rest)])).alias("_r"))
    return best.select(*keys, *[F.col(f"_r._{k}").alias(c) for k, c in enumerate(rest)])


def units(page_units: DataFrame) -> DataFrame:
    return latest(page_units, ["doc_id", "number"], "scanned_at")


def blocks(unit_rows: DataFrame) -> DataFrame:
    """``doc_id, number, pos, kind, text, image_id``: one row a block, positions from 1; units without blocks have none."""
    return unit_rows.select("doc_id", "number", F.posexplode("blocks").alias("_p", "_b")).select("doc_id", "number", (F.col("_p") + 1).cast("long").alias("pos"), "_b.kind", "_b.text", "_b.image_id")


def number_units(unit_rows: DataFrame) -> DataFrame:
    """Consecutive numbers from 1 in each document, in the order of the unit numbers."""
    return unit_rows.select("doc_id", "number", F.row_number().over(Window.partitionBy("doc_id").orderBy("number")).cast("long").alias("position"))


def numbered(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with the number, from 1, of each row in its ``group`` by ``order``, where a group may hold most rows.

    Rows are range-partitioned and sorted, so a group spreads over partitions; the number is the place in the
    partition plus the rows of the group in those before (one row a partition and group, and no more, is counted up).
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, group, *order).sortWithinPartitions(group, *order)
    kept = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered").withColumn("_part", F.shiftright("_at", 33))
    runs = kept.groupBy("_part", group).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_rows").over(Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(F.col("_part").alias("_p"), F.col(group).alias("_g"), "_first", before.alias("_before"))
    both = kept.join(runs, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    return both.select(*df.columns, (F.col("_at") - F.col("_first") + F.col("_before") + 1).cast("long").alias(name))


def ordered_concat(value: Column, sep: str, *order: Column) -> Column:
    """An aggregate: the values in order, joined; nulls are left out.

    It gathers one group's values in one row, so a group has to be a document or less.
    """
    rows = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(*[o.alias(f"o{k}") for k, o in enumerate(order)], value.alias("v")))))
    return F.array_join(F.transform(rows, lambda r: r["v"]), sep)


def reading_order(shapes: DataFrame, keys: list[str], top: str, left: str, order: str) -> DataFrame:
    """``shapes`` with ``rank`` from 1 in each group: by top, then left, null as 0; ties keep the order of the file."""
    w = Window.partitionBy(*keys).orderBy(F.coalesce(top, F.lit(0)), F.coalesce(left, F.lit(0)), order)
    return shapes.withColumn("rank", F.row_number().over(w).cast("long"))


def tree_order(shapes: DataFrame, keys: list[str], sort_path: str = "sort_path") -> DataFrame:
    """``shapes`` of nested groups with ``rank``: a group sorts as one unit among its siblings, its children inside it.

    ``sort_path`` is an array of structs (top, left, ord), one for each level; arrays compare level by level.
    """
    return shapes.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(sort_path)).cast("long"))


def shape_blocks(shapes: DataFrame, keys: list[str], *, notes: DataFrame | None = None) -> DataFrame:
    """``keys, pos, kind, text, blob, ext`` from ranked shapes: a picture supersedes its text; else the text, then the table.

    With ``notes`` (keys, notes) the speaker notes come last.
    """
    table = F.array_join(
        F.filter(F.transform("rows", lambda r: F.when(F.exists(r, lambda c: T.strip(c) != ""), F.array_join(F.transform(r, T.strip), " | "))), lambda r: r.isNotNull()), "\n"
    )
    picture = F.col("blob").isNotNull()
    parts = F.filter(F.array(F.when(~picture, T.strip("text")), F.when(~picture, table)), lambda x: F.coalesce(x != "", F.lit(False)))
    text = shapes.select(*keys, "rank", F.posexplode(parts).alias("part", "text")).select(*keys, "rank", "part", F.lit("text").alias("kind"), "text", F.lit(None).cast("binary").alias("blob"), F.lit(None).cast("string").alias("ext"))
    images = shapes.where(picture).select(*keys, "rank", F.lit(0).alias("part"), F.lit("image").alias("kind"), F.lit(None).cast("string").alias("text"), "blob", "ext")
    both = text.unionByName(images)
    if notes is not None:
        last = notes.where(T.non_empty("notes")).select(*keys, F.lit(2**31).cast("long").alias("rank"), F.lit(0).alias("part"), F.lit("text").alias("kind"), F.concat(F.lit("**Speaker notes:** "), T.strip("notes")).alias("text"), F.lit(None).cast("binary").alias("blob"), F.lit(None).cast("string").alias("ext"))
        both = both.unionByName(last)
    return both.withColumn("pos", F.row_number().over(Window.partitionBy(*keys).orderBy("rank", "part")).cast("long")).drop("rank", "part")
