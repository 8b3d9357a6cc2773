"""Layout exports: the top-level fields of a document, and the converter's JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The fields of an export, as its converter names them.
FIELDS = (("file name", "file_name", "string"), ("number of pages", "number_of_pages", "int"), ("author", "author", "string"), ("title", "title", "string"), ("creation date", "creation_date", "string"), ("modification date", "modification_date", "string"))


def read_exports(df: DataFrame, raw: str = "raw") -> DataFrame:
    """The columns of ``df`` but ``raw``, and the top-level fields; texts that are no JSON object have no row."""
    parsed = df.withColumn("_v", F.try_parse_json(raw)).where(F.schema_of_variant("_v").startswith("OBJECT"))
    fields = [F.try_variant_get("_v", f"$['{name}']", kind).alias(alias) for name, alias, kind in FIELDS]
    return parsed.select(*[c for c in df.columns if c != raw], *fields)


def read_export_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, raw`` of JSON files, whole; to be shredded or read field by field."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))
