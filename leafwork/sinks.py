"""Writing documents: one file a row on any file system that Spark knows, or text tables for bulk."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwork.runtime import materialize


def relative(path: Column | str, root: str) -> Column:
    """A path as it stands below ``root``; schemes and doubled slashes don't count.  A path elsewhere keeps its last part."""
    path = F.col(path) if isinstance(path, str) else path
    plain = F.regexp_replace(F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(?=/)", ""), r"/+", "/")
    base = "/" + root.split(":", 1)[-1].strip("/") + "/"
    return F.when(F.startswith(plain, F.lit(base)), F.substr(plain, F.lit(len(base) + 1))).otherwise(F.regexp_extract(plain, r"([^/]*)$", 1))


def write_files(df: DataFrame, folder: str, name: str, body: str) -> int:
    """One UTF-8 file a row below ``folder``, also in folders of its own; returns the number of files.

    ``folder`` may be a local path or any URL that Spark's file systems serve.  Parents are made, files replaced; a
    retried task writes the same files again.  Rows with a null name or body are left out.  Two rows of one name, and
    names that leave the folder, are refused before anything is written.
    """
    rows = materialize(df.select(F.col(name).alias("name"), F.col(body).alias("body")).where(F.col(body).isNotNull() & F.col(name).isNotNull()), "files")
    bad = rows.where(F.col("name").rlike(r"(?:^|/)\.\.(?:/|$)|^/|^$")).select("name").head()
    twice = rows.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").head()
    if bad or twice:
        raise ValueError(f"{'a name leaves the folder' if bad else 'two documents have the name'}: {(bad or twice)[0]!r}")
    scheme = folder.split(":", 1)[0] if "://" in folder or folder.startswith("file:") else ""
    if scheme in ("", "file"):
        return _write_local(rows, folder)
    return _write_hadoop(rows, folder)


def _write_local(rows: DataFrame, folder: str) -> int:
    def run(batches: Iterator) -> Iterator:
        import os

        import pandas as pd

        root = "/" + folder.split(":", 1)[1].lstrip("/") if folder.startswith("file:") else folder
        for batch in batches:
            for file, text in zip(batch["name"], batch["body"], strict=True):
                path = os.path.join(root, file)
                os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
                with open(f"{path}.part", "w", encoding="utf-8", newline="") as f:
                    f.write(text)
                os.replace(f"{path}.part", path)
            yield pd.DataFrame({"n": [len(batch)]})

    return rows.mapInPandas(run, "n bigint").agg(F.sum("n")).first()[0] or 0


def _write_hadoop(rows: DataFrame, folder: str) -> int:
    """Object stores and other file systems, through Spark's own: executors write each text into a part of its own, the driver renames the parts.

    A text without one gets a line's end at its end, as all documents of this package have.
    """
    spark = rows.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda *p: jvm.org.apache.hadoop.fs.Path("/".join(p))
    parts = f"{folder.rstrip('/')}/_parts"
    safe = F.sha2("name", 256)
    text = F.when(F.endswith("body", F.lit("\n")), F.substr("body", F.lit(1), F.length("body") - 1)).otherwise(F.col("body"))  # the sink ends each text with a line's end
    rows.select(safe.alias("name"), text.alias("value")).repartition("name").write.mode("overwrite").partitionBy("name").text(parts)
    fs = path(folder).getFileSystem(conf)
    n = 0
    for name, key in rows.select("name", safe).toLocalIterator():
        made = [s.getPath() for s in fs.listStatus(path(parts, f"name={key}")) if s.getPath().getName().startswith("part-")]
        target = path(folder.rstrip("/"), name)
        fs.mkdirs(target.getParent())
        fs.delete(target, False)
        if not fs.rename(made[0], target):
            raise OSError(f"could not write {name}")
        n += 1
    fs.delete(path(parts), True)
    return n


def write_table(df: DataFrame, folder: str, by: str, body: str) -> None:
    """Bulk: text below one folder for each value of ``by``."""
    df.select(by, F.col(body).alias("value")).write.mode("overwrite").partitionBy(by).text(folder)


def print_one(df: DataFrame, body: str) -> None:
    """The text of a frame of one row to the standard output; more rows are refused."""
    import sys

    rows = df.select(body).head(2)
    if len(rows) > 1:
        raise ValueError("more than one document")
    sys.stdout.write("".join(r[0] or "" for r in rows))
