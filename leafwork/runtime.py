"""Reading tables, and cutting lineage through tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only where that is unset (tests, local mode)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    found = "file://" + tempfile.mkdtemp(prefix="leafwork-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as a table into the shared folder and reads it back.

    The plan after it starts at files that outlive any executor, so a lost executor costs a re-read
    and not a re-run.  The table is deleted when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/leafwork/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


#: What may be broadcast: rows, and bytes of their values as text.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20


def _is_small(df: DataFrame) -> bool:
    """Whether a written table is within BROADCAST_ROWS and BROADCAST_BYTES; reads it once."""
    from pyspark.sql import functions as F

    rows, size = df.agg(F.count(F.lit(1)), F.sum(F.length(F.to_json(F.struct("*"))))).first()
    return rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table, with a broadcast hint if it is within BROADCAST_ROWS and BROADCAST_BYTES.

    Beyond the bound the join on it shuffles, as any other; the result is the same.
    """
    from pyspark.sql import functions as F

    kept = materialize(df, name)
    return F.broadcast(kept) if _is_small(kept) else kept


def lookup(df: DataFrame, written: DataFrame, key: str, salts: int = 16) -> DataFrame:
    """``df`` with the columns of ``written``, a written table of one row a ``key``; a left join that no hot key can hold up.

    A small table is broadcast; beyond the bound its rows are repeated for ``salts`` parts of each key.
    """
    from pyspark.sql import functions as F

    if _is_small(written):
        return df.join(F.broadcast(written), key, "left")
    parts = written.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int")).join(parts, [key, "_salt"], "left").drop("_salt")


_written: list[tuple[SparkSession, str]] = []


def _delete(spark: SparkSession, path: str) -> None:
    if path.startswith("file:") and os.path.isdir("/" + path[5:].lstrip("/")):
        import shutil

        shutil.rmtree("/" + path[5:].lstrip("/"), ignore_errors=True)
    else:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def released() -> Iterator[None]:
    """Tables written inside are deleted at the end: for work that recurs, such as the batches of a stream."""
    before = len(_written)
    try:
        yield
    finally:
        mine = _written[before:]
        del _written[before:]
        for spark, path in mine:
            _delete(spark, path)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # the session may be gone already; local tables can still go
            continue
