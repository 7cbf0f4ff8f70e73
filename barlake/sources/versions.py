"""Tables that are replaced as a whole: a new version is written beside the old one and read only once it is committed.

A version is a folder ``version=<number>`` of its own; the empty file ``_COMMITTED`` in it is its commit. Readers take
the newest committed version, so a writer that fails, or whose checks fail, leaves the table as it was. The version
before the newest is kept for readers that are under way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barlake.workspace import folders, remove, table_exists, touch

COMMITTED = "_COMMITTED"


def newest_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest committed version, or nothing."""
    kept = _committed(spark, path)
    return f"{path}/{kept[-1]}" if kept else None


def write_version(df: DataFrame, path: str, check: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """Write ``df`` as the next version, check what was written, commit it and return a scan of it.

    ``check`` raises if the version must not be read; nothing is committed then.
    """
    spark = df.sparkSession
    present = folders(spark, f"{path}/version=*")
    number = max((int(name.partition("=")[2]) for name in present), default=-1) + 1
    folder = f"{path}/version={number:09d}"
    df.write.mode("overwrite").parquet(folder)
    written = spark.read.schema(df.schema).parquet(folder)
    if check is not None:
        check(written)
    touch(spark, f"{folder}/{COMMITTED}")
    kept = _committed(spark, path)[-2:]
    for name in present:
        if name not in kept:
            remove(spark, f"{path}/{name}")
    return written


def _committed(spark: SparkSession, path: str) -> list[str]:
    return [name for name in folders(spark, f"{path}/version=*") if table_exists(spark, f"{path}/{name}/{COMMITTED}")]
