"""Shared-folder work tables: the way multi-pass steps cut their lineage.

A step that reads its input several times writes it once as a Parquet table under the folder named by
``spark.checkpoint.dir``. The table survives the loss of any executor, keeps column pruning and filter
pushdown for the passes that follow, and is read with its known schema (no footer scan for inference).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a corner of the warehouse where it is unset.

    The setting is only read: it is a static one that a running session cannot change.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and warehouse.startswith(("file:", "/")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = warehouse.rstrip("/") + "/_work"
    return root.rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/barlake/{app}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of the written table."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_work_tables(spark: SparkSession) -> None:
    """Delete the work tables of this application; frames that still scan them become unreadable."""
    remove(spark, f"{shared_root(spark)}/barlake/{spark.sparkContext.applicationId}")


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True).close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    store = old.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(new.getParent())
    store.delete(new, True)
    if not store.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Names of what lies at the last step of a path pattern, in order."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    return sorted(status.getPath().getName() for status in found)


def small_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str | T.StructType) -> DataFrame:
    """A handful of driver-side rows as a local relation: its size is known to the optimizer, and reading
    it takes no job of its own."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not rows:
        return spark.createDataFrame([], fields)
    arrays = [pa.array(values) for values in zip(*rows, strict=True)]
    if any(pa.types.is_null(a.type) for a in arrays):  # nothing to tell the column's type from
        return spark.createDataFrame([tuple(r) for r in rows], fields)
    return spark.createDataFrame(pa.table(arrays, names=fields.fieldNames()), fields)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, form: str = "parquet"
) -> DataFrame:
    """Scan ``path`` by name against ``schema``; an absent path is an empty table.

    Columns that older files lack come back as null, so files written under earlier column sets
    unify by name without reading every footer first.
    """
    try:
        return spark.read.schema(schema).format(form).load(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)
