"""The lake: append-only bronze and quarantine, run manifests, gold tables.

Files lie under ``ingest_date=.../run_id=...``. A run only ever replaces its own partition, so a
driver that retries a run after a failure leaves no doubled rows, and no run rewrites another's files.

Two small tables spare reads of bronze. The state holds the newest landed session and the vendor of every ticker; each
landing advances it, and it is built again from bronze where it is missing or a run was taken back. The catalogue holds
the column types of every run's files, read from their footers once, so that files of other numeric types are scanned
as what they are and united by name.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions.columns import utc_literal
from barlake.schema import BRONZE_SCHEMA, PARTITION_FIELDS, QUARANTINE_SCHEMA
from barlake.sources.versions import newest_version, write_version
from barlake.workspace import folders, read_table, remove, small_frame, table_exists

# The fields of a run manifest.
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("rows_fetched", T.LongType()),
        T.StructField("rows_landed", T.LongType()),
        T.StructField("rows_quarantined", T.LongType()),
        T.StructField("duplicates_dropped", T.LongType()),
        T.StructField("windows_path", T.StringType()),
        T.StructField("bronze_path", T.StringType()),
        T.StructField("quarantine_path", T.StringType()),
        T.StructField("duration_s", T.DoubleType()),
    ]
)


STATE_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("watermark", T.DateType()),
    ]
)
CATALOGUE_SCHEMA = "run string, types string"


class MixedSources(ValueError):
    """The lake already holds another vendor's bars."""


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str

    @property
    def bronze_path(self) -> str:
        return f"{self.root}/bronze/prices"

    @property
    def quarantine_path(self) -> str:
        return f"{self.root}/quarantine/prices"

    @property
    def runs_path(self) -> str:
        return f"{self.root}/_runs"

    @property
    def state_path(self) -> str:
        return f"{self.runs_path}/state"

    def mart_path(self, table: str) -> str:
        return f"{self.root}/marts/{table}"

    def mart(self, table: str) -> DataFrame:
        """The newest checked version of a mart."""
        newest = newest_version(self.spark, self.mart_path(table))
        if newest is None:
            raise FileNotFoundError(f"{self.root} has no {table} yet")
        return self.spark.read.parquet(newest)

    def bronze(self) -> DataFrame:
        """Every landed observation: one scan for all files of the declared types, one more for each other set of types,
        widened to the declared ones and united by column name. Columns that files lack are null."""
        odd = {}
        for run, types in self.catalogue().items():
            if types != DECLARED:
                odd.setdefault(types, []).append(run)
        whole = read_table(self.spark, self.bronze_path, BRONZE_SCHEMA)
        if not odd:
            return whole
        key = F.concat_ws("/", F.concat(F.lit("ingest_date="), F.col("ingest_date").cast("string")), F.concat(F.lit("run_id="), F.col("run_id")))
        parts = [whole.where(~key.isin([unquote(run) for runs in odd.values() for run in runs]))]
        for types, runs in odd.items():
            held = dict(part.split(" ", 1) for part in types.split(";") if part)
            fields = [T.StructField(f.name, _type(held[f.name])) for f in BRONZE_SCHEMA.fields if f.name in held]
            scan = self.spark.read.schema(T.StructType([*fields, *PARTITION_FIELDS])).option("basePath", self.bronze_path)
            rows = scan.parquet(*[f"{self.bronze_path}/{run}" for run in runs])
            columns = [
                (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in BRONZE_SCHEMA.fields
            ]
            parts.append(rows.select(*columns))
        return reduce(DataFrame.unionByName, parts)

    def catalogue(self) -> dict[str, str]:
        """Column types by run, as ``ingest_date=.../run_id=...``; footers of runs that are new are read, one a run."""
        path = f"{self.runs_path}/types"
        known = {r["run"]: r["types"] for r in read_table(self.spark, path, T.StructType.fromDDL(CATALOGUE_SCHEMA), "json").collect()}
        present = _run_folders(self.spark, self.bronze_path)
        new = [(run, _footer_types(self.spark, f"{self.bronze_path}/{run}")) for run in present if run not in known]
        if new:
            small_frame(self.spark, new, CATALOGUE_SCHEMA).coalesce(1).write.mode("append").json(path)
        return {run: types for run, types in (known | dict(new)).items() if run in set(present)}

    def quarantine(self) -> DataFrame:
        return read_table(self.spark, self.quarantine_path, QUARANTINE_SCHEMA)

    def manifests(self) -> DataFrame:
        return read_table(self.spark, f"{self.runs_path}/manifest", MANIFEST_SCHEMA, "json")

    def state(self) -> DataFrame:
        """ticker, source and the newest landed session (watermark), without a look at bronze but for the first time."""
        newest = newest_version(self.spark, self.state_path)
        return self.rebuild_state() if newest is None else self.spark.read.schema(STATE_SCHEMA).parquet(newest)

    def rebuild_state(self) -> DataFrame:
        return write_version(_newest(self.bronze()).select(*STATE_SCHEMA.fieldNames()), self.state_path)

    def sources(self) -> DataFrame:
        """Distinct vendors already landed."""
        return self.state().select("source").distinct()

    def refuse_other_sources(self, name: str) -> None:
        """One vendor per lake: the latest-wins step would otherwise swap one for the other."""
        other = self.sources().where(F.col("source") != name).limit(1).collect()
        if other:
            raise MixedSources(f"{self.root} holds bars of {other[0]['source']!r}, so it can't take those of {name!r}")

    def watermarks(self) -> DataFrame:
        """Newest landed session per ticker. Quarantined bars do not count, so they are fetched again."""
        return self.state().groupBy("ticker").agg(F.max("watermark").alias("watermark"))

    def clear_run(self, ingest_date: date, run_id: str) -> None:
        """Remove what an earlier attempt at this run has landed or set aside; the state is then built anew."""
        own = f"ingest_date={ingest_date}/run_id={run_id}"
        if table_exists(self.spark, f"{self.bronze_path}/{own}"):
            remove(self.spark, self.state_path)
        for table in (self.bronze_path, self.quarantine_path):
            remove(self.spark, f"{table}/{own}")

    def land(self, valid: DataFrame) -> None:
        """Append valid bars that carry lineage and partition columns, and advance the state by them."""
        valid = valid.select(*BRONZE_SCHEMA.fieldNames())
        runs = valid.select("ingest_date", "run_id").distinct().collect()  # one row per run
        folders = [f"{self.bronze_path}/ingest_date={r['ingest_date']}/run_id={r['run_id']}" for r in runs]
        if any(table_exists(self.spark, folder) for folder in folders):
            remove(self.spark, self.state_path)  # rows are replaced: build it again when it is asked for
        before = self.state() if newest_version(self.spark, self.state_path) else None
        _write_runs(valid, self.bronze_path)
        if before is not None:
            merged = before.unionByName(_newest(valid)).groupBy("ticker", "source").agg(F.max("watermark").alias("watermark"))
            write_version(merged.select(*STATE_SCHEMA.fieldNames()), self.state_path)

    def set_aside(self, rejected: DataFrame) -> None:
        _write_runs(rejected, self.quarantine_path)

    def write_manifest(self, manifest: dict) -> None:
        """One JSON row per run, also for a run that fetched nothing."""
        row = tuple(manifest.get(name) for name in MANIFEST_SCHEMA.fieldNames())
        (
            self.spark.createDataFrame([row], MANIFEST_SCHEMA)
            .coalesce(1)
            .write.mode("overwrite")
            .json(f"{self.runs_path}/manifest/run={manifest['run_id']}")
        )


def _newest(bars: DataFrame) -> DataFrame:
    return bars.groupBy("ticker", "source").agg(F.max("date").alias("watermark"))


#: Types of the files that ``land`` writes; partition columns are in the path.
DECLARED = ";".join(f"{f.name} {f.dataType.simpleString()}" for f in BRONZE_SCHEMA.fields if f not in PARTITION_FIELDS)


def _type(name: str) -> T.DataType:
    return T.StructType.fromDDL(f"x {name}").fields[0].dataType


def _run_folders(spark: SparkSession, path: str) -> list[str]:
    days = folders(spark, f"{path}/ingest_date=*")
    return [f"{day}/{run}" for day in days for run in folders(spark, f"{path}/{day}/run_id=*")]


def _footer_types(spark: SparkSession, folder: str) -> str:
    """Names and types of the declared columns in the files of one run, which one writer made."""
    held = {f.name: f.dataType.simpleString() for f in spark.read.parquet(folder).schema.fields}
    return ";".join(f"{f.name} {held[f.name]}" for f in BRONZE_SCHEMA.fields if f.name in held)


def _write_runs(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date", "run_id")
        .parquet(path)
    )


def stamp(df: DataFrame, source: str, run_id: str, ingest_date: date, ingested_at: datetime) -> DataFrame:
    """Lineage and partition columns of one run."""
    return df.withColumns(
        {
            "ingested_at": utc_literal(ingested_at),
            "source": F.lit(source),
            "ingest_date": F.lit(ingest_date),
            "run_id": F.lit(run_id),
        }
    )
