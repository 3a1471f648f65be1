"""Scans and shapes.

Scans declare their schema (no inference) and express partition and null
filters as plain predicates so they reach the Parquet scan as
``PartitionFilters`` / ``PushedFilters``; projections prune columns.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType, DataType, DecimalType, DoubleType, LongType, MapType, StringType, StructField, StructType,
)

from streakflow import schemas


def read_raw(spark: SparkSession, path: str, since: dt.datetime | str | None = None,
             until: dt.datetime | str | None = None, schema: StructType | None = None) -> DataFrame:
    """A1: raw events under ``year=/month=/day=/hour=`` partitions, optionally
    only those created in [since, until) (UTC unless an offset is given). The
    hours are predicates on the partition columns, so whole directories are
    pruned; parts of an hour are decided by ``created_at``."""
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    part_cols = {"year", "month", "day", "hour"}
    if part_cols <= set(df.columns):
        hour_key = (F.col("year").cast("int") * 1000000 + F.col("month").cast("int") * 10000
                    + F.col("day").cast("int") * 100 + F.col("hour").cast("int"))

        def _utc(t):
            t = dt.datetime.fromisoformat(str(t))
            return t.astimezone(dt.timezone.utc).replace(tzinfo=None) if t.tzinfo else t

        def _k(t):
            return ((t.year * 100 + t.month) * 100 + t.day) * 100 + t.hour

        created = F.col("created_at").cast("timestamp")
        if since is not None:
            since = _utc(since)
            df = df.where(hour_key >= _k(since))
            if since != since.replace(minute=0, second=0, microsecond=0):
                df = df.where(created >= F.lit(f"{since}").cast("timestamp"))
        if until is not None:
            until = _utc(until)
            if until == until.replace(minute=0, second=0, microsecond=0):
                df = df.where(hour_key < _k(until))
            else:
                df = df.where((hour_key <= _k(until)) & (created < F.lit(f"{until}").cast("timestamp")))
    return df


def parse_payload(bodies: DataFrame, body_col: str = "body", schema: StructType = schemas.PAYLOAD) -> DataFrame:
    """A2: JSON request bodies -> typed payload columns; a body that is not a
    JSON object keeps its text in ``corrupt_body``."""
    marked = StructType([*schema.fields, StructField("_corrupt", StringType())])
    parsed = F.from_json(F.col(body_col), marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    whole = F.col("_p").isNotNull() & F.col("_p._corrupt").isNull() & F.col("_body").rlike(r"^\s*\{")
    rest = [c for c in bodies.columns if c != body_col]
    return bodies.select(*rest, parsed.alias("_p"), F.col(body_col).alias("_body")).select(
        *rest, *[F.when(whole, F.col(f"_p.{f.name}")).alias(f.name) for f in schema.fields],
        F.when(~whole, F.col("_body")).alias("corrupt_body"),
    )


def read_user_dim(spark: SparkSession, path: str) -> DataFrame:
    """A3: the four dimension columns only (column pruning at the scan)."""
    return spark.read.parquet(path).select("user_id", "country", "signup_date", "user_segment")


def cdc_inserts(records: DataFrame) -> DataFrame:
    """A4: INSERT change records of the daily-activity table, flattened from
    typed attribute images (``{"S": value}``). Works on batch and streaming
    frames alike."""
    img = "dynamodb.NewImage"
    return records.where(F.col("eventName") == "INSERT").select(
        F.col(f"{img}.user_id.S").alias("user_id"),
        F.to_date(F.col(f"{img}.activity_date.S")).alias("activity_date"),
        F.coalesce(F.col(f"{img}.first_event_id.S"), F.lit("unknown")).alias("first_event_id"),
    )


def hour_partitions(raw: DataFrame) -> DataFrame:
    """Distinct (year, month, day, hour) partitions present in a raw frame."""
    return raw.select("year", "month", "day", "hour").distinct()


def listed_hours(spark: SparkSession, path: str) -> DataFrame:
    """The hour partitions under a raw path with their folders, from the file
    system's listing: no row is read."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/year=*/month=*/day=*/hour=*")
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    folders = [status.getPath().toString() for status in found]
    rows = [(*(int(step.split("=")[1]) for step in folder.split("/")[-4:]), folder) for folder in folders]
    return spark.createDataFrame(rows, "year int, month int, day int, hour int, folder string")


def new_partitions(present: DataFrame, ledger: DataFrame) -> DataFrame:
    """Partitions not yet recorded in the processing ledger (anti join)."""
    return present.join(ledger.select("year", "month", "day", "hour"), ["year", "month", "day", "hour"], "left_anti")


def stage_partition(curated: DataFrame, event_date, loaded_at,
                    columns: Sequence[str] = schemas.FACT_LOAD_COLUMNS) -> DataFrame:
    """A10: one curated ``event_date`` in the staging (= fact) shape. The date
    predicate prunes the partition at the scan."""
    day = curated.where(F.col("event_date") == F.lit(str(event_date)).cast("date"))
    return align_columns(day, schemas.FACT_BP_EVENTS, loaded_at, columns)


def snapshot_streaks(state: DataFrame, as_of_date, loaded_at) -> DataFrame:
    """Streak state -> ``dim_user_streaks`` rows of one snapshot date."""
    return align_columns(state.withColumn("snapshot_date", F.lit(str(as_of_date)).cast("date")),
                         schemas.DIM_USER_STREAKS, loaded_at)


def align_columns(df: DataFrame, target: StructType, loaded_at=None,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Select the target's columns that are present (cast to the
    target type), fill absent ones with typed nulls, stamp ``loaded_at``."""
    wanted = set(columns) if columns is not None else None
    have = set(df.columns)
    out = []
    for f in target.fields:
        if f.name == "loaded_at" and loaded_at is not None:
            out.append(F.lit(str(loaded_at)).cast("timestamp").alias("loaded_at"))
        elif f.name in have and (wanted is None or f.name in wanted):
            out.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


def _normalised_type(t: DataType) -> DataType:
    if isinstance(t, DecimalType):
        return LongType() if t.scale == 0 else DoubleType()
    if isinstance(t, StructType):
        return StructType([StructField(f.name, _normalised_type(f.dataType), f.nullable) for f in t.fields])
    if isinstance(t, ArrayType):
        return ArrayType(_normalised_type(t.elementType), t.containsNull)
    if isinstance(t, MapType):
        return MapType(t.keyType, _normalised_type(t.valueType), t.valueContainsNull)
    return t


def normalise_numbers(df: DataFrame) -> DataFrame:
    """Decimals with scale 0 -> long, other decimals -> double, also
    inside structs, arrays and maps (a schema walk; the cast is one
    projection)."""
    return df.select(*[
        (F.col(f.name).cast(_normalised_type(f.dataType)) if _normalised_type(f.dataType) != f.dataType
         else F.col(f.name)).alias(f.name)
        for f in df.schema.fields])
