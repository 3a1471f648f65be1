"""Loading the driver tables and deriving the engine's inputs from them.

Every registered query starts here: the driver's Parquet tables are read
with column pruning, re-shaped by the adapter, and the derived frames are
built by the engine's own operators, so the work grows with the tables.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType, TimestampNTZType, TimestampType

from streakflow.config import configure
from streakflow.functions import ts_text
from streakflow.sources import adapter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def adapted(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return adapter.adapt_events(table(spark, sf_dir, "events"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.raw_events(adapted(spark, sf_dir))


def user_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return adapter.user_dim(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"))


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Stable output types for comparison: instants as UTC text with
    microseconds, doubles rounded."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = ts_text(c)
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.round(c, digits)
        cols.append(c.alias(f.name))
    return df.select(*cols)
