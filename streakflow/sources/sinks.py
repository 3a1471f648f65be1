"""Writers of the raw and curated lake.

Curated tables are partitioned by ``event_date`` and written with dynamic
partition overwrite: only the dates present in the written frame are
replaced, so rerunning a batch for the same dates leaves the same lake.
Rows are clustered by date and sorted by (date, user) inside files, the
layout later range reads by date and joins by user want.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from streakflow.config import checkpoint_dir


def write_partitioned(df: DataFrame, path: str, partition_col: str = "event_date",
                      sort_cols=("user_id",), max_records_per_file: int | None = None) -> None:
    """Overwrite only the partitions present in ``df``."""
    # range partitioning on (date, user): a date holding a third of the rows is
    # still cut into many tasks, and each file covers a narrow key range
    out = df.repartitionByRange(partition_col, *sort_cols).sortWithinPartitions(partition_col, *sort_cols)
    writer = (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy(partition_col))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read back, for
    plans whose branches would each compute it again. A lost executor costs a reread."""
    spark = df.sparkSession
    path = shared_path(spark, "staged")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no folder."""
    files, where = _file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    if files.exists(where):
        files.delete(where, True)


def publish(spark: SparkSession, text: str, path: str) -> None:
    """A small file that appears whole, by one rename. An existing one is an error."""
    files, where = _file_system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    out = files.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    if files.exists(where) or not files.rename(draft, where):
        files.delete(draft, False)
        raise FileExistsError(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a partitioned table has been written there. Any failure to find out
    (storage, permissions) is an error, never read as "no table"."""
    files, where = _file_system(spark, path)
    return files.exists(where) and any("=" in s.getPath().getName() for s in files.listStatus(where))


def drop_partitions(spark: SparkSession, path: str, partition_col: str, values: list[str]) -> None:
    """Removes partitions that a rebuild has left empty (dynamic overwrite only
    replaces partitions that get rows)."""
    for value in values:
        delete(spark, f"{path}/{partition_col}={value}")


def rewrite_partitions(df: DataFrame, touched: DataFrame, path: str, partition_col: str = "event_date") -> None:
    """``df`` holds all rows of the ``touched`` partitions (one value a row, so no more
    rows than the table has partitions): replaces them and drops the emptied ones."""
    write_partitioned(df, path, partition_col)
    empty = touched.join(df.select(partition_col).distinct(), partition_col, "left_anti").where(F.col(partition_col).isNotNull())
    drop_partitions(df.sparkSession, path, partition_col, [str(r[0]) for r in empty.toLocalIterator()])


def write_curated_events(enriched: DataFrame, path: str) -> None:
    """Curated bp_events."""
    write_partitioned(enriched, path)


def write_daily_summaries(summaries: DataFrame, path: str) -> None:
    """Daily summaries, one row per user-day."""
    write_partitioned(summaries, path)


def write_anomalies(anomalies: DataFrame, path: str) -> None:
    """Anomalous rows; an empty frame writes nothing and needs no count."""
    write_partitioned(anomalies, path)


def with_hour_partitions(df: DataFrame, ts: str = "created_at") -> DataFrame:
    """year/month/day/hour partition columns of the raw lake."""
    t = F.col(ts)
    return (df.withColumn("year", F.year(t)).withColumn("month", F.month(t))
              .withColumn("day", F.dayofmonth(t)).withColumn("hour", F.hour(t)))


def land_raw(stream: DataFrame, path: str, checkpoint: str, trigger_seconds: int = 300,
             max_records_per_file: int = 1_000_000, available_now: bool = False) -> StreamingQuery:
    """Continuous JSON -> Parquet landing, hour-partitioned, one
    file set per trigger (5 minutes by default); the checkpoint makes it
    exactly-once across restarts."""
    w = (with_hour_partitions(stream).writeStream.format("parquet")
         .option("path", path).option("checkpointLocation", checkpoint)
         .option("maxRecordsPerFile", max_records_per_file)
         .partitionBy("year", "month", "day", "hour").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
