"""Lake tables that change together: versioned folders under one manifest.

A commit writes the partitions it replaces into new folders (``table/v=N/event_date=D``)
and then publishes ``versions/N.json`` by one rename. A manifest names the version of
every live partition of every table, and the versions whose ledger rows count. Readers
open the newest manifest and only the folders it names, so they see all tables and the
ledger before a commit or after it, whatever step a writer was lost at. What a lost
writer has left is overwritten by the next commit of that number.

A manifest holds one number a partition (dates, not rows). One writer at a time.
"""
from __future__ import annotations

import json
from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from streakflow.sources import sinks

LEDGER = "ledger"


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, oldest first."""
    return sorted(int(n[:-5]) for n in sinks.folder_names(spark, f"{root}/versions") if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """The newest manifest, or that of an older version; version 0 is the empty lake."""
    if version is None:
        version = max(numbers(spark, root), default=0)
    if not version:
        return {"version": 0, "tables": {}, "ledger": []}
    return json.loads(spark.read.text(f"{root}/versions/{version}.json", wholetext=True).first()[0])


def read(spark: SparkSession, root: str, held: Mapping, table: str) -> DataFrame | None:
    """A table as a manifest has it; None where it has no partition."""
    paths = [f"{root}/{table}/v={v}/{folder}" for folder, v in sorted(held["tables"].get(table, {}).items())]
    return spark.read.option("basePath", f"{root}/{table}").parquet(*paths).drop("v") if paths else None


def read_ledger(spark: SparkSession, root: str, held: Mapping) -> DataFrame | None:
    """The ledger's rows, with the version (``v``) that recorded them."""
    paths = [f"{root}/{LEDGER}/v={v}" for v in held["ledger"]]
    return spark.read.option("basePath", f"{root}/{LEDGER}").parquet(*paths) if paths else None


def folder_of(column: str, value) -> str:
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def commit(spark: SparkSession, root: str, before: Mapping, frames: Mapping[str, DataFrame], touched: Collection[str],
           ledger: DataFrame, partition_col: str = "event_date") -> dict:
    """Replaces the ``touched`` partitions (folder names) of all ``frames``, which hold
    all their rows, and records ``ledger``. Returns the published manifest."""
    version = before["version"] + 1
    tables = dict(before["tables"])
    for name, df in frames.items():
        place = f"{root}/{name}/v={version}"
        sinks.delete(spark, place)
        sinks.write_partitioned(df, place, partition_col)
        kept = {folder: v for folder, v in before["tables"].get(name, {}).items() if folder not in touched}
        tables[name] = kept | {f: version for f in sinks.folder_names(spark, place) if f.startswith(f"{partition_col}=")}
    ledger.write.mode("overwrite").parquet(f"{root}/{LEDGER}/v={version}")
    after = {"version": version, "tables": tables, "ledger": [*before["ledger"], version]}
    sinks.publish(spark, json.dumps(after), f"{root}/versions/{version}.json")
    return after


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Deletes partitions that none of the newest ``keep`` manifests names, and the older
    manifests, first, so that no manifest ever names what is gone."""
    found = numbers(spark, root)
    for version in found[:-keep]:
        sinks.delete(spark, f"{root}/versions/{version}.json")
    held = [manifest(spark, root, v) for v in found[-keep:]]
    for table in {t for m in held for t in m["tables"]}:
        named = {(v, folder) for m in held for folder, v in m["tables"].get(table, {}).items()}
        for place in sinks.folder_names(spark, f"{root}/{table}"):
            version = int(place.removeprefix("v="))
            if version <= found[-1]:
                for folder in sinks.folder_names(spark, f"{root}/{table}/{place}"):
                    if "=" in folder and (version, folder) not in named:
                        sinks.delete(spark, f"{root}/{table}/{place}/{folder}")
