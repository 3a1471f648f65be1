"""Constants, thresholds and session settings.

Every operator takes its thresholds as arguments; the defaults live here.
"""
from __future__ import annotations

import os
import tempfile
from dataclasses import dataclass

from pyspark.sql import SparkSession

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Points per accepted event type.
POINTS_MAP = {
    "CONVERSATION_START": 10,
    "TOOL_USE": 5,
    "DAILY_OPEN": 1,
    "SHARE_RESULT": 15,
}
VALID_EVENT_TYPES = tuple(POINTS_MAP)
# Required payload fields, checked in this order; the first missing one is named.
REQUIRED_FIELDS = ("user_id", "event_type", "client_timestamp", "timezone", "idempotency_key")
# Ingest verdicts and their HTTP codes.
STATUS_CODES = {
    "processed": 200,
    "duplicate": 200,
    "validation_error": 400,
    "rate_limited": 429,
    "tz_abuse": 403,
    "error": 500,
}
STATUSES = tuple(STATUS_CODES)
# Streak buckets of the distribution view: (label, low, high) inclusive.
STREAK_BUCKETS = (
    ("0 (inactive)", 0, 0),
    ("1-3 days", 1, 3),
    ("4-7 days", 4, 7),
    ("8-14 days", 8, 14),
    ("15-30 days", 15, 30),
)
STREAK_BUCKET_ELSE = "30+ days"
DEFAULT_SOURCE = "unknown"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Limits:
    """Thresholds of validation, limiting and anomaly rules."""

    max_future_hours: int = 24
    max_age_days: int = 7
    rate_limit: int = 100
    rate_window_seconds: int = 3600
    tz_change_limit: int = 2
    tz_window_hours: int = 24
    point_min: int = 0
    point_max: int = 100
    event_ttl_days: int = 90
    audit_ttl_days: int = 365
    stream_dedup_seconds: int = 3600
    leaderboard_size: int = 100
    history_days: int = 30
    spike_factor: float = 10.0
    midnight_minutes: int = 5
    duplicate_pattern_min: int = 5
    max_auto_fix: int = 1
    update_lag_seconds: int = 5
    error_rate_alert: float = 0.01


DEFAULT_LIMITS = Limits()

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the session settings every operator relies on (UTC dates, AQE,
    dynamic partition overwrite). Idempotent; leaves everything else alone."""
    for key, value in SESSION_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Uses ``spark.checkpoint.dir`` when the cluster sets it. A local master
    (tests) may leave it unset and gets a temporary folder; anywhere else that
    is an error, since executors do not share one machine's folders.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="streakflow-checkpoints-", dir=os.environ.get("STREAKFLOW_SCRATCH"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def local_session(cores: int | str = "*", app: str = "streakflow", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the benchmark (local mode, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("STREAKFLOW_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scale_conf(input_bytes: int, total_cores: int, target_bytes: int = 256 << 20,
               max_partitions: int = 100_000) -> dict:
    """Settings for a cluster run over ``input_bytes`` of event data.

    The widest shuffles of the ingest chain move about the attempt table
    (the trailing windows add only boundary copies), so shuffle partitions
    are sized for ``target_bytes`` each, at least two per core and at most
    ``max_partitions`` (beyond that the driver's map-output bookkeeping, not
    the executors, becomes the limit; partitions grow instead). AQE then
    coalesces small partitions to the same target and splits skewed join
    partitions above four times it. Scans split at the target too."""
    parts = max(2 * total_cores, -(-input_bytes // target_bytes))
    parts = min(parts, max_partitions)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }
