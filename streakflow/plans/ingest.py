"""A batch of payloads -> verdict per attempt, accepted events, daily
activity and point balances (B2-B8, B11-B14, F8a, F7, D3, E2, E3, E7).

Order of checks per attempt, as in the reference: validation, rate limit,
timezone abuse, duplicate. Batch semantics (rule forms; the exact
arrival-order fold is the streaming path):

* the limiter counts every valid attempt of the user in the trailing hour,
  the current one and duplicates included;
* among attempts not limited, the first per idempotency key (by time, then
  arrival) is checked for timezone abuse; later copies of an accepted one, and
  keys already in the accepted history, are duplicates. A later copy of a
  blocked attempt is the same request again and blocked with it, so every
  duplicate names an event that exists;
* the rest are processed and get points, a replayable event id, the default
  source, an expiry and the user's local activity date.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from streakflow.config import DEFAULT_LIMITS, REQUIRED_FIELDS, STATUS_CODES, STATUSES, Limits
from streakflow.functions import award_points, event_id_from_key
from streakflow.operators import anomaly, rollups, validate
from streakflow.operators.windows import DAY_US, hot_keys, light_keys, trailing_sum
from streakflow.sources.sinks import staged


@dataclass
class Ingested:
    verdicts: DataFrame
    accepted: DataFrame
    verdicts_detail: DataFrame  # verdicts plus arrival and parsed event time


REASONS = {
    "rate_limited": "Rate limit exceeded",
    "tz_abuse": "Suspicious timezone change detected",
    "duplicate": "Event already processed",
    "processed": "Event processed",
}


def _numbered(payloads: DataFrame, as_of, limits: Limits) -> DataFrame:
    """Validated attempts with ``_valid`` and a row number (final once it is written)."""
    return validate.validation(payloads, as_of, limits).withColumns(
        {"_valid": F.col("reject_status").isNull(), "_row": F.monotonically_increasing_id()})


def decide(valid: DataFrame, limits: Limits = DEFAULT_LIMITS, history: DataFrame | None = None,
           order_col: str = "row_id", accepted_only: bool = False, attempts: DataFrame | None = None) -> DataFrame:
    """Valid attempts (with their row number ``_row``) with ``attempts_last_hour``, ``_passed``,
    ``_dup``, ``original_event_id`` and ``tz_abuse`` of their own; other columns are kept.
    ``accepted_only`` keeps the accepted ones. ``attempts``: a frame with at least the same
    users and keys that is cheaper to count them in.

    Where no user and no key holds more rows than a task may, the rules are windows over whole
    users and keys and nothing is written in between. Else the windows go by time buckets and
    the first attempt per key comes from a partial aggregate."""
    # rate limit over every valid attempt
    # day buckets: only attempts in the last hour of a day are copied as context;
    # users who hold much of a day are cut into minutes
    counted = valid if attempts is None else attempts
    light_users = light_keys(counted, ["user_id"])
    if not light_users and attempts is not None:
        valid = staged(valid)
    dense = None if light_users else hot_keys(valid, ["user_id"], "created_at")
    c = trailing_sum(valid, ["user_id"], "created_at", order_col, limits.rate_window_seconds * 1_000_000,
                     out="attempts_last_hour", bucket_us=DAY_US, dense=dense, whole=light_users)
    c = c.withColumn("_passed", F.col("attempts_last_hour") <= limits.rate_limit)

    # duplicates among the rest (D3): the first attempt per key wins; its event id is a
    # function of its time and key, so no second lookup is needed.
    if light_keys(counted, ["idempotency_key"]):
        first = F.min(F.when(F.col("_passed"), F.struct("created_at", order_col)))
        j = c.withColumn("_first", first.over(Window.partitionBy("idempotency_key")))
    else:
        c = staged(c)
        first = (c.where("_passed").groupBy("idempotency_key")
                  .agg(F.min(F.struct("created_at", order_col)).alias("_first")))
        j = c.join(first, "idempotency_key", "left")
    if history is not None:
        seen = history.groupBy("idempotency_key").agg(F.min("event_id").alias("_hist_id"))
        j = j.join(seen, "idempotency_key", "left")
    else:
        j = j.withColumn("_hist_id", F.lit(None).cast("string"))
    dup = F.col("_passed") & ((F.col(order_col) != F.col(f"_first.{order_col}")) | F.col("_hist_id").isNotNull())
    orig = F.when(dup, F.coalesce(F.col("_hist_id"),
                                  event_id_from_key(F.col("_first.created_at"), F.col("idempotency_key"))))
    j = j.withColumns({"_dup": dup, "original_event_id": orig}).drop("_first")
    first_try = F.col("_passed") & ~F.col("_dup")
    if accepted_only:
        j = j.where(first_try)

    # timezone abuse among first attempts (F7, rule form)
    if light_users:
        d = anomaly.timezone_abuse(j, limits, ts="created_at", tie=order_col,
                                   where=None if accepted_only else first_try, whole=True).drop("tz_changed")
    else:
        j = staged(j)
        abuse = anomaly.abusive_changes(j.where(first_try).select("_row", order_col, "user_id", "created_at", "timezone"),
                                        limits, ts="created_at", tie=order_col, dense=dense)
        d = j.join(abuse.select("_row", F.lit(True).alias("tz_abuse")), "_row", "left").withColumn(
            "tz_abuse", F.coalesce("tz_abuse", F.lit(False)))
    return d.where(~F.col("tz_abuse")) if accepted_only else d


def _awarded(limits: Limits) -> dict[str, Column]:
    """What the server adds to an accepted event."""
    return {
        "event_id": event_id_from_key("created_at", "idempotency_key"),
        "points_awarded": award_points("event_type"),
        "source": F.coalesce(F.col("source"), F.lit("unknown")),
        "ttl": F.unix_timestamp("created_at") + F.lit(limits.event_ttl_days * 86400),
    }


def classify(payloads: DataFrame, as_of, limits: Limits = DEFAULT_LIMITS,
             history: DataFrame | None = None, order_col: str = "row_id") -> DataFrame:
    """Every attempt with its ``status``. Only narrow rows of valid attempts go through the
    windows and the key joins; each step that two branches read is written once
    (``staged``), so nothing is computed again, and the verdicts meet the whole rows in one
    join at the end. Rejected attempts take no part; their ``attempts_last_hour`` is null."""
    v = staged(_numbered(payloads, as_of, limits))  # the row's number is written, so every reader sees the same one
    narrow = v.where("_valid").select("_row", order_col, "user_id", "created_at", "timezone", "idempotency_key")
    j = staged(decide(narrow, limits, history, order_col))
    # a later copy of a blocked attempt is blocked with it; only copies meet the blocked keys
    blocked = j.where("tz_abuse").select(F.col("idempotency_key").alias("_blocked_key")).distinct()
    copies = j.where("_dup").join(blocked, F.col("idempotency_key") == F.col("_blocked_key"), "left")
    j = copies.unionByName(j.where(~F.coalesce("_dup", F.lit(False))).withColumn("_blocked_key", F.lit(None).cast("string")))
    again = F.col("_blocked_key").isNotNull() & F.col("_hist_id").isNull()
    decided = j.select("_row", "attempts_last_hour", "_passed", "_dup",
                       F.when(~again, F.col("original_event_id")).alias("original_event_id"),
                       (F.col("tz_abuse") | again).alias("tz_abuse"))
    none = {f.name: F.lit(None).cast(f.dataType) for f in decided.schema if f.name != "_row"}
    tz = v.where("_valid").join(decided, "_row").unionByName(v.where(~F.col("_valid")).withColumns(none)).drop("_row")
    status = F.coalesce(
        F.col("reject_status"),
        F.when(~F.col("_passed"), F.lit("rate_limited")),
        F.when(F.col("tz_abuse"), F.lit("tz_abuse")),
        F.when(F.col("_dup"), F.lit("duplicate")),
        F.lit("processed"))
    reasons = F.create_map(*[F.lit(x) for kv in REASONS.items() for x in kv])
    codes = F.create_map(*[F.lit(x) for kv in STATUS_CODES.items() for x in kv])
    known = tz.withColumn("status", status)
    processed = F.col("status") == "processed"
    added = _awarded(limits)
    return known.withColumns({
        "reason": F.coalesce(F.col("reject_reason"), F.element_at(reasons, F.col("status"))),
        "http_status": F.element_at(codes, F.col("status")).cast("int"),
        **{name: F.when(processed, c) for name, c in added.items()},
        "source": F.when(processed, added["source"]).otherwise(F.col("source")),
    })


def accept(payloads: DataFrame, as_of, limits: Limits = DEFAULT_LIMITS, history: DataFrame | None = None,
           order_col: str = "row_id", columns: Sequence[str] | None = None, written: bool = False) -> DataFrame:
    """The accepted log alone, by the same rules as ``classify``: valid attempts go through
    ``decide`` with what ``columns`` (default: all of the log) are made of, so no row is
    looked up again at the end. ``written`` writes it once, for plans that read it several
    times; what the server adds is derived by the readers that use it."""
    columns = list(columns or ACCEPTED_COLUMNS)
    keys = ("user_id", "created_at", "timezone", "idempotency_key")
    made_of = {"points_awarded": "event_type", "event_id": None, "ttl": None}
    carried = dict.fromkeys(made_of.get(c, c) for c in columns if c not in keys and made_of.get(c, c))
    v = _numbered(payloads.select(order_col, *PAYLOAD_COLUMNS), as_of, limits).where("_valid")
    d = decide(v.select("_row", order_col, *keys, *carried), limits, history, order_col, True, payloads)
    d = d.select(order_col, *keys, *carried)
    if written:
        d = staged(d)
    return d.withColumns({name: c for name, c in _awarded(limits).items() if name in columns}).select(order_col, *columns)


#: What the verdicts and the accepted log are made of; nothing else is parsed or written.
PAYLOAD_COLUMNS = (*REQUIRED_FIELDS, "source", "received_at")
VERDICT_COLUMNS = ("user_id", "status", "reason", "event_id", "original_event_id", "http_status")
ACCEPTED_COLUMNS = ("user_id", "event_id", "event_type", "points_awarded", "source", "idempotency_key",
                    "client_timestamp", "created_at", "ttl", "timezone", "activity_date", "received_at")


def ingest_batch(payloads: DataFrame, as_of, limits: Limits = DEFAULT_LIMITS,
                 history: DataFrame | None = None, order_col: str = "row_id") -> Ingested:
    """Verdicts of all attempts and the accepted event log (one plan)."""
    return of_classified(classify(payloads.select(order_col, *PAYLOAD_COLUMNS), as_of, limits, history, order_col), order_col)


def of_classified(classified: DataFrame, order_col: str = "row_id") -> Ingested:
    """The tables that follow from ``classify`` (of a plan or of a written table)."""
    return Ingested(classified.select(order_col, *VERDICT_COLUMNS),
                    classified.where(F.col("status") == "processed").select(order_col, *ACCEPTED_COLUMNS),
                    classified.select(order_col, *VERDICT_COLUMNS, "received_at", "created_at"))


def ingest_report(verdicts: DataFrame) -> DataFrame:
    """Per user, attempts by status (fixed pivot values: one aggregate,
    no extra job to discover them) and the total."""
    p = verdicts.groupBy("user_id").pivot("status", list(STATUSES)).count().fillna(0)
    return p.select("user_id", *[F.col(s).cast("long").alias(s) for s in STATUSES],
                    sum(F.col(s) for s in STATUSES).cast("long").alias("total"))


def daily_activity(accepted: DataFrame) -> DataFrame:
    """E2 over accepted events by local date."""
    return rollups.daily_activity(accepted, "activity_date")


def point_balances(accepted: DataFrame) -> DataFrame:
    """E3 over accepted events."""
    return rollups.point_balances(accepted)
