from __future__ import annotations

from pyspark.sql import Column, functions as F

# ISO-8601 date and time, both whole (fixed pattern); the zone designator is Z,
# +hh:mm, -hhmm or +hh and follows the time only.
ISO_DATETIME = r"\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?"
ISO_OFFSET = r"(Z|z|[+-]\d{2}(:?\d{2})?)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_offset(text: Column | str) -> Column:
    """True when an ISO timestamp string carries a UTC offset."""
    return _c(text).rlike(f"^{ISO_DATETIME}{ISO_OFFSET}$")


def parse_client_ts(text: Column | str) -> Column:
    """ISO-8601 date and time to an instant (``timestamp``); null when it is
    neither (a date or a time alone too). Without an offset: UTC (the session zone)."""
    return F.when(_c(text).rlike(f"^{ISO_DATETIME}{ISO_OFFSET}?$"), _c(text).try_cast("timestamp"))


def local_date(instant: Column | str, zone: Column | str) -> Column:
    """Calendar date of an instant in an IANA zone. ``zone`` must already be
    valid (see ``safe_zone``): Spark raises on an unknown zone."""
    return F.to_date(F.from_utc_timestamp(_c(instant), _c(zone)))


def local_time(instant: Column | str, zone: Column | str) -> Column:
    """Wall-clock timestamp of an instant in a zone (session zone UTC)."""
    return F.from_utc_timestamp(_c(instant), _c(zone))


def epoch_micros(instant: Column | str) -> Column:
    """Microseconds since the epoch: the single numeric order key that
    range frames need."""
    return F.unix_micros(_c(instant).cast("timestamp"))


def ts_text(instant: Column | str) -> Column:
    """Canonical text of an instant, microsecond precision, UTC."""
    return F.date_format(_c(instant), "yyyy-MM-dd HH:mm:ss.SSSSSS")
