"""Column-level helpers: every function returns a ``Column`` built from
built-in Spark expressions, so it stays inside whole-stage codegen."""
from streakflow.functions.buckets import streak_bucket
from streakflow.functions.keys import event_id_from_key, idempotency_key
from streakflow.functions.points import award_points
from streakflow.functions.timefns import (
    epoch_micros, has_offset, local_date, parse_client_ts, ts_text,
)
from streakflow.functions.zones import is_valid_zone, safe_zone, valid_zones

__all__ = [
    "streak_bucket", "event_id_from_key", "idempotency_key", "award_points",
    "epoch_micros", "has_offset", "local_date", "parse_client_ts", "ts_text",
    "is_valid_zone", "safe_zone", "valid_zones",
]
