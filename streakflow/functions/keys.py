from __future__ import annotations

from pyspark.sql import Column, functions as F


def idempotency_key(user_id: Column | str, event_type: Column | str, client_ts_text: Column | str) -> Column:
    """``user:type:timestamp`` key a client sends with every attempt."""
    cols = [F.col(c) if isinstance(c, str) else c for c in (user_id, event_type, client_ts_text)]
    return F.concat_ws(":", *cols)


def event_id_from_key(created_at: Column | str, key: Column | str) -> Column:
    """``yyyyMMddTHHmmss#xxxxxxxx``; the suffix is the first 8 hex digits
    of sha256(key), so a replay gives the same id (the original suffix is random)."""
    ts = F.col(created_at) if isinstance(created_at, str) else created_at
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(F.date_format(ts, "yyyyMMdd'T'HHmmss"), F.lit("#"), F.substring(F.sha2(k, 256), 1, 8))
