"""Exact per-user folds (F8b, J3-J5): the reference decides each attempt
against state left by the previous ones (a counter whose expiry is refreshed
on every accepted attempt, the list of recent zone changes, the keys already
stored). That is inherently sequential per user, so it is written once as a
small pandas fold over one user's rows in order, and run by Spark:

* streaming: ``groupBy(user).applyInPandasWithState`` -- state per user is
  O(1) plus the keys and changes still inside their windows, and each
  micro-batch hands over only its own rows;
* batch: the limiter (F8b) has a parallel form in ``limiter``.

Rule forms that parallelise fully (F7, F8a, D3) live in ``anomaly`` and the
ingest plan; these folds are the exact, order-by-order semantics.
"""
from __future__ import annotations

import json
from dataclasses import dataclass, field

import pandas as pd
from streakflow.config import DEFAULT_LIMITS, Limits
from streakflow.operators.limiter import US, rate_limit_exact, rate_segments  # noqa: F401  (the batch form)



def event_id_text(created_at: pd.Timestamp, key: str) -> str:
    """Same id as ``functions.event_id_from_key`` (for rows decided in pandas)."""
    import hashlib
    return created_at.strftime("%Y%m%dT%H%M%S") + "#" + hashlib.sha256(key.encode()).hexdigest()[:8]


@dataclass
class UserState:
    """Everything the reference keeps per user between attempts."""

    rate_n: int = 0
    rate_last_ok: int | None = None          # micros of the last counted attempt
    zone: str | None = None                  # zone of the last processed event
    tz_changes: list = field(default_factory=list)   # micros of recorded changes
    keys: dict = field(default_factory=dict)          # key -> [event_id, micros]

    def to_row(self) -> tuple:
        return (self.rate_n, self.rate_last_ok, self.zone, json.dumps(self.tz_changes), json.dumps(self.keys))

    @classmethod
    def from_row(cls, row) -> "UserState":
        n, last, zone, ch, keys = row
        return cls(int(n), None if last is None or pd.isna(last) else int(last), zone,
                   json.loads(ch) if ch else [], json.loads(keys) if keys else {})


STATE_SCHEMA = "rate_n long, rate_last_ok long, zone string, tz_changes string, keys string"


def rate_step(st: UserState, t: int, limits: Limits) -> bool:
    """The limiter of the reference: a counter that expires ``ttl`` after the
    last counted attempt; at ``limit`` attempts are denied and change nothing."""
    ttl = limits.rate_window_seconds * US
    if st.rate_last_ok is not None and t - st.rate_last_ok >= ttl:
        st.rate_n = 0
    if st.rate_n >= limits.rate_limit:
        return False
    st.rate_n += 1
    st.rate_last_ok = t
    return True


def fold_user(rows: pd.DataFrame, st: UserState, limits: Limits = DEFAULT_LIMITS, clock: str = "created_at") -> list[tuple]:
    """Decide one user's attempts in order. ``rows`` has row_id, user_id,
    created_at, timezone, idempotency_key, reject_status, reject_reason, the
    ``clock`` that the time rules go by and, where a stored log was looked up,
    stored_event_id; it is sorted. Returns (row_id, user_id, status, reason,
    event_id, original_event_id)."""
    out = []
    tz_window = limits.tz_window_hours * 3600 * US
    key_keep = (limits.max_age_days * 24 + limits.max_future_hours) * 3600 * US
    for r in rows.itertuples(index=False):
        if r.reject_status is not None and not pd.isna(r.reject_status):
            out.append((r.row_id, r.user_id, r.reject_status, r.reject_reason, None, None))
            continue
        if pd.isna(r.created_at):
            out.append((r.row_id, r.user_id, "error", "unparsed timestamp", None, None))
            continue
        t = int(pd.Timestamp(getattr(r, clock)).value // 1000)
        if not rate_step(st, t, limits):
            out.append((r.row_id, r.user_id, "rate_limited", "Rate limit exceeded", None, None))
            continue
        old = st.zone if st.zone is not None else r.timezone
        st.tz_changes = [c for c in st.tz_changes if c > t - tz_window]
        if old != r.timezone and len(st.tz_changes) >= limits.tz_change_limit:
            out.append((r.row_id, r.user_id, "tz_abuse", "Suspicious timezone change detected", None, None))
            continue
        stored = getattr(r, "stored_event_id", None)
        seen = st.keys.get(r.idempotency_key) or (None if stored is None or pd.isna(stored) else [stored])
        if seen is not None:
            out.append((r.row_id, r.user_id, "duplicate", "Event already processed", None, seen[0]))
            continue
        eid = event_id_text(pd.Timestamp(r.created_at), r.idempotency_key)
        st.keys[r.idempotency_key] = [eid, t]
        if st.zone is not None and st.zone != r.timezone:
            st.tz_changes.append(t)
        st.zone = r.timezone
        out.append((r.row_id, r.user_id, "processed", "Event processed", eid, None))
    if rows.shape[0]:
        newest = max(v[1] for v in st.keys.values()) if st.keys else 0
        st.keys = {k: v for k, v in st.keys.items() if v[1] > newest - key_keep}
    return out


VERDICT_SCHEMA = ("row_id long, user_id string, status string, reason string, event_id string, "
                  "original_event_id string")
FOLD_INPUT = ("row_id", "user_id", "created_at", "timezone", "idempotency_key", "reject_status", "reject_reason")


def _sorted(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.sort_values(["created_at", "row_id"], kind="mergesort")


STREAM_OUTPUT = VERDICT_SCHEMA + ", created_at timestamp, activity_date date, event_type string, source string, " \
    "timezone string, idempotency_key string, client_timestamp string"
_CARRY = ("created_at", "activity_date", "event_type", "source", "timezone", "idempotency_key", "client_timestamp")


def stream_fold(limits: Limits = DEFAULT_LIMITS, clock: str = "received_at"):
    """The J1 state function for ``applyInPandasWithState``: one user's valid
    rows of a micro-batch in arrival order, folded against the stored state,
    which is written back. Order and time rules go by the arrival clock, so how
    the stream is cut into batches changes nothing. Payload columns needed
    downstream ride along with each verdict. State ends when the user has been
    silent longer than any rule looks back; older keys are in the stored log."""

    keep_ms = (limits.max_age_days * 24 + limits.max_future_hours) * 3600 * 1000

    def fn(key, pdfs, state):
        if state.hasTimedOut:
            # nothing the user did is still inside any rule window: drop the state
            state.remove()
            return
        st = UserState.from_row(state.get) if state.exists else UserState()
        batch = pd.concat(list(pdfs), ignore_index=True).sort_values([clock, "row_id"], kind="mergesort")
        rows = fold_user(batch, st, limits, clock)
        state.update(st.to_row())
        state.setTimeoutTimestamp(int(pd.Timestamp(batch[clock].max()).value // 1_000_000) + keep_ms)
        verdicts = pd.DataFrame(rows, columns=["row_id", "user_id", "status", "reason", "event_id",
                                               "original_event_id"])
        carried = batch[["row_id", *_CARRY]]
        yield verdicts.merge(carried, on="row_id", how="left")

    return fn


STREAK_STATE_SCHEMA = "current_streak long, longest_streak long, last_day long, version long"
STREAK_OUTPUT = ("user_id string, current_streak long, longest_streak long, last_activity_date date, "
                 "version long")


def streak_step(state: tuple | None, day: int, late: str = "ignore") -> tuple:
    """J3/F2 state machine on epoch days: same day is a no-op, the next day
    extends, any other day resets to 1. An older day is ignored
    (``late="ignore"``, repaired by recomputation) or, like the reference,
    resets and moves the last day back (``late="reference"``)."""
    if state is None:
        return (1, 1, day, 1)
    cur, longest, last, version = state
    if day == last or (day < last and late == "ignore"):
        return state
    cur = cur + 1 if day == last + 1 else 1
    return (cur, max(longest, cur), day, version + 1)


def streak_fold(late: str = "ignore"):
    """J3 state function: new active days of one user, applied in date order."""
    epoch = pd.Timestamp("1970-01-01")

    def fn(key, pdfs, state):
        days = pd.concat(list(pdfs), ignore_index=True)["activity_date"]
        st = tuple(int(x) for x in state.get) if state.exists else None
        for d in sorted({(pd.Timestamp(x) - epoch).days for x in days if not pd.isna(x)}):
            st = streak_step(st, d, late)
        if st is None:
            return
        state.update(st)
        cur, longest, last, version = st
        yield pd.DataFrame({"user_id": [key[0]], "current_streak": [cur], "longest_streak": [longest],
                            "last_activity_date": [(epoch + pd.Timedelta(days=last)).date()], "version": [version]})

    return fn
