import datetime as dt
import os
import sys
import tempfile
from zoneinfo import ZoneInfo

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from streakflow.config import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="streakflow-tests-")
    os.environ.setdefault("STREAKFLOW_SCRATCH", scratch)
    s = local_session("*", app="streakflow-tests", shuffle_partitions=8)
    yield s


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="streakflow-run-")


UTC = dt.timezone.utc
T = dt.datetime(2025, 3, 29, 12, 0, tzinfo=UTC)
AS_OF = "2025-03-29 18:00:00"


def _payload(rows, user, etype, ts, zone, key=None, source="mobile_app"):
    local = ts.astimezone(ZoneInfo(zone))
    key = key or f"{user}:{etype}:{local.isoformat()}"
    rows.append({"row_id": len(rows), "user_id": user, "event_type": etype, "client_timestamp": local.isoformat(),
                 "timezone": zone, "idempotency_key": key, "source": source,
                 "received_at": ts.replace(tzinfo=None)})


def local_ts(zone, y, m, d, hh, mm):
    return dt.datetime(y, m, d, hh, mm, tzinfo=ZoneInfo(zone)).astimezone(UTC)


def six_user_rows():
    """The six-user scenario (FIXTURES.md §3), in send order."""
    rows = []
    sp = "America/Sao_Paulo"
    # alice: local days 23-26, gap 27, 28-29; two events on 23, 24, 28
    for d in (23, 24, 25, 26, 28, 29):
        _payload(rows, "usr_alice", "CONVERSATION_START", local_ts(sp, 2025, 3, d, 9, 0), sp)
        if d in (23, 24, 28):
            _payload(rows, "usr_alice", "TOOL_USE", local_ts(sp, 2025, 3, d, 14, 0), sp)
    # bob: 23:58 Tokyo on 26-29, 00:02 on 27 and 28
    tk = "Asia/Tokyo"
    for d in (26, 27, 28, 29):
        _payload(rows, "usr_bob", "DAILY_OPEN", local_ts(tk, 2025, 3, d, 23, 58), tk)
        if d in (27, 28):
            _payload(rows, "usr_bob", "TOOL_USE", local_ts(tk, 2025, 3, d, 0, 2), tk)
    # carol: London, 12:00 UTC on 27-30 (clocks change on the 30th)
    for d in (27, 28, 29, 30):
        _payload(rows, "usr_carol", "SHARE_RESULT", dt.datetime(2025, 3, d, 12, 0, tzinfo=UTC), "Europe/London")
    # dave: three keys sent five times each, 10:00 UTC on 27-29
    ny = "America/New_York"
    for d in (27, 28, 29):
        ts = dt.datetime(2025, 3, d, 10, 0, tzinfo=UTC)
        for _ in range(5):
            _payload(rows, "usr_dave", "TOOL_USE", ts, ny)
    # eve: 00:30 Auckland on 27-30 (11:30 UTC of the previous date)
    ak = "Pacific/Auckland"
    for d in (27, 28, 29, 30):
        _payload(rows, "usr_eve", "DAILY_OPEN", local_ts(ak, 2025, 3, d, 0, 30), ak)
    # frank: 105 valid 30 s apart, then 5 invalid types
    base = dt.datetime(2025, 3, 29, 11, 0, tzinfo=UTC)
    for i in range(105):
        _payload(rows, "usr_frank", "TOOL_USE", base + dt.timedelta(seconds=30 * i), sp)
    for i in range(5):
        _payload(rows, "usr_frank", "INVALID_TYPE", base + dt.timedelta(minutes=55 + i), sp)
    return rows


PAYLOAD_DDL = ("row_id long, user_id string, event_type string, client_timestamp string, timezone string, "
               "idempotency_key string, source string, received_at timestamp")


@pytest.fixture
def six_users(spark):
    import pandas as pd
    from pyspark.sql import functions as F
    pdf = pd.DataFrame(six_user_rows())
    df = spark.createDataFrame(pdf, PAYLOAD_DDL)
    return df.withColumn("metadata", F.lit(None).cast("map<string,string>"))
