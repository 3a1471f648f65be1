"""Driver contract: entry smoke, registry consistency, a sample of oracle checks at sf0.001."""
import datetime as dt
import hashlib

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_points" in df.columns and "event_types" in df.columns


def test_registry_consistent():
    from streakflow.plans.oracle import ORACLE
    from streakflow.plans.queries import QUERIES

    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert set(QUERIES) <= set(qs) and set(ORACLE) <= set(sql)


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ["daily_summaries", "ingest_verdicts", "streaks", "leaderboard_by_country",
                                  "merge_by_key", "anomaly_log", "reconcile_points", "weekly_streak_stats"])
def test_oracle_sample(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(drows)
    assert _digest(df.columns, rows) == _digest(rel.columns, drows)
