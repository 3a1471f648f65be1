"""Six-user scenario: exact expectations (fixed clock), rule and exact forms."""
from pyspark.sql import functions as F

from conftest import AS_OF
from streakflow.config import Limits
from streakflow.operators import reconcile, rollups, sequential, streaks, validate
from streakflow.plans import ingest


def _counts(verdicts):
    return {r["status"]: r["n"] for r in verdicts.groupBy("status").agg(F.count("*").alias("n")).collect()}


def test_verdict_counts_rule_form(six_users):
    ing = ingest.ingest_batch(six_users, AS_OF, Limits())
    assert ing.verdicts.count() == 148
    assert _counts(ing.verdicts) == {"processed": 126, "duplicate": 12, "rate_limited": 5, "validation_error": 5}
    per_user = {r["user_id"]: r["n"] for r in ing.accepted.groupBy("user_id").agg(F.count("*").alias("n")).collect()}
    assert per_user == {"usr_alice": 9, "usr_bob": 6, "usr_carol": 4, "usr_dave": 3, "usr_eve": 4, "usr_frank": 100}


def test_streaks(six_users):
    acc = ingest.ingest_batch(six_users, AS_OF, Limits()).accepted
    st = {r["user_id"]: r for r in streaks.streaks(ingest.daily_activity(acc), "2025-03-29").collect()}
    assert (st["usr_alice"]["longest_streak"], st["usr_alice"]["current_streak"]) == (4, 2)
    assert st["usr_bob"]["current_streak"] == 4
    assert st["usr_carol"]["current_streak"] == 4
    assert st["usr_dave"]["current_streak"] == 3
    assert st["usr_eve"]["current_streak"] == 4
    assert st["usr_frank"]["current_streak"] == 1
    for r in st.values():
        assert r["longest_streak"] >= r["current_streak"] >= r["effective_streak"]


def test_points_reconcile_clean(six_users):
    acc = ingest.ingest_batch(six_users, AS_OF, Limits()).accepted
    rec = reconcile.reconcile_points(acc, rollups.point_balances(acc))
    assert rec.where("status <> 'MATCH'").count() == 0
    totals = {r["user_id"]: r["events_sum"] for r in rec.collect()}
    assert totals["usr_frank"] == 500 and totals["usr_dave"] == 15


def test_exact_rate_limiter(six_users):
    v = validate.validation(six_users, AS_OF, Limits()).where("reject_status is null")
    out = sequential.rate_limit_exact(v, Limits())
    denied = out.where(~F.col("allowed")).collect()
    assert len(denied) == 5 and {r["user_id"] for r in denied} == {"usr_frank"}


def test_fold_matches_rule_form_on_scenario(six_users):
    import pandas as pd
    v = validate.validation(six_users, AS_OF, Limits()).toPandas()
    rows = []
    for _, g in v.groupby("user_id"):
        rows += sequential.fold_user(sequential._sorted(g), sequential.UserState(), Limits())
    exact = pd.DataFrame(rows, columns=["row_id", "user_id", "status", "reason", "event_id", "original_event_id"])
    rule = ingest.ingest_batch(six_users, AS_OF, Limits()).verdicts.toPandas()
    m = exact.merge(rule, on="row_id", suffixes=("_x", "_r"))
    assert len(m) == 148
    assert (m.status_x == m.status_r).all()
    assert (m.event_id_x.fillna("") == m.event_id_r.fillna("")).all()


def test_history_duplicates(six_users):
    """Keys already in the accepted history are duplicates pointing at the stored event."""
    first = six_users.where("user_id = 'usr_dave' and row_id < 30")
    later = six_users.where("user_id = 'usr_dave'")
    hist = ingest.ingest_batch(first, AS_OF, Limits()).accepted
    v = ingest.ingest_batch(later, AS_OF, Limits(), history=hist).verdicts
    counts = _counts(v)
    stored = {r["event_id"] for r in hist.collect()}
    dup_targets = {r["original_event_id"] for r in v.where("status = 'duplicate'").collect()}
    assert counts.get("processed", 0) == 3 - len(stored)
    assert dup_targets <= stored | {r["event_id"] for r in v.where("status = 'processed'").collect()}
    assert counts["duplicate"] == 15 - counts.get("processed", 0)
