"""The key index names every date of a key, reads the batch's buckets only, and survives replays."""
import datetime as dt

from streakflow.operators import key_index

SCHEMA = "idempotency_key string, event_date date"


def day(d):
    return dt.date(2024, 1, d)


def test_index_names_the_dates_of_a_batch(spark, scratch):
    path = f"{scratch}/keys"
    rows = [(f"k{i}", day(1 + i % 20)) for i in range(400)] + [(None, day(30))]
    key_index.add_keys(spark.createDataFrame(rows, SCHEMA).repartition(3), path)
    key_index.add_keys(spark.createDataFrame([("k5", day(25))], SCHEMA), path)  # moved
    key_index.add_keys(spark.createDataFrame([("k5", day(25))], SCHEMA), path)  # and replayed
    batch = spark.createDataFrame([("k5", day(28)), ("k7", day(28)), ("new", day(28)), (None, day(28))], SCHEMA)
    found = key_index.dates_of(batch, path)
    assert {r.event_date for r in found.collect()} == {day(6), day(25), day(8)}
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [bucket" in plan
    before = spark.read.parquet(path).distinct().count()
    for _ in range(2):
        key_index.compact(spark, path)
        assert spark.read.parquet(path).count() == before == 401
    assert {r.event_date for r in key_index.dates_of(batch, path).collect()} == {day(6), day(25), day(8)}
