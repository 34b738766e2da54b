"""Streams of files in several batches: late and repeated rows, restarts, and the tables they leave."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketry.streaming import windows

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double"


def event(i, day, minute=0, kind="view"):
    return (i, dt.datetime(2024, 1, 1) + dt.timedelta(days=day, minutes=minute), i % 3, kind, float(i))


def land(spark, folder, rows):
    windows.land(spark.createDataFrame(rows, SCHEMA).coalesce(1), folder, [F.lit(True)])


def days(spark, folder, out, progress):
    unique = windows.unique_events(windows.file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, 1), ["event_id"], "3 days")
    counts = windows.daily_counts(unique, None).select(F.col("window.start").cast("date").alias("day"), "event_type", "n", "total")
    return windows.finished(windows.upsert_to(counts, out, progress)), counts.schema


def state(spark, out, schema):
    return {(r.day.day, r.event_type): (r.n, r.total) for r in windows.current(spark, out, schema, ["day", "event_type"]).collect()}


def test_late_and_repeated_events(spark, tmp_path):
    folder, out, progress = (f"{tmp_path}/{x}" for x in ("in", "out", "progress"))
    land(spark, folder, [event(1, 0), event(2, 0), event(3, 1)])
    land(spark, folder, [event(4, 2), event(2, 0), event(5, 0)])  # a repeat, and one that is late but not too late
    land(spark, folder, [event(6, 9)])
    land(spark, folder, [event(7, 10)])
    land(spark, folder, [event(8, 1), event(9, 8)])  # event 8 is nine days behind: too late
    late, schema = days(spark, folder, out, progress)
    assert late == 1
    assert state(spark, out, schema) == {(1, "view"): (3, 8.0), (2, "view"): (1, 3.0), (3, "view"): (1, 4.0), (9, "view"): (1, 9.0), (10, "view"): (1, 6.0), (11, "view"): (1, 7.0)}


def test_a_run_goes_on_where_the_last_one_stopped(spark, tmp_path):
    folder, out, progress = (f"{tmp_path}/{x}" for x in ("in", "out", "progress"))
    land(spark, folder, [event(1, 0), event(2, 0)])
    days(spark, folder, out, progress)
    land(spark, folder, [event(2, 0), event(3, 0), event(4, 1)])  # event 2 is remembered across runs
    _, schema = days(spark, folder, out, progress)
    want = {(1, "view"): (3, 6.0), (2, "view"): (1, 4.0)}
    assert state(spark, out, schema) == want
    days(spark, folder, out, progress)  # nothing new: nothing changes
    assert state(spark, out, schema) == want


def test_a_batch_that_failed_is_written_again(spark, tmp_path, monkeypatch):
    folder, out, progress = (f"{tmp_path}/{x}" for x in ("in", "out", "progress"))
    land(spark, folder, [event(1, 0), event(2, 0)])
    land(spark, folder, [event(3, 0)])
    whole = windows._replace

    def broken(batch, number, path):
        whole(batch, number, path)
        if number == 1:
            raise OSError("lost after the write, before the commit")

    monkeypatch.setattr(windows, "_replace", broken)
    with pytest.raises(Exception, match="lost after the write"):
        days(spark, folder, out, progress)
    monkeypatch.setattr(windows, "_replace", whole)
    _, schema = days(spark, folder, out, progress)
    assert state(spark, out, schema) == {(1, "view"): (3, 6.0)}


def test_sessions_are_appended_once_they_are_over(spark, tmp_path):
    folder, out, progress = (f"{tmp_path}/{x}" for x in ("in", "out", "progress"))
    land(spark, folder, [event(3, 0, 0), event(6, 0, 20), event(9, 0, 90), event(4, 0, 5), event(30, 5)])
    stream = windows.sessions(windows.file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, 1), "30 minutes", "1 day").select("user_id", "session_window.start", "n")
    for _ in range(2):
        windows.append_to(stream, out, progress).awaitTermination()
        got = sorted((r.user_id, r.start.minute + 60 * r.start.hour, r.n) for r in spark.read.parquet(out).collect())
        assert got == [(0, 0, 2), (0, 90, 1), (1, 5, 1)]  # the last session is still open


def test_batches_use_the_same_functions(spark):
    rows = spark.createDataFrame([event(1, 0), event(1, 0), event(2, 0, 10), event(5, 0, 11)], SCHEMA)
    unique = windows.unique_events(rows, ["event_id"])
    assert sorted(r.n for r in windows.daily_counts(unique).collect()) == [3]
    assert sorted((r.user_id, r.n) for r in windows.sessions(unique).collect()) == [(1, 1), (2, 2)]
