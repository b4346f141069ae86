import os
from datetime import timedelta, timezone

import pytest
from pyspark.sql import functions as F

from loadlake import schemas
from loadlake.sources import streams
from loadlake.streaming import intraday


@pytest.fixture
def replay(spark, sf_dir, tmp_path):
    """The events in six files ordered by time, with ascending modification times."""
    folder = tmp_path / "events"
    folder.mkdir()
    events = spark.read.schema(schemas.EVENTS).parquet(f"{sf_dir}/events.parquet").toPandas().sort_values("ts")
    size = -(-len(events) // 6)
    for i in range(6):
        path = folder / f"{i}.parquet"
        spark.createDataFrame(events.iloc[i * size : (i + 1) * size]).coalesce(1).write.parquet(str(tmp_path / f"part{i}"))
        next((tmp_path / f"part{i}").glob("*.parquet")).rename(path)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return folder


def tumbling(spark, replay):
    return intraday.tumbling_features(streams.replay_files(spark, str(replay), files_per_trigger=1), "event_type", "ts", "value")


def finish(query):
    query.awaitTermination()
    return query


def test_ordered_replay_equals_batch_on_closed_windows(spark, replay, tmp_path):
    query = finish(intraday.append_to(tumbling(spark, replay), str(tmp_path / "out"), str(tmp_path / "cp")))
    assert intraday.late_rows(query) == 0
    seen = spark.read.parquet(str(replay)).agg(F.max("ts")).first()[0].replace(tzinfo=timezone.utc)
    assert intraday.lag_seconds(query, seen + timedelta(seconds=30)) == pytest.approx(30, abs=1)
    got = spark.read.parquet(str(tmp_path / "out"))
    events = spark.read.parquet(str(replay))
    last = events.agg(F.max("ts")).first()[0]
    batch = intraday.tumbling_features(events, "event_type", "ts", "value").where(
        F.col("window_end") <= F.lit(last) - F.expr("INTERVAL 30 MINUTES")
    )
    cols = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in batch.dtypes]
    assert got.select(cols).exceptAll(batch.select(cols)).isEmpty()
    assert batch.select(cols).exceptAll(got.select(cols)).isEmpty()


def test_a_late_file_is_dropped_and_counted(spark, replay, tmp_path):
    os.utime(replay / "0.parquet", (1_700_000_900, 1_700_000_900))
    late = spark.read.parquet(str(replay / "0.parquet")).count()
    query = finish(intraday.append_to(tumbling(spark, replay), str(tmp_path / "out"), str(tmp_path / "cp")))
    assert 0 < intraday.late_rows(query) <= late
    tolerant = intraday.tumbling_features(
        streams.replay_files(spark, str(replay), files_per_trigger=1), "event_type", "ts", "value", lateness="60 days"
    )
    assert intraday.late_rows(finish(intraday.append_to(tolerant, str(tmp_path / "out2"), str(tmp_path / "cp2")))) == 0


def test_restart_goes_on_from_the_checkpoint(spark, replay, tmp_path):
    held = tmp_path / "held.parquet"
    (replay / "5.parquet").rename(held)
    first = finish(intraday.append_to(tumbling(spark, replay), str(tmp_path / "out"), str(tmp_path / "cp")))
    assert intraday.input_rows(first) > 0
    held.rename(replay / "5.parquet")
    second = finish(intraday.append_to(tumbling(spark, replay), str(tmp_path / "out"), str(tmp_path / "cp")))
    assert intraday.input_rows(second) == spark.read.parquet(str(replay / "5.parquet")).count()
    whole = finish(intraday.append_to(tumbling(spark, replay), str(tmp_path / "once"), str(tmp_path / "cp3")))
    assert intraday.late_rows(whole) == 0
    keys = ["window_start", "series_id", "n_events"]
    twice, once = (spark.read.parquet(str(tmp_path / d)).select(keys) for d in ("out", "once"))
    assert twice.exceptAll(once).isEmpty() and once.exceptAll(twice).isEmpty()


def test_replayed_events_are_dropped_across_batches(spark, replay, tmp_path):
    source = streams.replay_files(spark, str(replay), files_per_trigger=2)
    again = source.unionByName(streams.replay_files(spark, str(replay), files_per_trigger=2))
    finish(intraday.append_to(intraday.deduplicated(again, "event_id", "ts"), str(tmp_path / "out"), str(tmp_path / "cp")))
    assert spark.read.parquet(str(tmp_path / "out")).count() == spark.read.parquet(str(replay)).count()


def test_running_state_and_store(spark, replay, tmp_path):
    source = streams.replay_files(spark, str(replay), files_per_trigger=1)
    running = intraday.running_features(source, "event_type", "ts", "value")
    finish(intraday.materialize(running, str(tmp_path / "store"), str(tmp_path / "cp"), "last_ts"))
    store = spark.read.parquet(str(tmp_path / "store")).drop("bucket")
    want = intraday.running_features(spark.read.parquet(str(replay)), "event_type", "ts", "value")
    cols = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in want.dtypes]
    assert store.count() == 5
    assert want.select(cols).exceptAll(store.select(cols)).isEmpty()


def test_writing_a_batch_twice_changes_nothing(spark, tmp_path):
    batch = spark.sql("SELECT * FROM VALUES ('a', 1, 10.0D), ('a', 2, 20.0D), ('b', 1, 5.0D) AS t(series_id, at, v)")
    write = intraday.store_writer(str(tmp_path / "store"), "at", buckets=4)
    for _ in range(2):
        write(batch, 0)
    rows = spark.read.parquet(str(tmp_path / "store")).collect()
    assert sorted((r.series_id, r.at, r.v) for r in rows) == [("a", 2, 20.0), ("b", 1, 5.0)]


def test_cycle_has_24_steps_and_falls_back_to_the_newest_value(spark):
    newest = spark.sql("SELECT * FROM VALUES ('a', timestamp'2024-01-01 10:30', 50.0D), ('b', timestamp'2024-01-01 10:30', 7.0D) AS t(series_id, ts, value)")
    day_ahead = spark.sql("SELECT 'a' AS series_id, explode(sequence(timestamp'2024-01-01 10:00', timestamp'2024-01-01 13:00', interval 1 hour)) AS target_ts_utc, 40.0D AS y_hat_mw")
    rows = intraday.intraday_cycle(newest, day_ahead).collect()
    assert {s: sum(r.series_id == s for r in rows) for s in "ab"} == {"a": 24, "b": 24}
    a = {r.step: r.y_hat for r in rows if r.series_id == "a"}
    assert a[1] == 50 and a[13] == 50 and a[24] == 50
    assert {r.y_hat for r in rows if r.series_id == "b"} == {7.0}


def test_correction_uses_only_earlier_steps(spark):
    day_ahead = spark.sql("SELECT 'a' AS series_id, timestamp'2024-01-01 10:00' AS target_ts_utc, 40.0D AS y_hat_mw")
    observed = spark.sql("SELECT 'a' AS series_id, timestamp'2024-01-01 10:15' AS ts, 46.0D AS value")
    rows = {r.ts.minute: r.corrected for r in intraday.correct_baseline(day_ahead, observed).collect()}
    assert rows == {0: 40.0, 15: 40.0, 30: 46.0, 45: 40.0}


def test_messages_round_trip(spark, sf_dir, tmp_path):
    events = spark.read.schema(schemas.EVENTS).parquet(f"{sf_dir}/events.parquet")
    streams.publish_files(events, "event_type", str(tmp_path / "log"))
    back = spark.read.json(str(tmp_path / "log")).select(F.from_json("value", schemas.EVENTS).alias("e")).select("e.*")
    cols = ["event_id", "event_type", "value"]
    assert back.select(cols).exceptAll(events.select(cols)).isEmpty()
    assert back.count() == events.count()
