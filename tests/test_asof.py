import bisect

import pytest
from pyspark.sql import functions as F

from loadlake.operators.asof import asof_join, latest
from loadlake.plans.policy import last_known_good


def frames(spark, n_left=3000, n_features=400, hot=True):
    """Random times over 20 days; with ``hot`` one key has most rows, and half of its rows share a minute."""
    key = F.when(F.rand(1) < 0.8, "hot").otherwise(F.concat(F.lit("k"), (F.rand(2) * 5).cast("int"))) if hot else F.lit("k")
    second = F.when((F.rand(3) < 0.5) & (key == "hot"), F.lit(900_000) + (F.rand(4) * 60).cast("int")).otherwise(
        (F.rand(5) * 20 * 86_400).cast("int")
    )
    left = spark.range(n_left).select("id", key.alias("k"), F.timestamp_seconds(F.lit(1_700_000_000) + second).alias("ts"))
    feature_key = F.when(F.rand(6) < 0.5, "hot").otherwise(F.concat(F.lit("k"), (F.rand(7) * 5).cast("int")))
    features = spark.range(n_features).select(
        feature_key.alias("k"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 4000).alias("fts"),
        F.col("id").alias("value"),
    )
    return left, features


def brute_force(left, features, ttl=None, strict=False):
    times = {}
    for r in sorted(features, key=lambda r: r.fts):
        times.setdefault(r.k, ([], []))
        times[r.k][0].append(r.fts)
        times[r.k][1].append(r.value)
    want = {}
    for r in left:
        ts, values = times.get(r.k, ([], []))
        i = (bisect.bisect_left if strict else bisect.bisect_right)(ts, r.ts) - 1
        hit = i >= 0 and (ttl is None or (r.ts - ts[i]).total_seconds() <= ttl)
        want[r.id] = values[i] if hit else None
    return want


@pytest.mark.parametrize("ttl", [None, 3000, 86_400 * 3])
@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("block,rows_per_part", [(86_400, 1), (3600, 8), (86_400 * 40, 3)])
def test_against_brute_force(spark, tmp_path, ttl, strict, block, rows_per_part):
    left, features = frames(spark)
    left.write.parquet(str(tmp_path / "left"))
    left = spark.read.parquet(str(tmp_path / "left"))
    got = asof_join(left, features, ["k"], "ts", "fts", ttl, strict, block, rows_per_part)
    assert got.columns == ["k", "id", "ts", "fts", "value"]
    rows = got.collect()
    want = brute_force(left.collect(), features.collect(), ttl, strict)
    assert len(rows) == len(want)
    assert {r.id: r.value for r in rows} == want


def test_same_instant_counts_unless_strict(spark):
    left = spark.sql("SELECT 1 AS id, 'k' AS k, timestamp'2024-01-01 00:00:00' AS ts")
    features = spark.sql("SELECT 'k' AS k, timestamp'2024-01-01 00:00:00' AS fts, 5 AS value")
    assert asof_join(left, features, ["k"], "ts", "fts").first().value == 5
    assert asof_join(left, features, ["k"], "ts", "fts", strict=True).first().value is None


def test_copies_on_the_left_all_stay(spark):
    left = spark.range(5000).select(F.lit(1).alias("id"), F.lit("k").alias("k"), F.lit("2024-01-02").cast("timestamp").alias("ts"))
    features = spark.sql("SELECT 'k' AS k, timestamp'2024-01-01' AS fts, 5 AS value")
    got = asof_join(left, features, ["k"], "ts", "fts", rows_per_part=2)
    assert got.where("value = 5").count() == 5000


def test_latest(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1, 'x'), ('a', 3, 'y'), ('b', 2, 'z') AS t(k, ts, v)")
    assert {(r.k, r.ts, r.v) for r in latest(df, ["k"], "ts").collect()} == {("a", 3, "y"), ("b", 2, "z")}


def test_last_known_good_marks_fallbacks(spark):
    wanted = spark.sql("SELECT 's' AS series_id, explode(sequence(timestamp'2024-01-01 00:00', timestamp'2024-01-01 05:00', interval 1 hour)) AS target_ts_utc")
    known = wanted.where(F.hour("target_ts_utc").isin(1, 2)).withColumn("y_hat_mw", F.hour("target_ts_utc") * 1.0)
    rows = {r.target_ts_utc.hour: (r.y_hat_mw, r.is_fallback) for r in last_known_good(wanted, known).collect()}
    assert rows == {0: (None, None), 1: (1.0, False), 2: (2.0, False), 3: (2.0, True), 4: (2.0, True), 5: (2.0, True)}
    limited = {r.target_ts_utc.hour: r.y_hat_mw for r in last_known_good(wanted, known, 3600).collect()}
    assert limited[3] == 2.0 and limited[4] is None


def test_features_are_never_newer_than_the_row_they_join(spark):
    from loadlake.plans.evaluation import leaks

    left, features = frames(spark)
    joined = asof_join(left, features, ["k"], "ts", "fts")
    assert leaks(joined, "fts", "ts").isEmpty()
    assert not leaks(joined, "ts", "fts").isEmpty()


def test_unknown_keys_and_times_stay_without_a_match(spark):
    left = spark.sql("SELECT * FROM VALUES (1, CAST(NULL AS STRING), timestamp'2024-01-02'), (2, 'k', CAST(NULL AS TIMESTAMP)), (3, 'k', timestamp'2024-01-02') AS t(id, k, ts)")
    features = spark.sql("SELECT * FROM VALUES (CAST(NULL AS STRING), timestamp'2024-01-01', 1), ('k', timestamp'2024-01-01', 2) AS t(k, fts, value)")
    for ttl in (None, 86_400 * 9):
        got = {r.id: r.value for r in asof_join(left, features, ["k"], "ts", "fts", ttl).collect()}
        assert got == {1: None, 2: None, 3: 2}
