"""As-of joins on two time axes against a plain search over all versions."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loadlake.operators import bitemporal
from loadlake.operators.asof import asof_join
from loadlake.operators.bitemporal import known_asof_join
from loadlake.plans.evaluation import leaks

T0 = datetime(2024, 1, 1)
LEFT = "k string, at timestamp, origin timestamp, value string, _row int"
VERSIONS = "k string, event timestamp, known timestamp, mw double"


def minutes(n):
    return None if n is None else T0 + timedelta(minutes=n)


def searched(left, versions):
    out = []
    for k, at, origin, *_ in left:
        able = [v for v in versions if None not in (k, at, origin, *v[:3]) and v[0] == k and v[1] <= at and v[2] <= origin]
        best = max(able, key=lambda v: v[1:]) if able else None
        out.append((k, at, origin, *(best[1:] if best else (None, None, None))))
    return sorted(out, key=repr)


def joined(spark, left, versions, **options):
    asked = spark.createDataFrame([(k, minutes(a), minutes(o), "x", 1) for k, a, o in left], LEFT)
    table = spark.createDataFrame([(k, minutes(e), minutes(n), v) for k, e, n, v in versions], VERSIONS)
    got = known_asof_join(asked, table, ["k"], "at", "origin", "event", "known", **options)
    assert got.columns == ["k", "at", "origin", "value", "_row", "event", "known", "mw"]
    assert leaks(got, "known", "origin").isEmpty()

    def back(t):
        return None if t is None else int((t - T0).total_seconds() // 60)

    return sorted([(r["k"], back(r["at"]), back(r["origin"]), back(r["event"]), back(r["known"]), r["mw"]) for r in got.collect()], key=repr)


@pytest.mark.parametrize(("fanout", "late"), [(2, 0.3), (3, 0.9), (64, 0.5)])
def test_join_by_search(spark, fanout, late):
    """Values that land late, corrections, gaps, and events of which whole stretches are not known yet."""
    rng = random.Random(fanout)
    versions = []
    for k, n in (("hot", 120), ("cold", 9), ("one", 1)):
        for e in rng.sample(range(0, 4000), n):
            known = e + (rng.randrange(3000) if rng.random() < late else 5)
            versions += [(k, e, known + 400 * i, float(rng.randrange(9))) for i in range(rng.randrange(1, 4))]
    left = [(rng.choice(["hot", "hot", "cold", "one", "none"]), a := rng.randrange(-10, 4200), a + rng.randrange(-200, 3000)) for _ in range(300)]
    assert joined(spark, left, versions, fanout=fanout, block_seconds=6 * 3600) == searched(left, versions)


def test_all_new_events_came_late(spark):
    """The tree is climbed to the top and down again to the one event that was known."""
    versions = [("k", 0, 0, 7.0)] + [("k", e, 100_000 + e, 1.0) for e in range(1, 300)]
    left = [("k", e, 500) for e in range(0, 300, 7)] + [("k", 299, 100_150), ("k", 100, 200_000)]
    assert joined(spark, left, versions, fanout=3) == searched(left, versions)


def test_odd_rows(spark):
    versions = [("k", 0, 10, 1.0), ("k", 0, 10, 2.0), ("k", 0, 20, 3.0), (None, 0, 0, 4.0), ("k", None, 0, 5.0), ("k", 5, None, 6.0)]
    left = [("k", 1, 10), ("k", 1, 10), ("k", 1, 19), ("k", 1, 20), ("k", 1, 9), (None, 1, 1), ("k", None, 50), ("k", 1, None), ("k", -1, 50)]
    assert joined(spark, left, versions) == searched(left, versions)
    assert joined(spark, left, []) == searched(left, [])
    assert joined(spark, [], versions) == []


def test_a_correction_counts_from_its_time_on(spark):
    versions = [("k", 0, 60, 100.0), ("k", 0, 600, 90.0), ("k", 60, 700, 80.0)]
    got = joined(spark, [("k", 120, o) for o in (59, 60, 599, 600, 699, 700)], versions)
    assert [r[-1] for r in sorted(got, key=lambda r: r[2])] == [None, 100.0, 100.0, 90.0, 90.0, 80.0]


def test_plan_holds_no_cross_join(spark):
    table = spark.createDataFrame([("k", minutes(0), minutes(0), 1.0)], VERSIONS)
    asked = spark.createDataFrame([("k", minutes(1), minutes(1), "x", 1)], LEFT)
    got = known_asof_join(asked, table, ["k"], "at", "origin", "event", "known")
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert got.agg(F.count("*")).first()[0] == 1


def test_only_rows_whose_newest_event_came_late_meet_the_tree(spark, monkeypatch):
    """Nine rows in ten are settled by their own event, and the rest by an earlier one or by none."""
    met = []
    search = bitemporal._last_known

    def watched(rows, *rest):
        met.append(rows.count())
        return search(rows, *rest)

    monkeypatch.setattr(bitemporal, "_last_known", watched)
    versions = [("k", e, e + (500 if e % 10 == 0 else 1), 1.0) for e in range(200)]
    left = [("k", e, e + 2) for e in range(200)]
    assert joined(spark, left, versions, fanout=4) == searched(left, versions)
    assert met == [20]


def test_an_asof_join_moves_its_rows_once(spark):
    """Both tables are dealt out for the window alone, not once more for the list of crowded blocks."""
    table = spark.createDataFrame([("k", minutes(0), minutes(0), 1.0)], VERSIONS)
    asked = spark.createDataFrame([("k", minutes(1), minutes(1), "x", 1)], LEFT)
    got = asof_join(asked, table, ["k"], "at", "event")
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.first()["mw"] == 1.0
