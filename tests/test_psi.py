import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlake.operators import psi as psi_module
from loadlake.operators.psi import psi
from loadlake.operators.quantiles import quantiles, small_group_quantiles


def known_psi(expected, actual, bins=10):
    """The definition, on arrays."""
    cuts = np.quantile(expected, np.arange(bins + 1) / bins)
    e = np.histogram(expected, cuts)[0] / (len(expected) + 1e-6)
    a = np.histogram(actual, cuts)[0] / (len(actual) + 1e-6)
    return float(np.sum((a - e) * np.log((a + 1e-6) / (e + 1e-6))))


def samples(spark, baseline, recent, key="k"):
    rows = [(key, float(v), False) for v in baseline] + [(key, float(v), True) for v in recent]
    return spark.createDataFrame(rows, "k STRING, v DOUBLE, recent BOOLEAN")


@pytest.mark.parametrize("pooled", [False, True])
def test_equal_samples(spark, pooled):
    x = np.random.default_rng(1).normal(size=1000)
    row = psi(samples(spark, x, x), ["k"], "v", "recent", pooled=pooled).first()
    assert abs(row.psi) < 1e-3


@pytest.mark.parametrize("pooled", [False, True])
def test_shifted_sample(spark, pooled):
    rng = np.random.default_rng(2)
    base, recent = rng.normal(size=1000), rng.normal(2, 1, size=1000)
    row = psi(samples(spark, base, recent), ["k"], "v", "recent", pooled=pooled).first()
    assert row.psi > 0.1
    assert row.psi == pytest.approx(known_psi(base, recent), rel=1e-9)
    assert (row.n_baseline, row.n_recent) == (1000, 1000)


@pytest.mark.parametrize("pooled", [False, True])
def test_repeated_values_make_empty_bins(spark, pooled):
    base = [0.0] * 60 + [1.0] * 25 + [5.0] * 15
    recent = [0.0] * 10 + [1.0] * 50 + [9.0] * 5
    row = psi(samples(spark, base, recent), ["k"], "v", "recent", pooled=pooled).first()
    assert row.psi == pytest.approx(known_psi(np.array(base), np.array(recent)), rel=1e-9)


def test_nulls_nans_and_one_sided_keys(spark):
    df = samples(spark, [1, 2, 3, 4], [1, 2, float("nan")]).unionByName(samples(spark, [1.0], [], "only"))
    df = df.unionByName(spark.sql("SELECT 'k' AS k, CAST(NULL AS DOUBLE) AS v, true AS recent"))
    rows = psi(df, ["k"], "v", "recent").collect()
    assert [(r.k, r.n_recent) for r in rows] == [("k", 2)]


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_quantiles_of_small_groups(spark, n):
    x = np.random.default_rng(n).integers(0, 50, size=n).astype(float)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([("k", float(v)) for v in x], "k STRING, v DOUBLE")
    want = pytest.approx(list(np.quantile(x, probs)))
    assert quantiles(df, ["k"], "v", probs).first().quantiles == want
    assert small_group_quantiles(df, ["k"], "v", probs).first().quantiles == want


def test_quantiles_rank_only_inside_brackets(spark):
    """Groups large enough for brackets, one of them skewed and full of ties."""
    probs = [i / 10 for i in range(11)]
    base = spark.range(0, 600_000, 1, 8)
    df = base.select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise("other").alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.expr("pmod(hash(id), 1000003) / 7.0")).alias("v"),
    )
    got = {r.k: r.quantiles for r in quantiles(df, ["k"], "v", probs).collect()}
    want = {r.k: r.quantiles for r in small_group_quantiles(df, ["k"], "v", probs).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-12)


def test_bins_are_half_open_and_the_last_is_closed(spark):
    cuts = F.array(*[F.lit(float(i)) for i in range(11)])
    values = [(-0.1, None), (0.0, 0), (0.99, 0), (1.0, 1), (9.0, 9), (10.0, 9), (10.1, None)]
    df = spark.createDataFrame([(v,) for v, _ in values], "v DOUBLE")
    got = [r.b for r in df.select(psi_module.bin_of(F.col("v"), cuts).alias("b")).collect()]
    assert got == [b for _, b in values]
