import re
from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from loadlake import session
from loadlake.sources import tables


def days(spark, first, n, value=1.0):
    return spark.range(n * 24).select(
        (F.lit(first).cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("event_ts_utc"),
        F.lit(value).alias("load_mw"),
    ).withColumn("dt", F.to_date("event_ts_utc"))


def test_days_are_pruned_and_columns_required(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.write_days(days(spark, "2024-01-01", 10), root)
    part = tables.read_days(spark, root, "2024-01-03", "2024-01-04", ["event_ts_utc", "dt"])
    assert part.count() == 48
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "load_mw" not in plan
    with pytest.raises(AnalysisException):
        tables.read_days(spark, root, columns=["missing"])
    assert len(list((tmp_path / "t").glob("dt=2024-01-03/*.parquet"))) == 1


def test_rewritten_days_replace_only_themselves(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.write_days(days(spark, "2024-01-01", 3), root)
    tables.write_days(days(spark, "2024-01-02", 1, 5.0), root)
    got = {str(r.dt): r.s for r in spark.read.parquet(root).groupBy("dt").agg(F.sum("load_mw").alias("s")).collect()}
    assert got == {"2024-01-01": 24, "2024-01-02": 120, "2024-01-03": 24}


def test_upsert_is_idempotent_and_keeps_other_keys(spark, tmp_path):
    root = str(tmp_path / "t")

    def rows(model, first, last, value):
        return spark.sql(f"SELECT '{model}' AS model, explode(sequence(date'{first}', date'{last}')) AS target_date, {value}D AS y")

    def content():
        return sorted((r.model, str(r.target_date), r.y) for r in spark.read.parquet(root).collect())

    keys = ["model", "target_date"]
    tables.upsert(rows("a", "2024-01-01", "2024-01-03", 1), root, keys, ["target_date"])
    tables.upsert(rows("b", "2024-01-02", "2024-01-04", 2), root, keys, ["target_date"])
    tables.upsert(rows("a", "2024-01-03", "2024-01-03", 9), root, keys, ["target_date"])
    once = content()
    tables.upsert(rows("a", "2024-01-03", "2024-01-03", 9), root, keys, ["target_date"])
    assert content() == once == [
        ("a", "2024-01-01", 1), ("a", "2024-01-02", 1), ("a", "2024-01-03", 9),
        ("b", "2024-01-02", 2), ("b", "2024-01-03", 2), ("b", "2024-01-04", 2),
    ]
    tables.append(rows("a", "2024-01-03", "2024-01-03", 9), root, ["target_date"])
    assert len(content()) == len(once) + 1


def test_lookback_binds_its_dates(spark):
    table = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-31')) AS target_date, 1.0D AS mape")
    rows = tables.lookback(table, "target_date", date(2024, 1, 10), date(2024, 1, 12)).collect()
    assert [r.target_date.day for r in rows] == [12, 11, 10]


def test_require_rows_and_unions(spark, tmp_path):
    with pytest.raises(tables.EmptyTableError):
        tables.require_rows(spark.range(0), "nothing")
    for name in "ab":
        spark.range(3).write.parquet(str(tmp_path / name))
    assert tables.read_many(spark, [str(tmp_path / n) for n in "ab"]).count() == 6


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = session.shared_dir(spark, "x"), session.shared_dir(spark, "x")
    assert first.startswith(root) and first != second


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session(), "x")


def test_upsert_reads_only_the_partitions_it_touches(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(100).select("id", (F.col("id") % 10).alias("part"), F.lit(0).alias("at"))
    tables.upsert(rows, root, ["id", "part"], ["part"])
    touched = spark.read.parquet(root).where(tables.touched_partitions(rows.where("part = 3"), ["part"]))
    assert re.search(r"PartitionFilters: \[[^\]]*part#\d+L? = 3|PartitionFilters: \[[^\]]*part#\d+L? IN", touched._jdf.queryExecution().executedPlan().toString())
    tables.upsert(rows.where("id = 3").withColumn("at", F.lit(-1)), root, ["id", "part"], ["part"], newest="at")
    assert spark.read.parquet(root).where("at < 0").isEmpty()
    tables.upsert(rows.where("id = 3").withColumn("at", F.lit(5)), root, ["id", "part"], ["part"], newest="at")
    assert [r["id"] for r in spark.read.parquet(root).where("at = 5").collect()] == [3]
    assert spark.read.parquet(root).count() == 100
