import json

from pyspark.sql import functions as F

from loadlake.catalog.frames import Frames
from loadlake.plans import silver
from loadlake.sources import bronze, tables


def put(folder, name, document):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(document if isinstance(document, str) else json.dumps(document))


def demand_document(points, **metadata):
    return {"metadata": {"source": "s", "filter_id": "1", "region": "DE", "resolution": "hour", **metadata},
            "data": [{"ts_ms": t, "load_mw": v} for t, v in points], "raw": {"series": points, "meta": {"v": 1}}}


T0 = 1_704_067_200_000  # 2024-01-01 00:00 UTC


def test_demand_documents_become_whole_days(spark, tmp_path):
    put(tmp_path, "a.json", demand_document([(T0, 5.0), (T0 + 900_000, 9.0), (T0 + 7_200_000, None), (T0 - 1, 99.0)]))
    put(tmp_path, "b.json", demand_document([(T0 + 86_400_000, 3.0)], region=None, source=None))
    put(tmp_path, "empty.json", demand_document([]))
    put(tmp_path, "broken.json", "{not json")
    rows = silver.silver_demand(bronze.read_demand(spark, str(tmp_path)), "2024-01-01", "2024-01-02").collect()
    assert len(rows) == 2 * 2 * 24
    loads = {(r.source, str(r.event_ts_utc)): r.load_mw for r in rows if r.load_mw is not None}
    assert loads == {("s", "2024-01-01 00:00:00"): 9.0, ("smard", "2024-01-02 00:00:00"): 3.0}
    assert {(r.source, r.filter_id, r.region, r.resolution) for r in rows} == {("s", "1", "DE", "hour"), ("smard", "1", "DE", "hour")}


def test_expected_series_without_data_get_gap_rows(spark, tmp_path):
    put(tmp_path, "a.json", demand_document([(T0, 5.0)]))
    expected = spark.sql("SELECT 's' AS source, '1' AS filter_id, 'AT' AS region, 'hour' AS resolution")
    rows = silver.silver_demand(bronze.read_demand(spark, str(tmp_path)), "2024-01-01", "2024-01-01", expected)
    assert rows.where("region = 'AT' AND load_mw IS NULL").count() == 24


def test_weather_arrays_and_locations(spark, tmp_path):
    def document(name, lat, times, temperature):
        return {"metadata": {"source": "open-meteo", "location_name": name, "latitude": lat, "longitude": 1.0, "hourly_vars": ["temperature_2m"]},
                "raw": {"hourly": {"time": times, "temperature_2m": temperature}, "elevation": 3}}

    put(tmp_path / "location=x" / "ingestion_date=2024-01-01", "w.json", document("x", 1.5, ["2024-01-01T00:00", "2024-01-01T01:00", "bad"], [1.0]))
    put(tmp_path / "location=y" / "ingestion_date=2024-01-01", "w.json", document("y", 2.5, ["2024-01-01T00:00"], [7.0, 8.0]))
    documents = bronze.read_weather(spark, str(tmp_path))
    assert {r.location for r in documents.select("location").collect()} == {"x", "y"}
    rows = bronze.weather_hours(documents).select("location_name", "latitude", F.hour("event_ts_utc").alias("h"), "temperature_2m", "cloud_cover").collect()
    assert {tuple(r) for r in rows} == {("x", 1.5, 0, 1.0, None), ("x", 1.5, 1, None, None), ("y", 2.5, 0, 7.0, None)}
    filled = silver.silver_weather(documents, "2024-01-01", "2024-01-01")
    assert filled.count() == 48
    assert {(r.location_name, r.latitude) for r in filled.select("location_name", "latitude").distinct().collect()} == {("x", 1.5), ("y", 2.5)}


def test_calendar_takes_the_first_document_of_a_day(spark, tmp_path):
    days = spark.sql("SELECT date'2024-01-01' AS dt UNION ALL SELECT date'2024-12-30'")
    holidays = spark.sql("SELECT date'2024-01-01' AS dt")
    bronze.write_documents(bronze.calendar_documents(days, F.lit("2024-02-01").cast("timestamp"), holidays), str(tmp_path / "c"))
    put(tmp_path / "c" / "ingestion_date=2024-01-01", "zzz.json", {"data": [{"dt": "1999-01-01", "season": "late"}]})
    rows = {str(r.dt): r for r in silver.silver_calendar(bronze.read_calendar(spark, str(tmp_path / "c"))).collect()}
    assert sorted(rows) == ["2024-01-01", "2024-12-30"]
    new_year = rows["2024-01-01"]
    assert (new_year.day_of_week, new_year.is_holiday, new_year.is_working_day, new_year.season) == (0, True, False, "winter")
    assert rows["2024-12-30"].week_of_year == 1


def test_chunk_shapes(spark):
    texts = [
        '{"series": [[1, 2.5], [3, null], [4]], "data": [[9, 9]]}',
        '{"series": "none", "data": [[5, 6]]}',
        '{"series": [1, 2], "values": [[7, 8]]}',
        '{"series": [], "data": [[9, 9]]}',
        '{"other": [[1, 1]]}',
        '{"series": [[10, 1], 5, [11, 2]]}',
        '{"series": [["12", "1.5"], [13, "x"], {"a": 1}]}',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING")
    got = sorted((r.i, r.ts_ms, r.load_mw) for r in bronze.chunk_points(df, "text", ["i"]).collect())
    assert got == sorted([(0, 1, 2.5), (0, 3, None), (1, 5, 6.0), (2, 7, 8.0), (5, 10, 1.0), (5, 11, 2.0), (6, 12, 1.5), (6, 13, None)], key=lambda t: (t[0], t[1]))


def test_index_shapes_and_chunk_pick(spark):
    df = spark.createDataFrame([("a", "[100, 200]"), ("b", '{"timestamps": [300]}')], "k STRING, text STRING")
    rows = {(r.k, r.chunk_ts_ms) for r in bronze.index_points(df, "text", ["k"]).collect()}
    assert rows == {("a", 100), ("a", 200), ("b", 300)}
    index = spark.createDataFrame([(T0 - 5,), (T0,), (T0 + 5,)], "chunk_ts_ms BIGINT")
    assert bronze.pick_chunk(index, "2024-01-01").first()[0] == T0
    assert bronze.pick_chunk(index, "2023-01-01").first()[0] == T0 - 5


def test_large_and_equal_points_spread_over_documents(spark):
    """Ten thousand copies of one point are one (series, day)."""
    points = spark.range(0, 10_000, 1, 16).select(
        *[F.lit("x").alias(c) for c in ("source", "filter_id", "region", "resolution")],
        F.lit("2024-01-01 05:00").cast("timestamp").alias("event_ts_utc"),
        F.lit(1.0).alias("load_mw"),
    )
    documents = bronze.demand_documents(points, points_per_document=1000)
    sizes = [r[0] for r in documents.select(F.size("data")).collect()]
    assert sum(sizes) == 10_000
    assert len(sizes) > 3 and max(sizes) < 5000


def test_documents_replace_only_their_dates(spark, sf_dir, tmp_path):
    root = str(tmp_path / "docs")
    for d, v in (("2024-01-01", 1.0), ("2024-01-02", 2.0), ("2024-01-01", 3.0)):
        points = spark.sql(f"SELECT 's' AS source, 'f' AS filter_id, 'r' AS region, 'hour' AS resolution, timestamp'{d}' AS event_ts_utc, {v}D AS load_mw")
        bronze.write_documents(bronze.demand_documents(points), root)
    rows = bronze.demand_points(bronze.read_demand(spark, root)).collect()
    assert sorted((str(r.dt), r.load_mw) for r in rows) == [("2024-01-01", 3.0), ("2024-01-02", 2.0)]


def test_chunk_files(spark, tmp_path):
    put(tmp_path, "c.json", '{"values": [[1704067200000, 4]]}')
    assert [tuple(r) for r in bronze.read_chunks(spark, str(tmp_path)).collect()] == [(T0, 4.0)]


def test_stored_frames_are_read_from_their_table(spark, sf_dir):
    f = Frames(spark, sf_dir)
    plan = f.demand._jdf.queryExecution().toString()
    assert "hourly-" in plan and "events.parquet" not in plan
    assert tables.stored(f.demand, "x").count() == f.demand.count()


def test_local_days_have_23_and_25_hours(spark, tmp_path):
    from loadlake.operators import quality

    march = 1_711_753_200_000  # 2024-03-29 23:00 UTC, midnight of the 30th in Berlin
    put(tmp_path, "a.json", demand_document([(march + i * 3_600_000, 1.0) for i in range(71)]))
    documents = bronze.read_demand(spark, str(tmp_path))
    rows = silver.silver_demand(documents, "2024-03-30", "2024-04-01", zone="Europe/Berlin")
    counts = {str(r.dt): (r["n"], r["loads"]) for r in rows.groupBy("dt").agg(F.count("*").alias("n"), F.count("load_mw").alias("loads")).collect()}
    assert counts == {"2024-03-30": (24, 24), "2024-03-31": (23, 23), "2024-04-01": (24, 24)}
    assert quality.check_silver_demand(rows, zone="Europe/Berlin").where("NOT passed").isEmpty()
    assert not quality.check_silver_demand(rows).where("NOT passed").isEmpty()
    autumn = silver.silver_demand(documents, "2024-10-27", "2024-10-27", rows.select(*silver.schemas.SERIES_COLUMNS).distinct(), "Europe/Berlin")
    assert autumn.count() == 25


def test_envelopes_keep_the_day_and_the_raw_chunk(spark, tmp_path):
    chunk = {"series": [[T0 - 1, 1], [T0, 2], [T0 + 86_399_999, None], [T0 + 86_400_000, 3]], "meta": {"v": 1}}
    df = spark.createDataFrame([("s", "f", "r", "hour", T0, json.dumps(chunk))], "source STRING, filter_id STRING, region STRING, resolution STRING, chunk_ts_ms BIGINT, text STRING")
    documents = bronze.chunk_envelopes(df.withColumn("dt", F.lit("2024-01-01").cast("date")), "text", "dt", F.lit("2024-02-01").cast("timestamp"))
    bronze.write_documents(documents, str(tmp_path / "e"))
    row = bronze.read_demand(spark, str(tmp_path / "e")).first()
    assert [(p.ts_ms, p.load_mw) for p in row.data] == [(T0, 2.0), (T0 + 86_399_999, None)]
    assert json.loads(row.raw["series"])[0] == [T0 - 1, 1]
    assert row.metadata.run_date == "2024-01-01" and row.metadata.chunk_timestamp_ms == T0


def test_documents_are_parsed_once(spark, tmp_path):
    put(tmp_path, "a.json", demand_document([(T0, 5.0)]))
    rows = silver.silver_demand(bronze.read_demand(spark, str(tmp_path)), "2024-01-01", "2024-01-02")
    assert rows.count() == 48
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan json") == 1 and "ReusedExchange" in plan


def test_points_of_unnamed_series_are_kept(spark):
    points = spark.sql("SELECT CAST(NULL AS STRING) AS source, 'f' AS filter_id, 'r' AS region, 'hour' AS resolution, timestamp'2024-01-01' AS event_ts_utc, 1.0D AS load_mw")
    row = bronze.demand_documents(points).first()
    assert row.metadata.source is None and len(row.data) == 1


def test_reads_are_addressed_by_ingestion_date(spark, tmp_path):
    root = str(tmp_path / "demand")
    points = spark.range(20 * 24).select(
        F.lit("s").alias("source"), F.lit("f").alias("filter_id"), F.lit("r").alias("region"), F.lit("hour").alias("resolution"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("event_ts_utc"),
        F.lit(1.0).alias("load_mw"),
    )
    bronze.write_documents(bronze.demand_documents(points), root)
    documents = bronze.read_demand(spark, root, "2024-01-09", "2024-01-10", late_days=2)
    plan = documents._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan
    days = [r[0].isoformat() for r in documents.select("ingestion_date").distinct().orderBy("ingestion_date").collect()]
    assert days == [f"2024-01-{d:02}" for d in range(8, 13)]
    assert bronze.demand_points(documents, "2024-01-09", "2024-01-10").count() == 48
