"""Event logs: replay of event files, a Kafka-compatible log, and publishing to either."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlake import schemas


def replay_files(
    spark: SparkSession, path: str, schema: str = schemas.EVENTS, files_per_trigger: int | None = None, name_glob: str | None = None
) -> DataFrame:
    """Parquet files of events as a stream, oldest file first."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.parquet(path)


def subscribe(
    spark: SparkSession, servers: str, topic: str, schema: str = schemas.EVENTS, starting_offsets: str = "earliest"
) -> DataFrame:
    """A topic of JSON events. Without a checkpoint the stream starts from ``starting_offsets``."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .load()
    )
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("e")).select("e.*")


def as_messages(df: DataFrame, key: str) -> DataFrame:
    """Rows as (key, JSON value) messages."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def publish(df: DataFrame, key: str, servers: str, topic: str) -> None:
    """Write validated rows to a topic."""
    (
        as_messages(df, key)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def publish_files(df: DataFrame, key: str, path: str) -> None:
    """The same messages as JSON lines, for replay without a log."""
    as_messages(df, key).write.mode("append").json(path)
