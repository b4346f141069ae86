"""Mixing sources to target weights by Poisson replication, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlake.sources.tables import stored

#: Up to so many sources the table of rates is broadcast; a larger one meets the documents in salted joins.
BROADCAST_SOURCES = 10_000
#: Parts in which a source is cut for that join.
SALTS = 64
#: A Poisson number of a larger mean is the sum of several, so that exp(-mean) stays far from zero.
PART = 64.0


def uniform(*key: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the MD5 of ``key``, so it does not depend on order or place."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *key)), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def poisson(u: Column, mean: Column) -> Column:
    """The Poisson number of mean ``mean`` (``PART`` at most) at which the distribution first exceeds ``u``.

    ``u`` has steps of 2**-52; beyond ``mean + 10 * sqrt(mean) + 20`` there is
    less than that left, so the sum has that many terms.
    """
    terms = F.sequence(F.lit(1), F.ceil(mean + 10 * F.sqrt(mean) + 20).cast("int"))
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.lit(0).alias("n"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * mean / k
        return F.struct(p.alias("p"), (s["c"] + p).alias("c"), (s["n"] + F.when(u >= s["c"], 1).otherwise(0)).alias("n"))

    return F.aggregate(terms, start, step, lambda s: s["n"])


def rates(docs: DataFrame, weights: DataFrame | None, total: float | None, source: str, power: float) -> DataFrame:
    """(source, rate): the mean number of times a document of each source is to appear."""
    counts = docs.groupBy(F.col(source).alias("_source")).agg(F.count("*").alias("_n"))
    if weights is None:
        counts = counts.withColumn("_weight", F.pow("_n", F.lit(power)) if power != 0.5 else F.sqrt("_n"))
    else:
        named = weights.select(F.col("source").alias("_named"), F.col("weight").cast("double").alias("_weight"))
        counts = counts.join(named, F.col("_source").eqNullSafe(F.col("_named")), "left").na.fill(0.0, ["_weight"])
    whole = counts.agg(F.sum("_weight").alias("weight"), F.sum("_n").alias("rows")).first()
    size = float((whole["rows"] or 0) if total is None else total)
    rate = F.lit(size) * F.col("_weight") / F.lit(float(whole["weight"] or 0)) / F.col("_n")
    return counts.select("_source", F.when(F.col("_weight") > 0, rate).otherwise(0.0).alias("_rate"))


def keyed(docs: DataFrame, id: str) -> DataFrame:
    """(_row, _key): each row as one struct, so that none of its names can clash, and a key of its own.

    The key is the id. Rows of an id that comes more than once, or that is
    NULL, have a place beside it; they alone are written, so that the places
    stay the same in every use. Ids are counted without the rows.
    """
    rows = docs.select(F.struct("*").alias("_row"), F.col(id).cast("string").alias("_key"))
    again = rows.groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1 OR _key IS NULL").select("_key")
    again = stored(again, "repeated-ids")
    if again.isEmpty():
        return rows
    same = rows["_key"].eqNullSafe(again["_key"])
    place = F.concat_ws("#", F.coalesce("_key", F.lit("null")), F.monotonically_increasing_id().cast("string"))
    many = stored(rows.join(again, same, "left_semi").withColumn("_key", place), "repeated-rows")
    return rows.join(again, same, "left_anti").unionByName(many)


def mixed(
    docs: DataFrame,
    weights: DataFrame | None = None,
    total: float | None = None,
    seed: int = 0,
    power: float = 0.5,
    source: str = "source",
    id: str = "doc_id",
) -> DataFrame:
    """Rows of ``docs`` replicated to the target weights of their sources and shuffled globally, with a column ``copy``.

    ``weights`` has (source, weight), not negative; sources it does not name
    get none. Without it a source weighs its number of documents to the
    ``power``, so 0.5 lets small sources catch up. ``total`` is the expected
    number of rows, that of ``docs`` if None.

    A source's mean repetition rate is total * share / documents. Each document
    appears as often as a Poisson number of that mean, found by inverting the
    distribution at a uniform number hashed from (seed, key): the expected mix
    is exact, no document's count depends on another's, and a task that is run
    again gives the same rows. Rates above ``PART`` are sums of several Poisson
    numbers. Rows are then sorted by a hash of (seed, key, copy), a uniform key,
    so a source or an id of any size is spread over all partitions. The key is
    the id where it is unique; rows that share one, or have none, draw a number
    each (``keyed``), by their place in the table.

    The rates are counted with partial sums and meet the documents without
    moving texts, by a broadcast if there are ``BROADCAST_SOURCES`` sources at
    most, else by joins on the source and one of ``SALTS`` salts.

    NULL is a source like any other. An empty table stays empty. No text is
    looked at, however long, and other columns are carried along; a column
    ``copy`` of ``docs`` is replaced.
    """
    table = rates(docs, weights, total, source, power)
    rows = keyed(docs.drop("copy"), id).withColumn("_in", F.col("_row")[source])
    key = F.col("_key")
    if table.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        met = rows.join(F.broadcast(table), F.col("_in").eqNullSafe(F.col("_source")))
    else:
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int"))
        copies = table.withColumn("_salt_there", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = salted.join(copies, F.col("_in").eqNullSafe(F.col("_source")) & (F.col("_salt") == F.col("_salt_there")))
    parts = F.greatest(F.ceil(F.col("_rate") / PART), F.lit(1)).cast("int")
    drawn = F.transform(
        F.sequence(F.lit(1), parts),
        lambda part: poisson(uniform(F.lit(str(seed)), key, part.cast("string")), F.col("_rate") / parts),
    )
    count = F.aggregate(drawn, F.lit(0), lambda total, n: total + n)
    copied = met.select("_row", "_key", count.alias("_count")).where("_count > 0")
    copied = copied.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_count"))))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), key, F.lit("copy"), F.col("copy").cast("string")))
    return copied.withColumn("_order", order).orderBy("_order").select("_row.*", "copy")
