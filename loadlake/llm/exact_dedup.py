"""Exact duplicates by progressive refinement: length, then a hash of the beginning, then a hash of the whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlake.llm.scratch import Scratch, numbered
from loadlake.sources.tables import stored

#: What is deleted before texts are compared: space and U+0009 to U+000D.
WHITE = " \t\n\x0b\x0c\r"
#: Characters of the normalised text that the second round hashes. A longer text only needs the third round.
PREFIX = 256


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, lowercase hex."""
    return F.sha2(normalised(text), 256)


def exact_duplicates(docs: DataFrame, text: str = "text", id: str = "doc_id", digests: bool = False) -> DataFrame:
    """One row per document: ``id``, keep_id, group_size, kept, and with ``digests`` the row's text_sha256.

    Texts are equal if they are the same after white space is deleted; of equal
    texts the one with the most characters stays, then the smallest id.

    1. Lengths of normalised texts and hashes of their first ``PREFIX``
       characters come from one scan, as a narrow table.
    2. Rows whose length no other row has are settled. Of the others, rows
       whose (length, prefix hash) no other row has are settled.
    3. Only what is left meets its text again, for the full hash. With
       ``digests`` every row brings its own from the first scan instead.

    The groups of each round are counts, summed before they are shuffled; they
    go back to the rows in joins of which one side has a row per group and the
    other can be split, so a group may hold any share of the rows.

    NULL text counts as empty; empty texts are equal to each other. ``id``
    names a document: rows that repeat an id and its text are kept or dropped
    together, each counted in group_size. A NULL id is an id like any other but
    loses ties against them. Other columns are not read.
    """
    rows = docs.select(
        F.col(id).alias("_id"),
        F.coalesce(F.length(text), F.lit(0)).alias("_points"),
        normalised(F.col(text)).alias("_normal"),
    ).withColumns({"_length": F.length("_normal"), "_prefix": F.xxhash64(F.substring("_normal", 1, PREFIX))})
    if digests:
        rows = rows.withColumn("_hash", F.sha2("_normal", 256))
    narrow = stored(rows.drop("_normal"), "lengths")
    # Tables with a row per group are written before they are joined: adaptive
    # execution splits a group of very many rows only between two plain shuffles.
    lengths = narrow.groupBy("_length").agg(F.count("*").alias("_n")).where("_n > 1").select("_length")
    lengths = stored(lengths, "shared-lengths")
    shared = narrow.join(lengths, "_length", "left_semi")
    prefixes = stored(
        shared.groupBy("_length", "_prefix").agg(F.count("*").alias("_n")).where("_n > 1").drop("_n"), "prefixes"
    )
    settled = narrow.join(prefixes, ["_length", "_prefix"], "left_anti")
    open_ = narrow.join(prefixes, ["_length", "_prefix"], "left_semi")
    same_row = F.expr("a._id <=> b._id AND a._length = b._length AND a._prefix = b._prefix")
    hashed = rows.alias("a").join(open_.alias("b"), same_row, "left_semi").select("_id", "_points", F.sha2("_normal", 256).alias("_hash"))
    full = stored(open_.select("_id", "_points", "_hash") if digests else hashed, "hashes")
    best = F.min(F.struct(-F.col("_points"), F.col("_id").isNull().alias("_none"), "_id"))
    groups = full.groupBy("_hash").agg(F.count("*").alias("group_size"), best["_id"].alias("keep_id"))
    more = ["_hash"] if digests else []
    met = full.join(stored(groups, "groups"), "_hash").select("_id", "keep_id", "group_size", *more)
    alone = settled.select("_id", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), *more)
    return met.unionByName(alone).select(
        F.col("_id").alias(id),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        *[F.col(c).alias("text_sha256") for c in more],
    )


def without_copies(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row of ``docs`` for each text that ``exact_duplicates`` tells apart, with all its columns.

    Of equal texts the longest stays, then the smallest id, a NULL one last,
    then the row that was read first. Rows are told apart by their place: of
    rows that repeat an id each is judged by its own text, and of rows that
    repeat id and text one stays. NULL and blank texts are equal to each other.
    An empty table gives no rows. Other columns are carried along, whatever
    their names.
    """
    rows = numbered(docs, Scratch(docs.sparkSession))
    key = F.struct(F.col("doc")[id].isNull().alias("none"), F.col("doc")[id].alias("id"), "row")
    found = exact_duplicates(rows.select(key.alias("key"), F.col("doc")[text].alias("text")), "text", "key")
    # Written, so that its size is known when the join is planned.
    dropped = stored(found.where("NOT kept").select("key.row"), "copies")
    return rows.join(dropped, "row", "left_anti").select("doc.*")
