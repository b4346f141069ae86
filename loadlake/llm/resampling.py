"""Importance resampling towards a target text: hashed n-gram weights, Gumbel keys, a distributed quickselect."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.llm.words import portions
from loadlake.sources.tables import stored

#: Features whose bucket a task keeps; when there are more it starts anew.
KEPT_FEATURES = 200_000
#: Random keys that a round of the quickselect counts rows around.
PIVOTS = 15

#: Bytes outside words become spaces, A-Z become a-z; all bytes of characters beyond ASCII belong to words.
_WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


class Buckets(dict):
    """Feature to bucket: the CRC-32 of its bytes modulo the number of buckets."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= KEPT_FEATURES:
            self.clear()
        bucket = self[feature] = crc32(feature) % self.size
        return bucket


def features(text: str, width: int) -> tuple[int, list[bytes]]:
    """The number of words of a text and its runs of 1 to ``width`` words, joined by one space, repeats included."""
    listed = text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()
    found = list(listed)
    for n in range(2, width + 1):
        found += [b" ".join(listed[i : i + n]) for i in range(len(listed) - n + 1)]
    return len(listed), found


def bucket_counts(docs: DataFrame, buckets: int, width: int = 1, text: str = "text") -> DataFrame:
    """(bucket, n): features of all texts by bucket; a task sends one row per bucket at most to the sum."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for group in portions(x.as_py() for x in batch.column(0)):
                listed = [bucket_of[f] for value in group for f in features(value, width)[1]]
                total += np.bincount(np.array(listed, np.int64), minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], names=["bucket", "n"])

    return docs.select(text).mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def counts_array(counts: DataFrame, buckets: int) -> np.ndarray:
    """The counts as an array on the driver, ``buckets`` numbers whatever the size of the corpus."""
    rows = counts.toArrow()
    found = np.zeros(buckets, np.int64)
    found[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return found


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of each bucket's share of the target over its share of the source, one added to each count."""
    n = len(source)
    shares = (target + 1.0) * float(source.sum() + n) / ((source + 1.0) * float(target.sum() + n))
    return np.floor(1000 * np.log(shares)).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, width: int = 1, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(``id``, n_words, n_features, weight) of every row; the weight is the floored mean gain of its features, 0 without any."""
    numbers = [T.StructField(name, T.LongType()) for name in ("n_words", "n_features", "weight")]
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), *numbers])
    sent = docs.sparkSession.sparkContext.broadcast(gain)  # a number per bucket

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain_of = sent.value
        bucket_of = Buckets(len(gain_of))
        for batch in batches:
            n_words, sizes, sums = [], [], []
            for group in portions(x.as_py() for x in batch.column(1)):
                listed: list[int] = []
                group_sizes = []
                for value in group:
                    n, found = features(value, width)
                    listed += [bucket_of[f] for f in found]
                    n_words.append(n)
                    group_sizes.append(len(found))
                ends = np.cumsum(np.array(group_sizes, np.int64))
                running = np.concatenate(([0], np.cumsum(gain_of[np.array(listed, np.int64)])))
                sums.append(running[ends] - running[ends - np.array(group_sizes, np.int64)])
                sizes += group_sizes
            size, total = np.array(sizes, np.int64), np.concatenate(sums)
            weight = np.where(size > 0, total // np.maximum(size, 1), 0)
            columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(size, pa.int64()), pa.array(weight, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(id).alias(id), F.col(text).alias("_text")).mapInArrow(scored, schema)


def gumbel(seed: int, id: Column) -> Column:
    """floor(1000 * a Gumbel number) from the first 32 bits of the SHA-256 of ``seed:id``; a NULL id counts as empty."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


@dataclass(frozen=True)
class Key:
    """A place in the order of draws: high scores first, then small ids, then rows as they were written. A NULL id is last."""

    score: int
    none: bool
    id: object
    row: int


def _ahead(key: Key, id: str) -> Column:
    """True for rows that are drawn before the row of ``key``."""
    name, none = F.col(id), F.col(id).isNull()
    same_id = none if key.none else name == F.lit(key.id)
    smaller = ~none if key.none else name < F.lit(key.id)
    after_id = F.coalesce(smaller, F.lit(False)) | (F.coalesce(same_id, F.lit(False)) & (F.col("row") < key.row))
    return (F.col("score") > key.score) | ((F.col("score") == key.score) & after_id)


def kth_key(rows: DataFrame, k: int, id: str = "doc_id", seed: int = 0) -> Key | None:
    """The key of the row that is the ``k``-th in the order of draws, 1 the first; None if there are fewer.

    A distributed quickselect. ``rows`` is a written table of (``id``, score,
    row), row a number of its own for each row. A round picks ``PIVOTS`` rows of
    the stretch that is left, by a hash of row and round, and counts in one scan
    how many rows of the stretch lie ahead of each, are it, and come after it.
    The counts are exact, so the two pivots around the k-th row bound the next
    stretch. The score bounds the stretch in the scan, too. The driver sees
    pivots and counts only.
    """
    low: Key | None = None  # the k-th row comes after this one
    high: Key | None = None  # and ahead of this one
    for turn in range(10_000):
        part = rows
        if low is not None:
            part = part.where((F.col("score") <= low.score) & ~_ahead(low, id) & (F.col("row") != low.row))
        if high is not None:
            part = part.where((F.col("score") >= high.score) & _ahead(high, id))
        dealt = part.orderBy(F.xxhash64("row", F.lit(seed), F.lit(turn)), "row").limit(PIVOTS).select("score", id, "row")
        pivots = [Key(r["score"], r[id] is None, r[id], r["row"]) for r in dealt.collect()]
        if not pivots:
            return None
        pivots.sort(key=lambda p: (-p.score, p.none, 0 if p.none else p.id, p.row))
        counts = part.agg(*[F.count_if(_ahead(p, id)).alias(f"_{i}") for i, p in enumerate(pivots)], F.count("*").alias("_all")).first()
        if k > counts["_all"]:
            return None
        passed = 0
        for i, pivot in enumerate(pivots):
            ahead = counts[f"_{i}"]
            if k == ahead + 1:
                return pivot
            if k <= ahead:
                high = pivot
                break
            low, passed = pivot, ahead + 1
        k -= passed
    raise RuntimeError("the table of scores changed while it was read")


def ranked(winners: DataFrame, order: list[Column]) -> DataFrame:
    """``winners`` with their rank from 1 in that order, which must tell all rows apart.

    Ranges of the order are sorted apart and written; a row's rank is its place
    in its range after the rows of the ranges before, one count each.
    """
    rows = stored(winners.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "winners")
    rows = rows.withColumns({"_range": F.shiftright("_at", 33), "_place": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = {r["_range"]: r["n"] for r in rows.groupBy("_range").agg(F.count("*").alias("n")).collect()}  # one per range
    firsts, total = [], 0
    for at in sorted(counts):
        firsts.append((at, total))
        total += counts[at]
    before = F.broadcast(rows.sparkSession.createDataFrame(firsts, "_range long, _before long"))  # one row per range
    return rows.join(before, "_range").withColumn("rank", F.col("_before") + F.col("_place") + 1).drop("_at", "_range", "_place", "_before")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    min_words: int = 20,
    buckets: int = 10_000,
    width: int = 1,
    seed: int = 2024,
    text: str = "text",
    id: str = "doc_id",
) -> DataFrame:
    """(``id``, n_features, weight, score, rank) of every row; those with a rank are drawn to look like ``target``.

    Words are runs of a-z, 0-9 and characters beyond ASCII, after A-Z are
    lower-cased; features are runs of 1 to ``width`` words, in ``buckets`` by
    CRC-32. All texts of both tables are counted, which gives each bucket its
    gain; a row's weight is the floored mean gain of its features, and its
    score that plus Gumbel noise from (``seed``, id). Of the N rows with
    ``min_words`` words or more, floor(percent * N / 100) with the highest
    scores are drawn, which samples without replacement in proportion to
    exp(weight / 1000). Ties go to the smaller id, then to the row written first.

    Texts are read twice, once for the counts and once for the weights; they
    are never shuffled. The last place is found by counting (``kth_key``), and
    the rows drawn alone are sorted.

    NULL and empty texts have no features, weight 0. A NULL id draws its noise
    from the empty string and loses ties. Rows that repeat an id are drawn on
    their own. An empty table gives no rows, an empty target even gains for
    all buckets not seen. Other columns are not read.
    """
    gain = gains(counts_array(bucket_counts(docs, buckets, width, text), buckets), counts_array(bucket_counts(target, buckets, width, text), buckets))
    rows = weighted(docs, gain, width, text, id)
    rows = rows.withColumn("score", F.col("weight") + gumbel(seed, F.col(id))).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "scores")
    drawable = rows.where(F.col("n_words") >= min_words)
    k = percent * drawable.count() // 100
    last = kth_key(drawable, k, id, seed) if k else None
    none = rows.withColumn("rank", F.lit(None).cast("long"))
    names = [id, "n_features", "weight", "score", "rank"]
    if last is None:
        return none.select(*names)
    drawn = (F.col("n_words") >= min_words) & (_ahead(last, id) | (F.col("row") == last.row))
    order = [F.desc("score"), F.asc_nulls_last(id), F.asc("row")]
    return ranked(rows.where(drawn), order).select(*names).unionByName(none.where(~drawn).select(*names))
