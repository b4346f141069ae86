"""Packing documents into token sequences as a cutting-stock problem."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.llm.tokens import encoder
from loadlake.sources.tables import stored

#: A document is cut into whole sequences, one piece of a multiple of STEP ids, and one of the fewer ids that are left.
STEP = 64
#: Rows of one bucket of the ranking, about.
BUCKET_ROWS = 50_000

PIECE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def cuts(n: int, capacity: int, step: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    found = [(at, capacity) for at in range(0, n - capacity + 1, capacity)]
    at = n // capacity * capacity
    large = (n - at) // step * step
    return found + [(s, m) for s, m in ((at, large), (at + large, n - at - large)) if m]


def pieces(
    docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = 2048, step: int = STEP, text: str = "text", id: str = "doc_id"
) -> DataFrame:
    """Pieces of every document's token ids: doc_id, start, length, doc_tokens, ids (little-endian unsigned 32-bit).

    NULL text is empty; an empty document has the end id alone.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        schema = pa.schema(
            [("doc_id", pa.int64()), *((n, pa.int64()) for n in ("start", "length", "doc_tokens")), ("ids", pa.binary())]
        )
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            size = 0
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(value.as_py() or ""), end_id], "<u4")
                for start, length in cuts(len(ids), capacity, step):
                    part = (doc, start, length, len(ids), ids[start : start + length].tobytes())
                    for column, x in zip(columns, part, strict=True):
                        column.append(x)
                size += 4 * len(ids)
                if size > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
                    columns, size = [[], [], [], [], []], 0
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return docs.select(F.col(id).cast("long"), text).mapInArrow(cut, PIECE)


@dataclass
class Pattern:
    """How many pieces of each length a sequence holds, and how many such sequences there are."""

    counts: dict[int, int]
    times: int = 1

    def filled(self) -> int:
        return sum(length * n for length, n in self.counts.items())


@dataclass
class _Program:
    """The restricted linear program: columns, an inverse of the basis and the current solution."""

    demand: np.ndarray
    columns: list[np.ndarray]
    inverse: np.ndarray = field(init=False)
    solution: np.ndarray = field(init=False)

    def __post_init__(self):
        self.refresh()

    def refresh(self) -> None:
        self.inverse = np.linalg.inv(np.array(self.columns).T)
        self.solution = self.inverse @ self.demand

    def enter(self, column: np.ndarray) -> bool:
        """Bring a column in by a primal simplex step; False if it gains nothing."""
        direction = self.inverse @ column
        up = direction > 1e-9
        ratios = np.where(up, np.maximum(self.solution, 0) / np.where(up, direction, 1), np.inf)
        row = int(np.argmin(ratios))
        if not np.isfinite(ratios[row]):
            return False
        self.columns[row] = column
        self.refresh()
        return True


def priced(lengths: list[int], prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of the largest total price within the capacity, by unbounded knapsack dynamic programming.

    ``best[i, c]`` is the price of the best pattern of the first ``i`` lengths in
    room ``c``. Taking j pieces of a length moves j lengths on at the same
    remainder, so one running maximum per remainder covers every j at once.
    """
    best = np.zeros((len(lengths) + 1, capacity + 1))
    for i, length in enumerate(lengths):
        steps = -(-(capacity + 1) // length)
        paid = prices[i] * np.arange(steps)[:, None]
        table = np.full(steps * length, -np.inf)
        table[: capacity + 1] = best[i]
        table = np.maximum.accumulate(table.reshape(steps, length) - paid, axis=0) + paid
        best[i + 1] = np.maximum(best[i], table.ravel()[: capacity + 1])
    counts, c = np.zeros(len(lengths)), capacity
    for i in range(len(lengths), 0, -1):
        while c >= lengths[i - 1] and best[i, c] > best[i - 1, c] + 1e-12:
            counts[i - 1] += 1
            c -= lengths[i - 1]
    return float(counts @ prices), counts


def cutting_stock(histogram: dict[int, int], capacity: int, rounds: int = 2000) -> list[Pattern]:
    """Patterns that hold every piece of a histogram of lengths, in close to the fewest sequences.

    Column generation: the linear program over the patterns known so far gives
    each length a price, the knapsack finds the pattern of the highest price,
    and while that is above 1 it enters. The solution is rounded down and the
    few pieces that are left, less than one pattern of each basic column, go
    into the fullest sequence that has room, longest first. The work depends
    on the number of different lengths only. ``rounds`` bounds the columns;
    when it is reached the patterns are merely less good.
    """
    lengths = sorted(x for x, n in histogram.items() if n)
    if not lengths:
        return []
    demand = np.array([histogram[x] for x in lengths], float)
    program = _Program(demand, [np.eye(len(lengths))[i] * (capacity // x) for i, x in enumerate(lengths)])
    for _ in range(rounds):
        prices = np.ones(len(lengths)) @ program.inverse
        value, column = priced(lengths, prices, capacity)
        if value <= 1 + 1e-7 or not program.enter(column):
            break
    left = demand.astype(np.int64).copy()
    found = []
    for column, times in sorted(zip(program.columns, program.solution, strict=True), key=lambda x: -x[1]):
        counts = column.astype(np.int64)
        used = counts > 0
        whole = min(int(np.floor(times + 1e-6)), int((left[used] // counts[used]).min()))
        if whole > 0:
            left -= whole * counts
            found.append(Pattern({lengths[i]: int(counts[i]) for i in np.flatnonzero(used)}, whole))
    return found + fullest(dict(zip(lengths, left.tolist(), strict=True)), capacity)


def fullest(left: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit, longest first, for the few pieces that rounding leaves."""
    open_: list[tuple[int, dict[int, int]]] = []
    for length in sorted(left, reverse=True):
        for _ in range(left[length]):
            fits = [i for i, (room, _) in enumerate(open_) if room >= length]
            if fits:
                i = min(fits, key=lambda j: open_[j][0])
            else:
                i = len(open_)
                open_.append((capacity, {}))
            room, counts = open_[i]
            counts[length] = counts.get(length, 0) + 1
            open_[i] = (room - length, counts)
    return [Pattern(counts) for _, counts in open_]


def slots(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank + 1, pieces a sequence, first sequence, offset) for each length in each pattern."""
    rows, ranks, sequence = [], {}, 0
    for p in patterns:
        offset = 0
        for length, n in sorted(p.counts.items(), reverse=True):
            first = ranks.get(length, 0)
            ranks[length] = first + n * p.times
            rows.append((length, first, ranks[length], n, sequence, offset))
            offset += n * length
        sequence += p.times
    return rows


def ranked(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` with their rank among rows of one length, from 0, without sorting a length in one task.

    Rows are dealt to buckets by a hash of id and start; a bucket's first rank is
    the sum of the counts before it. The number of buckets follows the rows.
    """
    buckets = max(1, total // BUCKET_ROWS)
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start", "salt"), F.lit(buckets)))
    counts = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "start", "salt")
    return (
        dealt.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(firsts, ["length", "_bucket"])
        .withColumn("rank", F.col("_first") + F.col("_rank"))
        .drop("_bucket", "_first", "_rank")
    )


def packed(rows: DataFrame, capacity: int = 2048) -> DataFrame:
    """``rows`` of (doc_id, start, length, ...) with sequence_id and offset.

    Each length's pieces are ranked; a pattern's slots of that length take a
    stretch of ranks, so a piece finds its sequence by its rank alone. The
    driver sees the histogram of lengths (at most ``capacity`` numbers) and
    hands out the slots: at most one row for each length in each pattern, and
    there are no more patterns than twice the different lengths.
    """
    # Equal rows (copies of a document) are told apart by a salt, or their rank would hang on one hash.
    rows = stored(rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), "pieces")
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = slots(cutting_stock(histogram, capacity))
    spark = rows.sparkSession
    schema = "length long, _from long, _to long, _each long, _sequence long, _offset long"
    where = F.broadcast(spark.createDataFrame(table, schema))
    ranks = ranked(rows, sum(histogram.values()))
    met = ranks.join(where, (ranks["length"] == where["length"]) & (F.col("rank") >= F.col("_from")) & (F.col("rank") < F.col("_to")))
    at = F.col("rank") - F.col("_from")
    return met.select(
        *[ranks[c] for c in rows.columns if c != "salt"],
        (F.col("_sequence") + F.floor(at / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + F.pmod(at, F.col("_each")) * ranks["length"]).cast("long").alias("offset"),
    )
