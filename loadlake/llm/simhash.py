"""SimHash near-duplicates: fingerprints meet in a grid of bit counts and are compared exactly."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.llm.components import components
from loadlake.sources.tables import stored

SEED = 42
#: The fingerprint is cut in two halves of eight segments, four bits each.
HALVES, SEGMENTS, SEGMENT_BITS = 2, 8, 4
#: Shingles whose bits are counted at once, so that a long text needs no more memory than this many rows of 64.
CHUNK = 1 << 15


def fingerprint(text: str | None, width: int) -> int:
    """The 64 majority bits of the XXH64 hashes of a text's shingles, repeats included; 0 for a text without words."""
    listed = [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()
    if not listed:
        return 0
    joined = memoryview(b" ".join(listed))
    ends = np.cumsum([len(w) + 1 for w in listed]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends.tolist()[min(width, len(listed)) - 1 :]
    hashed = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(ends), CHUNK):
        part = [hashed(joined[s:e], SEED) for s, e in zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=False)]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits((2 * ones > len(ends)).astype(np.uint8), bitorder="little")
    return int(majority.view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(``id``, fingerprint as a long) of every row.

    A-Z are lower-cased, words are runs of anything but space and U+0009 to
    U+000D, ``width`` words joined by spaces are a shingle. A text of fewer
    words is one shingle; NULL, empty and blank texts have fingerprint 0.
    """
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), T.StructField("fingerprint", T.LongType())])

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(x.as_py(), width) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.int64())], names=[id, "fingerprint"])

    return docs.select(id, text).mapInArrow(marked, schema)


def bit_counts(half: Column) -> Column:
    """The number of set bits of each four-bit segment of a 32-bit half, in that segment's place."""
    pairs = half - F.shiftrightunsigned(half, 1).bitwiseAND(F.lit(0x55555555))
    low = F.lit(0x33333333)
    return pairs.bitwiseAND(low) + F.shiftrightunsigned(pairs, 2).bitwiseAND(low)


def grid_steps(radius: int) -> list[int]:
    """Steps in a half's grid of Manhattan length ``radius`` at most, one of each two opposite ones, as packed numbers.

    For the radius 1 of the default distance these are the eight unit steps.
    """
    found = []
    for step in product(range(-radius, radius + 1), repeat=SEGMENTS):
        if 0 < sum(map(abs, step)) <= radius and next(x for x in step if x) > 0:
            found.append(sum(x << (SEGMENT_BITS * i) for i, x in enumerate(step)))
    return found


def links(marks: DataFrame, distance: int = 3) -> DataFrame:
    """Pairs (a, b) of ids whose fingerprints differ in ``distance`` bits at most; ``marks`` has distinct fingerprints.

    Each fingerprint becomes its vector of bit counts per segment. The Manhattan
    distance of two vectors is never above the number of bits in which the
    fingerprints differ, and if that is at most ``distance``, one half differs
    in at most ``distance // 2`` of them. So a fingerprint's half only has to
    meet the grid cells within that Manhattan distance, and each pair is
    compared exactly in the join itself. Of two opposite steps one is taken, so
    a pair meets once per half at most.
    """
    steps = F.array(*[F.lit(s).cast("long") for s in grid_steps(distance // HALVES)])
    half_bits = 64 // HALVES
    halves = [
        F.shiftrightunsigned("fingerprint", half_bits * h).bitwiseAND(F.lit((1 << half_bits) - 1)) for h in range(HALVES)
    ]
    cells = marks.select("id", "fingerprint", F.posexplode(F.array(*map(bit_counts, halves))).alias("half", "cell"))
    there = cells.select("half", "cell", F.col("id").alias("b"), F.col("fingerprint").alias("fb"))
    here = cells.select(
        "half",
        "cell",
        F.col("id").alias("a"),
        F.col("fingerprint").alias("fa"),
        F.explode(F.concat(F.array(F.lit(0).cast("long")), steps)).alias("step"),
    ).select("half", (F.col("cell") + F.col("step")).alias("cell"), "a", "fa", "step")
    close = F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= distance
    met = here.join(there, ["half", "cell"]).where(close & ((F.col("step") != 0) | (F.col("a") < F.col("b"))))
    return met.select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, width: int = 3, distance: int = 3, text: str = "text", id: str = "doc_id"
) -> DataFrame:
    """One row per document: ``id``, fingerprint (16 hex digits), component_id.

    Documents are linked if their fingerprints differ in ``distance`` bits at
    most; component_id is the smallest id reachable, the document itself
    included. Documents of one fingerprint are reduced to their smallest id
    before anything is joined, so copies never meet each other.

    Texts without words have fingerprint 0 and are linked like any other. Rows
    that repeat an id and its text get the same answer. A NULL id takes part
    through its fingerprint only: component_id is NULL if no row of that
    fingerprint has an id. Other columns are not read.
    """
    marks = stored(fingerprints(docs, width, text, id).withColumnRenamed(id, "id"), "fingerprints")
    distinct = stored(marks.groupBy("fingerprint").agg(F.min("id").alias("id")), "distinct")
    found = components(links(distinct.where("id IS NOT NULL"), distance), "a", "b")
    named = distinct.join(found, F.col("id") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("component", "id").alias("component_id")
    )
    return marks.join(named, "fingerprint").select(
        F.col("id").alias(id), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def without_near_copies(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id names their component, with all their columns."""
    found = near_duplicates(docs, text=text, id=id)
    dropped = found.where(F.col(id) != F.col("component_id")).select(id).distinct()
    return docs.join(dropped, id, "left_anti")
