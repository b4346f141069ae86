"""Near-duplicate embeddings by a subspace pigeonhole join."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.llm.components import components
from loadlake.sources.tables import stored

#: Dimensions of a block.
BLOCK = 8
#: Added to the squared-distance budget, so that rounding loses no pair; the exact check decides.
SLACK = 1e-6

_CELL_BITS = 6


@lru_cache(maxsize=8)
def rotation(size: int, seed: int) -> np.ndarray:
    """A fixed random orthonormal matrix; it spreads a distance evenly over the blocks."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


CELLS = T.StructType(
    [
        T.StructField("label", T.IntegerType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("cell", T.LongType()),
        T.StructField("own", T.BooleanType()),
        T.StructField("id", T.LongType()),
        T.StructField("place", T.ArrayType(T.FloatType(), False)),
    ]
)


def cells(vectors: DataFrame, cosine: float, probes: bool, seed: int = 0) -> DataFrame:
    """The grid cells of each vector, for each block of its rotated direction.

    Two unit vectors of a cosine of ``cosine`` have the squared distance
    2 - 2 * cosine; of b blocks one has a b-th of it at most. That is the
    budget of a block, and its root the radius. Cells are two radii wide, so a
    ball around a point touches, of the two neighbours in a dimension, the
    nearer one at most, and a subset of the dimensions says which cells it
    touches. With ``probes`` a row is made for each touched cell that comes
    after the vector's own one in order (each pair of cells once) and for its
    own; without, for its own cell only. ``place`` is filled up with zeros to
    ``BLOCK`` numbers, which adds no distance.
    """

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column(3))
            for size in np.unique(sizes).tolist():
                same = batch.take(pa.array(np.flatnonzero(sizes == size)))
                for at in range(0, same.num_rows, 2000):
                    part = same.slice(at, 2000)
                    x = np.stack([np.asarray(v, np.float64) for v in part.column(2).to_pylist()])
                    x = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ rotation(size, seed)
                    labels, ids = part.column(0).to_numpy(), part.column(1).to_numpy()
                    for block in range(blocks(size)):
                        yield from laid(labels, ids, x[:, block * BLOCK : (block + 1) * BLOCK], block, size)

    def laid(labels: np.ndarray, ids: np.ndarray, y: np.ndarray, block: int, size: int) -> Iterator[pa.RecordBatch]:
        d = y.shape[1]
        budget = (2 - 2 * cosine) / blocks(size) + SLACK
        radius = budget**0.5
        scale = 1 << _CELL_BITS
        weight = scale ** np.arange(d - 1, -1, -1, dtype=np.int64)
        cell = np.floor(y / (2 * radius)).astype(np.int64)
        # Cells far out are folded together: they only make more candidates.
        key = (np.clip(cell, -scale // 2 + 1, scale // 2 - 2) + scale // 2) @ weight
        rows, shift = np.arange(len(y)), np.zeros(len(y), np.int64)
        if probes:
            inside = y - cell * 2 * radius
            up = inside > radius
            gap = np.where(up, 2 * radius - inside, inside) ** 2
            subsets = ((np.arange(1 << d)[:, None] >> np.arange(d)) & 1).astype(np.float64)
            rows, subset = np.nonzero(gap @ subsets.T <= budget)
            step = np.where(up, weight, -weight)
            shift = np.einsum("ij,ij->i", step[rows], subsets[subset].astype(np.int64))
            keep = shift >= 0
            rows, shift = rows[keep], shift[keep]
        place = np.zeros((len(rows), BLOCK), np.float32)
        place[:, :d] = y[rows]
        arrays = [
            pa.array(labels[rows].astype(np.int32)),
            pa.array(np.full(len(rows), size, np.int32)),
            pa.array(np.full(len(rows), block, np.int32)),
            pa.array(key[rows] + shift),
            pa.array(shift == 0),
            pa.array(ids[rows]),
            pa.ListArray.from_arrays(np.arange(0, place.size + 1, BLOCK, dtype=np.int32), place.ravel()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=CELLS.names)

    return vectors.select("label", "id", "v", F.size("v")).mapInArrow(placed, CELLS)


def blocks(size: int) -> int:
    """The number of blocks of a vector of ``size`` dimensions."""
    return -(-size // BLOCK)


def links(vectors: DataFrame, cosine: float) -> DataFrame:
    """Pairs (a, b), a < b, of distinct vectors of one label and length with that cosine at least; ``vectors``: label, id, v."""
    budget = F.lit(2 - 2 * cosine) / F.ceil(F.col("size") / BLOCK) + 2 * SLACK
    here = cells(vectors, cosine, probes=True).withColumnsRenamed({"id": "a", "place": "pa"})
    there = cells(vectors, cosine, probes=False).drop("own").withColumnsRenamed({"id": "b", "place": "pb"})
    gaps = [(F.col("pa")[i] - F.col("pb")[i]) * (F.col("pa")[i] - F.col("pb")[i]) for i in range(BLOCK)]
    near = sum(gaps[1:], gaps[0]) <= budget
    met = here.join(there, ["label", "size", "block", "cell"]).where((~F.col("own") | (F.col("a") < F.col("b"))) & near)
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sides = [vectors.select(F.col("id").alias(s), F.col("v").cast("array<double>").alias(f"v{s}")) for s in "ab"]
    full = pairs.join(sides[0], "a").join(sides[1], "b")

    def product(x: str, y: str):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    return full.where(product("va", "vb") / (F.sqrt(product("va", "va")) * F.sqrt(product("vb", "vb"))) >= cosine).select("a", "b")


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.93, embedding: str = "embedding", label: str = "label", id: str = "vec_id"
) -> DataFrame:
    """One row per vector: ``id``, n_links, component_id, kept.

    Vectors are linked if their labels are equal and not NULL and their cosine,
    in double precision, is at least ``cosine`` (which must be positive).
    n_links counts the other vectors linked directly, component_id is the
    smallest id reachable, kept says that it is the vector's own.

    Rotated unit vectors are cut into blocks of ``BLOCK`` dimensions; by the
    pigeonhole principle a linked pair lies within its share of the squared
    distance in one block, where a grid brings it together. Candidates of all
    blocks are united and verified on the whole vectors. Equal vectors of a
    label are reduced to the smallest id before, and counted: copies of a
    vector never meet each other. No pair is left out for a bucket's size.

    NULL vectors and labels, zero vectors and vectors with NULL, NaN or
    infinite components link with nothing, vectors of different lengths not
    with one another. Rows that repeat an id count as one vector more each, with
    the links of their own vector. Rows with a NULL id link with nothing. An
    empty table gives no rows. Other columns are not read.
    """
    value = F.col(embedding)
    named = vectors.select(F.col(id).cast("long").alias("id"), F.col(label).cast("int").alias("label"), value.alias("v"))
    finite = F.coalesce(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False)
    )
    fits = finite & F.col("label").isNotNull() & F.col("id").isNotNull()
    whole = F.col("id").eqNullSafe(F.col("component_id"))
    marked = named.where(fits).withColumn("mark", F.sha2(F.concat_ws(",", F.transform("v", lambda x: x.cast("string"))), 256))
    # Ids may repeat, so distinct vectors get numbers; they are written, so these stay the same in every use.
    distinct = stored(
        marked.groupBy("label", "mark")
        .agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.any_value("v").alias("v"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    pairs = stored(links(distinct.select("label", F.col("node").alias("id"), "v"), cosine), "pairs")
    ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weights = distinct.select(F.col("node").alias("b"), "copies")
    degree = ends.join(weights, "b").groupBy("a").agg(F.sum("copies").alias("others")).withColumnRenamed("a", "node")
    members = stored(components(pairs, "a", "b").join(distinct.select("node", "rep"), "node"), "members")
    named_by = members.groupBy("component").agg(F.min("rep").alias("lowest"))
    found = members.join(named_by, "component").select("node", "lowest")
    known = (
        distinct.select("label", "mark", "node", "rep", "copies")
        .join(degree, "node", "left")
        .join(found, "node", "left")
        .select(
            "label",
            "mark",
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("lowest", "rep").alias("component_id"),
        )
    )
    linked = marked.join(known, ["label", "mark"]).select("id", "n_links", "component_id")
    alone = named.where(~F.coalesce(fits, F.lit(False))).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return linked.unionByName(alone).select(F.col("id").alias(id), "n_links", "component_id", whole.alias("kept"))
