"""Long passages that repeat across documents, found on a compacted De Bruijn graph of word k-mers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.llm.words import Rolling, WordHashes, signed, words
from loadlake.sources.tables import stored

#: Words of a k-mer. A window of 50 words holds 41 of them, and the one with the smallest hash becomes an edge.
K = 10


def lowest(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


@dataclass
class Edges:
    """The k-mers of a text that are the smallest of some window, by position."""

    hashes: np.ndarray
    rolling: Rolling
    kmers: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray, window: int, k: int) -> Edges:
        """``hashes``: of the words of a text with a window at least."""
        rolling = Rolling(hashes)
        start = np.arange(len(hashes) - k + 1)
        kmers = rolling.runs(start, start + k)
        width = window - k + 1
        low = lowest(kmers, width)
        # A k-mer is chosen if it equals the minimum of a window that holds it: the largest of those minima.
        edge = np.zeros(width - 1, np.uint64)
        high = ~lowest(~np.concatenate([edge, low, edge]), width)
        return cls(hashes, rolling, kmers, np.flatnonzero(kmers == high))

    def first_of_window(self, window: int, k: int) -> np.ndarray:
        """For each window the position of its first smallest k-mer."""
        width = window - k + 1
        low = lowest(self.kmers, width)
        starts = np.arange(len(low))
        chosen = self.kmers[self.at]
        # Candidates in order of position: the first chosen k-mer at or after the start that equals the minimum.
        i = np.searchsorted(self.at, starts)
        open_ = np.flatnonzero(chosen[i] != low)
        while len(open_):
            i[open_] += 1
            open_ = open_[chosen[i[open_]] != low[open_]]
        return self.at[i]


EDGE = T.StructType(
    [
        T.StructField("kmer", T.LongType()),
        T.StructField("doc", T.LongType()),
        T.StructField("part", T.LongType()),
        T.StructField("at", T.IntegerType()),
        T.StructField("after", T.LongType()),
        T.StructField("before", T.LongType()),
    ]
)


def edges(docs: DataFrame, window: int, k: int) -> DataFrame:
    """Chosen k-mers with their source coordinates and hashes of the text to the next and from the previous one, 0 at an end."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(1)
        for batch in batches:
            parts: list[tuple[np.ndarray, ...]] = []
            rows = 0
            for doc, part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                listed = words(text.as_py())
                if len(listed) < window:
                    continue
                e = Edges.of(hashes.of(listed), window, k)
                at = e.at
                between = e.rolling.runs(at[:-1], at[1:] + k)
                end = np.zeros(1, np.uint64)
                parts.append((e.kmers[at], np.full(len(at), doc), np.full(len(at), part), at, np.append(between, end), np.append(end, between)))
                rows += len(at)
                if rows > 200_000:
                    yield joined(parts)
                    parts, rows = [], 0
            if parts:
                yield joined(parts)

    def joined(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        kmer, doc, part, at, after, before = (np.concatenate(x) for x in zip(*parts, strict=True))
        values = [signed(kmer), doc.astype(np.int64), part.astype(np.int64), at.astype(np.int32), signed(after), signed(before)]
        return pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=EDGE.names)

    return docs.select("doc", "part", "text").mapInArrow(found, EDGE)


def paths(occurrences: DataFrame, k: int) -> DataFrame:
    """(doc, part, start, end, first): stretches of a document that repeat, unbranched, in others; ``first`` is the smallest of these.

    A k-mer that two documents hold is a repeated edge. Where it is always
    followed by the same text up to the same next k-mer, and that one is always
    preceded by the same, the two are joined to one path, so every document
    that holds a part of a path holds the whole of it, word by word. The rows
    of a document's path shrink to one.
    """
    # The tables with a row per k-mer are written before they are joined: adaptive
    # execution splits a k-mer of very many rows only between two plain shuffles.
    ends = occurrences.groupBy("kmer").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    repeated = stored(ends.where("first < last").select("kmer", "first"), "kmers")
    shared = stored(occurrences.join(repeated, "kmer"), "repeated")
    shape = shared.groupBy("kmer").agg(
        (F.min("after") == F.max("after")).alias("one_after"),
        ((F.min("before") == F.max("before")) & (F.min("before") != 0)).alias("one_before"),
    )
    shape = stored(shape, "shapes")
    ordered = Window.partitionBy("doc", "part").orderBy("at")
    steps = shared.join(shape, "kmer").select(
        "doc",
        "part",
        "at",
        "first",
        (F.col("one_before") & F.lag("one_after", 1, False).over(ordered)).alias("goes_on"),
    )
    runs = steps.withColumn("run", F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).over(ordered))
    return runs.groupBy("doc", "part", "run").agg(
        F.min("at").alias("start"), (F.max("at") + k).alias("end"), F.min("first").alias("first")
    )


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` words lie in one of the stretches."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def kept_words(listed: list[bytes], removed: np.ndarray) -> tuple[int, str, bytes]:
    kept = b" ".join(w for w, gone in zip(listed, removed.tolist(), strict=True) if not gone) if removed.any() else b" ".join(listed)
    return int(removed.sum()), hashlib.sha256(kept).hexdigest(), kept


RESULT = T.StructType(
    [
        T.StructField("doc", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
        T.StructField("kept_text", T.StringType()),
    ]
)
#: As RESULT, or where windows have to be compared still, the text and these windows by two hashes and position.
SEEN = T.StructType(
    [
        *RESULT.fields,
        T.StructField("part", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("ends", T.ArrayType(T.IntegerType())),
        T.StructField("ats", T.ArrayType(T.IntegerType())),
        T.StructField("one", T.ArrayType(T.LongType())),
        T.StructField("two", T.ArrayType(T.LongType())),
    ]
)


def told_apart(docs: DataFrame) -> DataFrame:
    """``docs`` with ``part``, a hash of the text where an id comes more than once, else 0, which takes next to no room."""
    again = stored(docs.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").select("doc"), "repeated-ids")
    one = docs.withColumn("part", F.lit(0).cast("long"))
    if again.isEmpty():
        return one
    many = docs.join(again, "doc", "left_semi").withColumn("part", F.xxhash64("text"))
    return one.join(again, "doc", "left_anti").unionByName(many)


def repeated_passages(
    docs: DataFrame, window: int = 50, k: int = K, text: str = "text", id: str = "doc_id", with_text: bool = True
) -> DataFrame:
    """One row per document: ``id``, n_words, n_removed, kept_sha256, kept_text (NULL unless ``with_text``).

    A word is removed if it lies in a window of ``window`` words whose sequence
    also starts in a document with a smaller id. Windows are judged on the
    input. Words are runs of anything but space and U+0009 to U+000D; kept
    words are joined by one space.

    1. One scan turns each text into edges: of the k-mers of every window the
       one with the smallest hash, so equal windows give equal edges (about one
       row for 21 words).
    2. Edges that two documents share are compacted to unbranched paths by
       joins on the k-mer (``paths``). A window inside a path lies in the same
       documents as the path.
    3. Other windows whose smallest k-mer is shared, those across a branch or
       the end of a path, are read at their source coordinates and compared by
       a 128-bit hash of their words.

    A k-mer or window that very many documents share is reduced to a minimum
    before the shuffle and comes back in a join that adaptive execution splits.
    What is held at once is one document. Equality rests on 64-bit hashes of a
    path's k-mers and links and on 128-bit hashes of single windows.

    NULL, empty and blank texts have no words and the hash of an empty text. A
    repeated row is not "a document with a smaller id" for itself: rows of one
    id and text get the same answer, and other texts of that id an answer of
    their own. Rows with a NULL id are compared with no other and lose nothing;
    an empty table gives no rows. ``id`` must be an integer. Other columns are
    not read.
    """
    source = docs.select(F.col(id).cast("long").alias("doc"), F.col(text).alias("text"))
    named = told_apart(source.where("doc IS NOT NULL"))
    occurrences = stored(edges(named, window, k), "edges")
    spans = paths(occurrences, k).groupBy("doc", "part").agg(
        F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"), F.collect_list("first").alias("firsts")
    )

    def looked_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = WordHashes(1), WordHashes(2)
        for batch in batches:
            rows: list[dict] = []
            size = 0
            columns = [batch.column(i) for i in range(6)]
            for doc, part, value, starts, ends, firsts in zip(*columns, strict=True):
                doc, value = doc.as_py(), value.as_py()
                listed = words(value)
                row = {"doc": doc, "part": part.as_py(), "n_words": len(listed)}
                removed = np.zeros(len(listed), bool)
                if starts.is_valid:
                    starts, ends, firsts = (np.array(x.as_py(), np.int64) for x in (starts, ends, firsts))
                    order = np.argsort(starts)
                    starts, ends, firsts = starts[order], ends[order], firsts[order]
                    hashed = one.of(listed)
                    e = Edges.of(hashed, window, k)
                    # The path that holds a window's smallest k-mer: the last one that starts at or before it.
                    anchor = e.first_of_window(window, k)
                    path = np.searchsorted(starts, anchor, "right") - 1
                    at = np.arange(len(anchor))
                    on = (path >= 0) & (anchor + k <= ends[path])
                    inside = on & (starts[path] <= at) & (at + window <= ends[path])
                    gone = (firsts < doc) & (ends - starts >= window)
                    removed = covered(len(listed), starts[gone], ends[gone])
                    ats = np.flatnonzero(on & ~inside)
                    if len(ats):
                        second = Rolling(two.of(listed))
                        row |= {
                            "text": value,
                            "starts": starts[gone].tolist(),
                            "ends": ends[gone].tolist(),
                            "ats": ats.tolist(),
                            "one": signed(e.rolling.runs(ats, ats + window)).tolist(),
                            "two": signed(second.runs(ats, ats + window)).tolist(),
                        }
                if "ats" not in row:
                    row["n_removed"], row["kept_sha256"], kept = kept_words(listed, removed)
                    if with_text:
                        row["kept_text"] = kept.decode("utf-8", "surrogatepass")
                rows.append(row)
                size += len(value or "") + 120 * len(row.get("ats", ()))
                if size > 4_000_000:
                    yield pa.RecordBatch.from_pylist(rows, schema=seen)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=seen)

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = [batch.column(i) for i in range(5)]
            for doc, value, starts, ends, ats in zip(*columns, strict=True):
                listed = words(value.as_py())
                ats = np.array(ats.as_py() or [], np.int64)
                start = np.concatenate([np.array(starts.as_py(), np.int64), ats])
                end = np.concatenate([np.array(ends.as_py(), np.int64), ats + window])
                count, digest, kept = kept_words(listed, covered(len(listed), start, end))
                row = {"doc": doc.as_py(), "n_words": len(listed), "n_removed": count, "kept_sha256": digest}
                if with_text:
                    row["kept_text"] = kept.decode("utf-8", "surrogatepass")
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=result)

    seen = arrow_schema(SEEN)
    result = arrow_schema(RESULT)
    met = named.join(spans, ["doc", "part"], "left").unionByName(source.where("doc IS NULL"), allowMissingColumns=True)
    looked = stored(met.select("doc", "part", "text", "starts", "ends", "firsts").mapInArrow(looked_at, SEEN), "passages")
    pending = looked.where("ats IS NOT NULL")
    windows = pending.select("doc", "part", F.explode(F.arrays_zip("one", "two", "ats")).alias("w")).select("doc", "part", "w.*")
    known = windows.groupBy("one", "two").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    known = stored(known.select("one", "two", "first"), "windows")
    repeated = windows.join(known, ["one", "two"]).where("first < doc")
    more = repeated.select("doc", "part", F.col("ats").alias("at")).distinct().groupBy("doc", "part").agg(F.collect_list("at").alias("more"))
    settled = looked.where("ats IS NULL").select(*RESULT.names)
    rest = (
        pending.select("doc", "part", "text", "starts", "ends")
        .join(more, ["doc", "part"], "left")
        .select("doc", "text", "starts", "ends", "more")
        .mapInArrow(finished, RESULT)
    )
    return settled.unionByName(rest).withColumnRenamed("doc", id)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
