"""Reading measurement points out of landed JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keys that may hold the point list, in order of preference.
POINT_KEYS = ("series", "data", "values")


def _is_list(text: Column) -> Column:
    return F.startswith(F.ltrim(text), F.lit("["))


def _pairs(text: Column) -> Column:
    """The inner lists, if ``text`` is a list that is empty or starts with a list.

    A list of plain number lists parses at once. Anything else is taken apart
    element by element: what is no list is dropped, what is no number is NULL.
    """
    items = F.when(_is_list(text), F.from_json(text, "array<string>"))
    usable = F.when((F.size(items) == 0) | _is_list(F.get(items, F.lit(0))), items)
    one_by_one = F.transform(
        F.filter(usable, _is_list),
        lambda item: F.transform(F.from_json(item, "array<string>"), lambda x: x.try_cast("double")),
    )
    return F.coalesce(F.from_json(text, "array<array<double>>"), one_by_one)


def point_list(chunk: Column) -> Column:
    """``array<struct<ts_ms, load_mw>>`` of a chunk held as ``map<string,string>``.

    The first usable key wins; pairs shorter than two are dropped. A chunk
    without a usable key gives NULL.
    """
    pairs = F.filter(F.coalesce(*[_pairs(chunk[key]) for key in POINT_KEYS]), lambda p: F.size(p) >= 2)
    return F.transform(
        pairs,
        lambda p: F.struct(F.get(p, F.lit(0)).try_cast("long").alias("ts_ms"), F.get(p, F.lit(1)).alias("load_mw")),
    )


def index_timestamps(text: Column) -> Column:
    """Chunk start times of an index file: a bare list or ``{"timestamps": [...]}``."""
    listed = F.when(_is_list(text), F.from_json(text, "array<bigint>"))
    keyed = F.from_json(F.when(~_is_list(text), text), "timestamps array<bigint>")["timestamps"]
    return F.coalesce(listed, keyed)
