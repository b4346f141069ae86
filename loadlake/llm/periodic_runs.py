"""Periodic runs of words: maximal pairs from the LCP-interval tree of each text."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.llm.words import portions, words

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])


def shortest_repeat(min_length: int, min_exponent: int) -> int:
    """The fewest words that the two places of a maximal pair share.

    A run of length n and period p is a pair at distance p that shares n - p
    words; n is at least ``min_length`` and ``min_exponent`` times p.
    """
    return max(1, min(max((min_exponent - 1) * p, min_length - p) for p in range(1, min_length + 1)))


def refined(place: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One doubling step: places in the order of (first, second), their new group numbers, and which are still in a group.

    ``first`` numbers a group by its first place in the order, so numbers of
    groups that are not looked at again stay right.
    """
    order = np.lexsort((second, first))
    place, first, second = place[order], first[order], second[order]
    row = np.arange(len(place))
    old = np.ones(len(place), bool)
    old[1:] = first[1:] != first[:-1]
    new = old.copy()
    new[1:] |= second[1:] != second[:-1]
    old_start = np.maximum.accumulate(np.where(old, row, 0))
    new_start = np.maximum.accumulate(np.where(new, row, 0))
    tied = np.zeros(len(place), bool)
    tied[1:] = ~new[1:]
    tied[:-1] |= ~new[1:]
    return place, first + new_start - old_start, tied


def suffixes(symbols: np.ndarray, text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, lcp, word classes): places whose next ``least`` words occur again in their text, in suffix order.

    ``lcp[i]`` is the number of words that places ``i - 1`` and ``i`` share, 0
    if fewer than ``least``. Ranks of 1, 2, 4, ... words come from one another
    by sorting; each step looks only at places that are still tied, and a text
    is told from the others by its number in the first one. The class of a
    place is the rank of its word.
    """
    n = len(symbols)
    place, rank_of, tied = refined(np.arange(n), np.zeros(n, np.int64), text * (symbols.max(initial=0) + 1) + symbols)
    ranks = np.full(n + 1, -1, np.int32 if n < 1 << 31 else np.int64)
    ranks[place] = rank_of
    levels, size, starts = [ranks], 1, None
    open_ = place[tied]
    while len(open_):
        if size <= least:
            starts = open_  # these share ``size`` words with another place
        place, rank_of, tied = refined(open_, ranks[open_], ranks[np.minimum(open_ + size, n)])
        ranks = ranks.copy()
        ranks[place] = rank_of
        levels.append(ranks)
        open_, size = place[tied], 2 * size
        if not len(open_) and size <= least:
            starts = None
    if starts is None or not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), levels[0]
    starts = starts[np.argsort(ranks[starts])]
    shared = np.zeros(len(starts), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        here, before = starts[1:] + shared[1:], starts[:-1] + shared[1:]
        shared[1:] += np.where(levels[k][here] == levels[k][before], 1 << k, 0)
    shared[shared < least] = 0
    return starts, shared, levels[0]


class Interval:
    """The places of an LCP interval in text order, and apart by the class of the word to their left."""

    __slots__ = ("lists", "places")

    def __init__(self, place: int, left: int):
        self.places, self.lists = [place], {left: [place]}

    def add(self, other: Interval) -> None:
        for left, listed in other.lists.items():
            mine = self.lists.setdefault(left, [])
            for place in listed:
                insort(mine, place)
                insort(self.places, place)


def met(a: Interval, b: Interval, shared: int, reach: int, left: list[int], pairs: list[tuple[int, int, int]]) -> Interval:
    """Both intervals as one, with the pairs of places of different left classes, ``reach`` apart at most, added to ``pairs``.

    The smaller one's places look for partners in the class lists of the
    larger. Places closer together than half of what they share form chains of
    one period, and within such a chain only the first can differ from the
    others in its left word. So on either side of a place the nearest end of
    the window names the one list that may hold partners.
    """
    small, large = (a, b) if len(a.places) <= len(b.places) else (b, a)
    places = large.places
    for x in small.places:
        i = bisect_left(places, x - reach)
        if i < len(places) and places[i] < x and left[places[i]] != left[x]:
            listed = large.lists[left[places[i]]]
            for y in listed[bisect_left(listed, x - reach) : bisect_left(listed, x)]:
                pairs.append((y, x, shared))
        i = bisect_right(places, x)
        if i < len(places) and places[i] <= x + reach and left[places[i]] != left[x]:
            listed = large.lists[left[places[i]]]
            for y in listed[bisect_right(listed, x) : bisect_right(listed, x + reach)]:
                pairs.append((x, y, shared))
    large.add(small)
    return large


def maximal_pairs(starts: np.ndarray, shared: np.ndarray, classes: np.ndarray, min_exponent: int) -> list[tuple[int, int, int]]:
    """(place, later place, words shared) of maximal pairs that are no further apart than a run of that exponent allows.

    A walk over the LCP-interval tree from its leaves: an interval takes in its
    children one by one, so that two places meet exactly in the interval whose
    value is the number of words they share; the words after that differ. The
    words before differ as their lists do.
    """
    pairs: list[tuple[int, int, int]] = []
    stack: list[tuple[int, Interval]] = []
    left = classes[starts - 1].tolist()  # place 0 reads the end mark, which is no word
    left_of = dict(zip(starts.tolist(), left, strict=True))
    node = None
    for place, value in zip(starts.tolist(), shared.tolist(), strict=True):
        while stack and stack[-1][0] > value:
            height, taken = stack.pop()
            node = met(taken, node, height, height // (min_exponent - 1), left_of, pairs)
        if value:
            if stack and stack[-1][0] == value:
                node = met(stack.pop()[1], node, value, value // (min_exponent - 1), left_of, pairs)
            stack.append((value, node))
        node = Interval(place, left_of[place])
    while stack:
        height, taken = stack.pop()
        node = met(taken, node, height, height // (min_exponent - 1), left_of, pairs)
    return pairs


def runs_of(texts: list[list[bytes]], min_length: int, min_exponent: int) -> list[list[tuple[int, int, int]]]:
    """The (start, length, period) of the runs of each text, by start and period."""
    known: dict[bytes, int] = {}
    symbols = np.array([known.setdefault(w, len(known)) for listed in texts for w in listed], np.int64)
    sizes = np.array([len(x) for x in texts], np.int64)
    begin = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(texts)), sizes)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(symbols):
        return found
    pairs = maximal_pairs(*suffixes(symbols, text, shortest_repeat(min_length, min_exponent)), min_exponent)
    least: dict[tuple[int, int], int] = {}
    for x, y, shared in pairs:
        if shared + y - x >= min_length:
            # A run of a period is one of its multiples too, over the same words.
            span = (x, y + shared)
            least[span] = min(least.get(span, y - x), y - x)
    for (x, end), period in sorted(least.items(), key=lambda item: (item[0][0], item[1])):
        found[text[x]].append((x - int(begin[text[x]]), end - x, period))
    return found


def collapsed(listed: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(listed)
    edges = np.zeros(len(listed) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return b" ".join([listed[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()])


def periodic_runs(
    docs: DataFrame, min_length: int = 24, min_exponent: int = 3, text: str = "text", id: str = "doc_id"
) -> DataFrame:
    """(``id``, runs, collapsed) of every row: all runs of its words, and its text without their repetitions.

    Words are runs of anything but space and U+0009 to U+000D, numbered from 0.
    A run is a stretch with a smallest period p, of ``min_length`` words and
    ``min_exponent`` (3 or more) periods at least, that no neighbouring word
    extends at that period: an array of (start, length, period), by start, then
    period. ``collapsed`` are the words that no run holds after its first
    period, joined by one space.

    The texts of a batch, about a million characters, share one suffix order;
    work and memory follow the batch, or the one text that is longer. The pairs
    of a run are as many as its periods.

    NULL, empty and blank texts have no runs and an empty ``collapsed``. Every
    row gives one row, with a NULL or repeated id too; an empty table gives
    none. Other columns are not read.
    """
    if min_exponent < 3:
        raise ValueError("runs are looked for from three periods on")
    fields = [T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), *fields])
    run_type = pa.list_(pa.struct([(name, pa.int64()) for name in RUN.names]))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in portions(x.as_py() for x in batch.column(1)):
                listed = [words(x) for x in group]
                runs = runs_of(listed, min_length, min_exponent)
                told = [[dict(zip(RUN.names, r, strict=True)) for r in found] for found in runs]
                left = [collapsed(x, found).decode("utf-8", "surrogatepass") for x, found in zip(listed, runs, strict=True)]
                columns = [batch.column(0).slice(at, len(group)), pa.array(told, run_type), pa.array(left, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                at += len(group)

    return docs.select(F.col(id).alias(id), F.col(text).alias("_text")).mapInArrow(searched, schema)


def longest(runs: Column) -> Column:
    """The run with the greatest length in periods, compared exactly; of equal ones the first. NULL if there is none."""
    return F.aggregate(
        runs,
        F.lit(None).cast(RUN),
        lambda best, run: F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best),
    )


def made_periodic(text: Column, id: Column) -> Column:
    """``text`` with its words from some place on replaced by repetitions of the first of them, for one id in ten.

    With h the CRC-32 of the id in decimal and g = h / 10, rounded down: if h
    is a multiple of 10 and the text has n > 0 words, word i from a = g % n on
    becomes word a + (i - a) % p, where p = 1 + (n - a) / (3 + g % 8), rounded
    down. Other texts, and those of a NULL id, stay as they are.
    """
    h = F.crc32(id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    listed = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(words_: Column) -> Column:
        n = F.size(words_).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        moved = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words_, place(i).cast("int")))
        return F.when(n > 0, F.array_join(moved, " ")).otherwise(text)

    # The split words become the element of a one-element array, so that they are computed once.
    again = F.get(F.transform(F.array(listed), repeated), 0)
    return F.when(h % 10 == 0, again).otherwise(text)
