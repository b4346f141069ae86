"""SentencePiece encoding and decoding: merge rounds over flat arrays of the symbols of many words at once."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.llm.words import portions

#: What stands for a space inside pieces.
SPACE = "▁"
#: A word: spaces, then anything else. No piece reaches over the end of a word.
WORD = re.compile(f"{SPACE}*[^{SPACE}]*")
#: The rank of a pair that makes no piece.
NEVER = np.int32(np.iinfo(np.int32).max)
#: Words and ids that a task keeps encoded; when there are more it starts anew.
KEPT_WORDS, KEPT_IDS = 200_000, 4_000_000
#: Bytes of results in one Arrow batch, about.
BATCH_BYTES = 4_000_000


@dataclass(eq=False)
class Model:
    """A byte-fallback BPE vocabulary as arrays.

    A symbol is a piece's id, or, from ``n`` on, a character that occurs only
    inside longer pieces, or, from ``outside`` on, any other code point.
    """

    n: int
    begin: int
    end: int
    bytes_: np.ndarray
    surface: list[bytes]
    kind: np.ndarray
    outside: int
    symbol_of: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    made: np.ndarray
    adjacent: np.ndarray
    slots: dict[str, int] = field(default_factory=dict)
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))

    def looked_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of each pair of neighbouring symbols; a lower rank merges first."""
        key = left * self.outside + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        known = (self.pairs[at] == key) & (left < self.outside) & (right < self.outside)
        return np.where(known, self.ranks[at], NEVER), self.made[at]

    def merged(self, symbols: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that are left of each segment when no two neighbours make a piece, and their segments.

        A round finds each segment's lowest pair rank and merges the pairs of
        that rank, leftmost first and without overlap; then the arrays are
        compacted, and segments without a pair leave them. Merging one at a
        time would give the same unless a merge makes a pair that goes before
        the ones left of this round. Where it does, the segment's leftmost pair
        alone is merged.
        """
        out_symbols, out_segments = [], []
        rank, made = self._neighbours(symbols, segment)
        while len(symbols):
            first = np.flatnonzero(np.diff(segment, prepend=segment[0] - 1))
            size = np.diff(first, append=len(symbols))
            least = np.minimum.reduceat(rank, first)
            done = np.repeat(least == NEVER, size)
            if done.any():
                out_symbols.append(symbols[done])
                out_segments.append(segment[done])
                symbols, segment, rank, made = (x[~done] for x in (symbols, segment, rank, made))
                if not len(symbols):
                    break
                least, size = least[least != NEVER], size[least != NEVER]
            group = np.repeat(np.arange(len(size)), size)
            at = np.flatnonzero(rank == least[group])
            at = at[_alternate(at)]
            at = self._safe(symbols, segment, rank, made, at, group)
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            new = np.zeros(len(symbols), bool)
            new[at] = True
            symbols, segment, rank, made, new = (x[keep] for x in (symbols, segment, rank, made, new))
            changed = np.flatnonzero(new)
            changed = np.unique(np.concatenate((changed, np.maximum(changed - 1, 0))))
            rank[changed], made[changed] = self._neighbours(symbols, segment, changed)
        if not out_symbols:
            return symbols, segment
        symbols, segment = np.concatenate(out_symbols), np.concatenate(out_segments)
        order = np.argsort(segment, kind="stable")
        return symbols[order], segment[order]

    def _neighbours(self, symbols: np.ndarray, segment: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of the pairs that begin at ``at``, or of all; the last symbol of a segment has no pair."""
        at = np.arange(len(symbols)) if at is None else at
        after = np.minimum(at + 1, len(symbols) - 1)
        rank, made = self.looked_up(symbols[at], symbols[after])
        return np.where((after > at) & (segment[at] == segment[after]), rank, NEVER), made

    def _safe(self, symbols, segment, rank, made, at, group) -> np.ndarray:
        """``at``, but only the first of a segment in which one of the merges makes a pair of no higher rank."""
        several = np.zeros(len(at), bool)
        several[1:] = group[at[1:]] == group[at[:-1]]
        several[:-1] |= several[1:]
        look = np.flatnonzero(several)
        if not len(look):
            return at
        here = at[look]
        piece, own = made[here], segment[here]
        right = np.minimum(here + 2, len(symbols) - 1)
        after, _ = self.looked_up(piece, symbols[right])
        after = np.where((here + 2 < len(symbols)) & (segment[right] == own), after, NEVER)
        taken = np.zeros(len(symbols), bool)
        taken[at] = True
        left, far = np.maximum(here - 1, 0), np.maximum(here - 2, 0)
        joined = taken[far] & (here >= 2)
        before, _ = self.looked_up(np.where(joined, made[far], symbols[left]), piece)
        before = np.where((here >= 1) & (segment[left] == own), before, NEVER)
        bad = np.unique(group[here[np.minimum(before, after) <= rank[here]]])
        if not len(bad):
            return at
        leader = np.ones(len(at), bool)
        leader[1:] = group[at[1:]] != group[at[:-1]]
        return at[leader | ~np.isin(group[at], bad)]

    def encoded_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, number of ids of each)."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        symbols = self.symbol_of[points].astype(np.int64)
        outside = symbols < 0
        symbols[outside] = self.outside + points[outside]
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        # Words fall apart where two characters never stand side by side in a piece; that bounds the rounds of a long one.
        key = symbols[:-1] * self.outside + symbols[1:]
        near = np.minimum(np.searchsorted(self.adjacent, key), len(self.adjacent) - 1)
        together = (self.adjacent[near] == key) & (symbols[:-1] < self.outside) & (symbols[1:] < self.outside) & (word[:-1] == word[1:])
        segment = np.concatenate(([0], np.cumsum(~together))) if len(symbols) else np.zeros(0, np.int64)
        symbols, left = self.merged(symbols, segment)
        word = word[np.searchsorted(segment, left)]
        return self._with_bytes(symbols, word, len(words))

    def _with_bytes(self, symbols: np.ndarray, word: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are no piece give way to the ids of their UTF-8 bytes."""
        lone = np.flatnonzero(symbols >= self.n)
        if not len(lone):
            return symbols.astype(np.uint32), np.bincount(word, minlength=n_words)
        inside = {s: chr(p) for p, s in self._inside().items()}
        raw = [(inside.get(s) or chr(s - self.outside)).encode("utf-8", "surrogatepass") for s in symbols[lone].tolist()]
        size = np.ones(len(symbols), np.int64)
        size[lone] = [len(x) for x in raw]
        ids = np.repeat(symbols, size)
        ids[np.repeat(symbols >= self.n, size)] = self.bytes_[np.frombuffer(b"".join(raw), np.uint8)]
        return ids.astype(np.uint32), np.bincount(np.repeat(word, size), minlength=n_words)

    @lru_cache(maxsize=1)  # noqa: B019
    def _inside(self) -> dict[int, int]:
        points = np.flatnonzero(self.symbol_of >= self.n)
        return dict(zip(points.tolist(), self.symbol_of[points].tolist(), strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, with the begin and the end id."""
        if len(self.slots) > KEPT_WORDS or len(self.ids) > KEPT_IDS:
            self.slots.clear()
            self.starts, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)
        known, sizes, listed = len(self.slots), [], []
        for text in texts:
            words = WORD.findall(SPACE + text.replace(" ", SPACE))[:-1] if text else []
            listed.extend([self.slots.setdefault(w, len(self.slots)) for w in words])
            sizes.append(len(words))
        fresh = list(self.slots)[known:]
        if fresh:
            ids, counts = self.encoded_words(fresh)
            self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(counts)))
            self.ids = np.concatenate((self.ids, ids))
        slots = np.array(listed, np.int64)
        lengths = self.starts[slots + 1] - self.starts[slots]
        ends = np.cumsum(lengths)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[slots] - ends + lengths, lengths)
        ids = self.ids[place]
        cuts = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(np.array(sizes, np.int64))))]
        return [
            np.concatenate(([self.begin], ids[s:e], [self.end])).astype("<u4") for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
        ]

    def decode(self, ids: np.ndarray) -> str:
        """The text of any ids: control ids say nothing, the space put before a text goes, bytes that are no character become U+FFFD."""
        said = np.flatnonzero(self.kind[ids] != CONTROL)
        if not len(said):
            return ""
        shown = ids[said[0] : said[-1] + 1]
        raw = b"".join(map(self.surface.__getitem__, shown.tolist()))
        cut = int(self.kind[shown[0]] == NORMAL and raw.startswith(b" "))
        if len(said) == len(shown):
            try:
                return raw[cut:].decode("utf-8")
            except UnicodeDecodeError:
                pass
        return self._mended(shown, cut)

    def _mended(self, shown: np.ndarray, cut: int) -> str:
        """Each run of byte ids is read on its own, also if a control id ends it; a byte that begins no character becomes U+FFFD."""
        is_byte = self.kind[shown] == BYTE
        out = []
        for run in np.split(shown, np.flatnonzero(np.diff(is_byte)) + 1):
            raw = b"".join(map(self.surface.__getitem__, run.tolist()))
            if self.kind[run[0]] != BYTE:
                out.append(raw.decode("utf-8"))
                continue
            at = 0
            while at < len(raw):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(raw[at : at + size].decode("utf-8"))
                        at += size
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    at += 1
        return "".join(out)[cut:]


#: Kinds of ids in a model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


@lru_cache(maxsize=2)
def model(vocabulary: str) -> Model:
    """The arrays of a public model file: BPE with byte fallback, a space before each text and no other rewriting."""
    from sentencepiece import sentencepiece_model_pb2

    file = sentencepiece_model_pb2.ModelProto()
    with open(public_tokenizers.path(vocabulary), "rb") as source:
        file.ParseFromString(source.read())
    rules, kinds = file.normalizer_spec, [p.type for p in file.pieces]
    plain = rules.name == "identity" and rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces
    if not plain or kinds.count(BYTE) != 256 or not set(kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError(f"not a plain model with byte fallback: {vocabulary}")
    pieces = [p.piece for p in file.pieces]
    id_of = {piece: i for i, piece in enumerate(pieces) if kinds[i] == NORMAL}
    if any(SPACE in piece.lstrip(SPACE) for piece in id_of):
        raise ValueError(f"pieces of several words: {vocabulary}")
    n = len(pieces)
    symbols = dict(id_of)
    for piece in id_of:
        for c in piece:
            symbols.setdefault(c, n + len(symbols) - len(id_of))
    outside = n + len(symbols) - len(id_of)
    _, rank_of = np.unique([-p.score for p in file.pieces], return_inverse=True)
    splits = sorted(
        (symbols[piece[:k]] * outside + symbols[piece[k:]], int(rank_of[i]), i)
        for piece, i in id_of.items()
        for k in range(1, len(piece))
        if piece[:k] in symbols and piece[k:] in symbols
    )
    beside = {symbols[a] * outside + symbols[b] for piece in id_of for a, b in zip(piece, piece[1:], strict=False)}
    symbol_of = np.full(0x110000, -1, np.int32)
    for c, s in symbols.items():
        if len(c) == 1:
            symbol_of[ord(c)] = s
    byte_ids = {int(pieces[i][3:5], 16): i for i in range(n) if kinds[i] == BYTE}
    values = {i: bytes([b]) for b, i in byte_ids.items()}
    unknown = (file.trainer_spec.unk_surface or " ⁇ ").encode()
    columns = [np.array(c) for c in zip(*splits, strict=True)]
    return Model(
        n=n,
        begin=file.trainer_spec.bos_id,
        end=file.trainer_spec.eos_id,
        bytes_=np.array([byte_ids[b] for b in range(256)], np.int64),
        surface=[
            values.get(i) or {UNKNOWN: unknown, CONTROL: b""}.get(kinds[i], pieces[i].replace(SPACE, " ").encode()) for i in range(n)
        ],
        kind=np.array(kinds, np.int8),
        outside=outside,
        symbol_of=symbol_of,
        pairs=columns[0].astype(np.int64),
        ranks=columns[1].astype(np.int32),
        made=columns[2].astype(np.int64),
        adjacent=np.array(sorted(beside), np.int64),
    )


def _alternate(at: np.ndarray) -> np.ndarray:
    """Of places in order, the first of each run of neighbours and every second one after it."""
    place = np.arange(len(at))
    begins = np.ones(len(at), bool)
    begins[1:] = np.diff(at) > 1
    return (place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0


def encoded(docs: DataFrame, vocabulary: str, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(``id``, ids) of every row: ids are little-endian unsigned 32-bit integers, with the begin and the end id.

    The ids are those of the ``sentencepiece`` library without sampling. A
    text is cut into words, and the different words of a batch that the task
    has not met lately are encoded together, whole words and whole texts of any
    length. NULL and empty texts have the two outer ids alone. Every row gives
    one row, with a NULL or repeated id too; an empty table gives none. Other
    columns are not read.
    """
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), T.StructField("ids", T.BinaryType())])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary_ = model(vocabulary)
        for batch in batches:
            at = 0
            for group in portions(x.as_py() for x in batch.column(1)):
                ids = pa.array([x.tobytes() for x in vocabulary_.encode(group)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(group)), ids], names=schema.names)
                at += len(group)

    return docs.select(F.col(id).alias(id), F.col(text).alias("_text")).mapInArrow(coded, schema)


def decoded(rows: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """``rows`` with a column ``decoded``: the text of their ids, as ``encoded`` writes them.

    Control ids say nothing, the space in front of the first piece goes, byte
    ids that form no character become U+FFFD, the unknown id a question mark
    sign. NULL gives NULL. Other columns are carried along; a column
    ``decoded`` of ``rows`` is replaced.
    """
    rows = rows.drop("decoded")
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())])
    place = rows.columns.index(ids)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary_ = model(vocabulary)
        for batch in batches:
            at, texts, size = 0, [], 0
            for x in batch.column(place):
                raw = x.as_py()
                texts.append(None if raw is None else vocabulary_.decode(np.frombuffer(raw, "<u4")))
                size += len(raw or b"")
                if size > BATCH_BYTES:
                    yield _with_column(batch.slice(at, len(texts)), texts, schema.names)
                    at, texts, size = at + len(texts), [], 0
            if texts:
                yield _with_column(batch.slice(at, len(texts)), texts, schema.names)

    return rows.mapInArrow(read, schema)


def _with_column(batch: pa.RecordBatch, texts: list[str | None], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=names)
