"""Language identification by words, backing off to shorter and shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.llm.words import portions

#: Documents the model is fitted on, about, however many there are.
SAMPLE_DOCUMENTS = 20_000
#: Words the model knows at most; each language has an equal part, for its most frequent ones.
VOCABULARY = 60_000
#: Up to so many languages the table of their sizes is broadcast.
BROADCAST_LANGUAGES = 10_000
#: Lengths of the n-grams of unseen words, tried in this order. A word is held between two blanks for them.
GRAMS = (4, 3, 2, 1)
#: Added to every count.
SMOOTHING = 0.5
UNDETERMINED = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    """Log frequencies of words and n-grams: rows of ``table``, a column for each language."""

    languages: list[str]
    words: dict[str, int] = field(default_factory=dict)
    grams: dict[str, int] = field(default_factory=dict)
    table: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))

    @classmethod
    def of(cls, counts: list[tuple[str, str, int]]) -> Model:
        """From (language, word, count)."""
        model = cls(sorted({language for language, _, _ in counts}))
        place = {language: i for i, language in enumerate(model.languages)}
        words: dict[str, np.ndarray] = {}
        grams: dict[int, dict[str, np.ndarray]] = {n: {} for n in GRAMS}
        zero = np.zeros(len(place))
        for language, word, n in counts:
            words.setdefault(word, zero.copy())[place[language]] += n
            for gram in (g for size in GRAMS for g in cut(word, size)):
                grams[len(gram)].setdefault(gram, zero.copy())[place[language]] += n
        known = frequencies(words)
        parts = {}
        for table in grams.values():
            parts |= frequencies({g: c for g, c in table.items() if c.sum() >= 3})
        model.words = {w: i for i, w in enumerate(known)}
        model.grams = {g: len(known) + i for i, g in enumerate(parts)}
        if known:
            model.table = np.array([*known.values(), *parts.values()])
        return model

    def rows(self, word: str) -> list[int]:
        """The row of a known word; else those of its longest known n-grams, of which the mean counts."""
        known = self.words.get(word)
        if known is not None:
            return [known]
        for size in GRAMS:
            found = [row for g in cut(word, size) if (row := self.grams.get(g)) is not None]
            if found:
                return found
        return []


def frequencies(counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    if not counts:
        return {}
    total = sum(counts.values()) + SMOOTHING * len(counts)
    return {x: np.log((n + SMOOTHING) / total).astype(np.float32) for x, n in counts.items()}


def cut(word: str, size: int) -> list[str]:
    held = f" {word} " if size > 1 else word
    return [held[i : i + size] for i in range(len(held) - size + 1)]


class Tokens(dict):
    """White-space separated tokens to rows of scores, computed once for tokens seen lately."""

    def __init__(self, model: Model, limit: int = 200_000):
        super().__init__()
        self.model, self.limit = model, limit
        self.scores = np.zeros((limit + 1, len(model.languages)), np.float32)

    def learn(self, tokens: set[str]) -> None:
        """Score all tokens that are not known yet at once. Row 0 is that of tokens without a letter."""
        if len(self) + len(tokens) > self.limit:
            self.clear()
        if len(tokens) > self.limit:
            self.limit = len(tokens)
        if len(self.scores) <= self.limit:
            self.scores = np.zeros((self.limit + 1, len(self.model.languages)), np.float32)
        rows: list[int] = []
        shares: list[float] = []
        owners: list[int] = []
        at = len(self)
        first = at + 1
        for token in tokens:
            if token in self:
                continue
            words = _LETTERS.findall(token.lower())
            if words and not token.isascii() and not any(map(str.isalpha, token)):
                words = []  # superscripts and fractions are word characters, but no letters
            at += 1
            self[token] = at if words else 0
            for word in words:
                found = self.model.rows(word)
                rows += found
                shares += [1 / len(found)] * len(found) if found else []
                owners += [at - first] * len(found)
        values = self.model.table[rows] * np.array(shares, np.float32)[:, None] if rows else np.zeros((0, 0), np.float32)
        for language in range(len(self.model.languages)):
            column = values[:, language] if rows else None
            self.scores[first : at + 1, language] = np.bincount(owners, column, at + 1 - first) if rows else 0

    def texts(self, texts: list[str]) -> list[tuple[str, float]]:
        if not self.model.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        split = [text.split() for text in texts]
        self.learn({t for tokens in split for t in tokens})
        return [self.text(tokens) for tokens in split]

    def text(self, tokens: list[str]) -> tuple[str, float]:
        at = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        if not at.any():
            return UNDETERMINED, 0.0
        total = self.scores[at].sum(axis=0, dtype=np.float64)
        odds = np.exp(total - total.max())
        best = int(total.argmax())
        return self.model.languages[best], float(odds[best] / odds.sum())


def held_out(id: str = "doc_id") -> Column:
    """Documents that no model learns from."""
    return F.pmod(F.crc32(F.col(id).cast("string").cast("binary")), F.lit(4)) == 2


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", id: str = "doc_id") -> Model:
    """A model of the languages of ``docs``.

    It is fitted on a bounded sample: each language has an equal part of
    ``SAMPLE_DOCUMENTS``, about, chosen by a hash of the id, and all its
    documents if they are fewer. Their words are counted by Spark; each
    language's most frequent words, its part of ``VOCABULARY``, come to the
    driver, ties in order of the word. So no language is lost beside a large
    one. N-grams are counted over these words.
    """
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    usable = usable.select(F.col(lang).alias("language"), F.col(text).alias("_text"), F.col(id).alias("_id"))
    sizes = usable.groupBy("language").agg(F.count("*").alias("_size"))
    languages = max(1, sizes.count())
    if languages <= BROADCAST_LANGUAGES:
        sizes = F.broadcast(sizes)
    share = F.lit(SAMPLE_DOCUMENTS / languages) / F.col("_size")
    chosen = F.pmod(F.xxhash64("_id", F.lit("language")), F.lit(1 << 20)) < F.ceil(share * (1 << 20))
    words = usable.join(sizes, "language").where(chosen).select("language", F.explode(F.split(F.lower("_text"), r"[^\p{L}]+")).alias("word"))
    counts = words.where("word <> ''").groupBy("language", "word").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("language").orderBy(F.desc("n"), "word"))
    top = counts.withColumn("place", place).where(F.col("place") <= max(1, VOCABULARY // languages))
    return Model.of([(r["language"], r["word"], r["n"]) for r in top.orderBy(F.desc("n"), "language", "word").collect()])


def predicted(docs: DataFrame, model: Model, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(``id``, lang_pred, score) of every row, from its whole text alone.

    score is the posterior probability of lang_pred under equal priors.
    Texts that are NULL or have no letter are ``und`` with score 0; so is every
    text if the model knows no language. Rows that repeat get equal answers.
    The model is bounded (``VOCABULARY``) and is sent to the executors once.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [
            T.StructField(id, docs.schema[id].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(sent.value)
        for batch in batches:
            found = [f for group in portions(batch.column(1).to_pylist()) for f in tokens.texts(group)]
            arrays = [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[id, "lang_pred", "score"])

    return docs.select(id, text).mapInArrow(scored, schema)


def identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which a language is found, with all their columns and in one pass; the others are rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(sent.value)
        for batch in batches:
            groups = portions(batch.column(at).to_pylist())
            mask = [lang != UNDETERMINED for group in groups for lang, _ in tokens.texts(group)]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(known, docs.schema)
