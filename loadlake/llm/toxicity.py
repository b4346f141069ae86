"""Toxic sentences by a support vector machine on a gapped subsequence kernel with Nyström landmarks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.llm.words import portions

#: Labelled documents of each class the model is fitted on at most, those of the smallest hashes of their ids.
SAMPLE_DOCUMENTS = 3_000
#: Tokens that are compared with every other token.
LANDMARKS = 96
#: Weight of each character that a matched subsequence of three spans.
DECAY = 0.9
#: Steps from one matched character to the next; 4 lets three characters be inserted.
GAP = 4
#: How much of a token's length is taken out of its kernel values: 1 would divide by its whole norm, which inserted characters raise.
LENGTH_POWER = 0.7
#: Times the model is fitted to the tokens that the one before it finds most telling.
ROUNDS = 4
#: Sentences taken from a document that is not toxic: the ones with the most telling tokens, and as many spread over the others.
SENTENCES = 3
THRESHOLD = 0.3

_SPELLED = re.compile(r"[ \t]\w(?:[ \t]\w){2,}(?!\w)")
_END = re.compile(r"(?<=[.!?])\s+|(?<=[.!?][\"')\]”»])\s+|\n")
_OTHER = re.compile(r"[\W_]+")


def prepared(text: str) -> str:
    """Lower case; letters spelled one by one are one word."""
    text = f" {text.lower()}"
    if _SPELLED.search(text):
        text = _SPELLED.sub(lambda m: " " + "".join(m[0].split()), text)
    return text


def plain(token: str) -> str:
    """The letters and digits of a token; inserted letters are left to the kernel's gaps."""
    return token if token.isalnum() else _OTHER.sub("", token)


def sentences(text: str) -> list[list[str]]:
    """White-space separated tokens of each sentence of a prepared text."""
    return [found for sentence in _END.split(text) if (found := sentence.split())]


def plain_sentences(text: str) -> list[list[str]]:
    found = [[p for t in s if (p := plain(t))] for s in sentences(prepared(text))]
    return [s for s in found if s]


class Alphabet:
    """Characters to small numbers from 1; those that no landmark has are 0 and match nothing."""

    def __init__(self, landmarks: list[str]):
        self.letters = sorted(set("".join(landmarks)))
        self.size = len(self.letters) + 1
        self.table = np.zeros(0x110000, np.int32)
        for i, c in enumerate(self.letters):
            self.table[ord(c)] = i + 1

    def flat(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Characters of all tokens, zeros between them, and where each begins."""
        blank = "\0" * GAP  # no step reaches across it
        joined = np.frombuffer((blank.join(tokens) + blank).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.zeros(len(tokens), np.int64)
        starts[1:] = np.cumsum([len(t) + GAP for t in tokens[:-1]])
        return self.table[np.minimum(joined, 0x10FFFF)], starts

    def triples(self, flat: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """For each pair of steps: the weight and, per character, the number of the subsequence that begins there.

        Subsequences with a 0 in them have numbers that no landmark's has.
        """
        n = len(flat)
        padded = np.concatenate([flat, np.zeros(2 * GAP, flat.dtype)])
        for one in range(1, GAP + 1):
            pair = (flat * self.size + padded[one : one + n]) * self.size
            for two in range(1, GAP + 1):
                yield DECAY ** (one + two + 1), pair + padded[one + two : one + two + n]


def weights_of(token: str) -> dict[str, float]:
    """The subsequences of three characters of a token, with the sum of their weights."""
    found: dict[str, float] = {}
    n = len(token)
    for i in range(n):
        for j in range(i + 1, min(n, i + GAP + 1)):
            for k in range(j + 1, min(n, j + GAP + 1)):
                u = token[i] + token[j] + token[k]
                found[u] = found.get(u, 0.0) + DECAY ** (k - i + 1)
    return found


def sizes(tokens: list[str]) -> np.ndarray:
    """What the kernel values of tokens are divided by: a power of the norm that they had if all their subsequences differed."""
    lengths = np.array([len(t) for t in tokens], np.float64)
    total = np.zeros(len(tokens))
    for one in range(1, GAP + 1):
        for two in range(1, GAP + 1):
            total += np.maximum(0.0, lengths - one - two) * DECAY ** (2 * (one + two + 1))
    return np.where(total > 0, total, 1.0) ** (LENGTH_POWER / 2)


class Kernel:
    """Kernel values of tokens and the landmarks: the product of their subsequences' weights over the product of their sizes."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.alphabet = Alphabet(landmarks)
        size = self.alphabet.size
        place = {c: i + 1 for i, c in enumerate(self.alphabet.letters)}
        weights = [weights_of(landmark) for landmark in landmarks]
        number = {u: i + 1 for i, u in enumerate(dict.fromkeys(chain.from_iterable(weights)))}
        #: Row 0 is that of subsequences no landmark has.
        self.table = np.zeros((len(number) + 1, len(landmarks)), np.float32)
        self.row = np.zeros(size**3, np.int32)
        for u, i in number.items():
            self.row[(place[u[0]] * size + place[u[1]]) * size + place[u[2]]] = i
        for j, (found, divisor) in enumerate(zip(weights, sizes(landmarks), strict=True)):
            for u, x in found.items():
                self.table[number[u], j] = x / divisor

    def values(self, tokens: list[str]) -> np.ndarray:
        """(tokens, landmarks): kernel values."""
        sums = np.zeros((len(tokens), len(self.landmarks)), np.float64)
        if tokens:
            flat, starts = self.alphabet.flat(tokens)
            for weight, number in self.alphabet.triples(flat):
                row = self.row[number]
                at = np.flatnonzero(row)
                if len(at):
                    owner = np.searchsorted(starts, at, "right") - 1
                    first = np.flatnonzero(np.diff(owner, prepend=-1))
                    sums[owner[first]] += weight * np.add.reduceat(self.table[row[at]], first, axis=0)
        return sums / sizes(tokens)[:, None]

    def direction(self, weights: np.ndarray) -> np.ndarray:
        """What a subsequence, by its number, adds to the sum of kernel values with these weights.

        The kernel is linear in a token's subsequences, so a weight for each
        landmark is one for each subsequence, and a sum over all landmarks costs
        no more than a value of one.
        """
        return (self.table @ weights)[self.row]

    def along(self, tokens: list[str], direction: np.ndarray) -> np.ndarray:
        """The weighted sum of each token's kernel values."""
        if not tokens:
            return np.zeros(0)
        flat, starts = self.alphabet.flat(tokens)
        total = np.zeros(len(flat))
        for weight, number in self.alphabet.triples(flat):
            total += weight * direction[number]
        return np.add.reduceat(total, starts) / sizes(tokens)


@dataclass
class Model:
    """Landmarks, the weight of each, an offset, and the slope and offset that turn margins into probabilities."""

    landmarks: list[str]
    weights: np.ndarray
    offset: float
    slope: float
    shift: float

    def probability(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -50, 50))))


class Scores(dict):
    """Tokens to the margin they give a sentence. Tokens seen lately are held."""

    def __init__(self, model: Model, limit: int = 300_000):
        super().__init__()
        self.model, self.limit = model, limit
        self.kernel = Kernel(model.landmarks) if model.landmarks else None
        self.direction = self.kernel.direction(model.weights) if self.kernel else None

    def learn(self, tokens: set[str]) -> None:
        if len(self) + len(tokens) > self.limit:
            self.clear()
        new = [t for t in tokens if t not in self]
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            self.update(zip(some, self.kernel.along([plain(t) for t in some], self.direction).tolist(), strict=True))

    def texts(self, texts: list[str]) -> list[float]:
        """The probability of each text's most toxic sentence, which is that of its most telling token."""
        if self.kernel is None:
            return [self.model.probability(self.model.offset)] * len(texts)
        tokens = [prepared(text).split() for text in texts]
        self.learn(set(chain.from_iterable(tokens)))
        # The value of an empty sentence is 0.
        return [self.model.probability(max(0.0, *map(self.__getitem__, split), 0.0) + self.model.offset) for split in tokens]


def sampled(docs: DataFrame, labels: DataFrame, text: str, id: str, label: str) -> DataFrame:
    """(id, text, label) of at most SAMPLE_DOCUMENTS labelled documents of each class.

    One row for each id: an id that is labelled twice counts as toxic if it is
    so once, and of the texts that share an id one is taken, by hash.
    """
    known = labels.select(F.col(id).alias("_id"), F.col(label).cast("int").alias("_label")).where("_label IN (0, 1) AND _id IS NOT NULL")
    known = known.groupBy("_id").agg(F.max("_label").alias("_label"))
    by_hash = F.xxhash64("_id", F.lit("toxicity"))
    chosen = [known.where(F.col("_label") == c).orderBy(by_hash, "_id").limit(SAMPLE_DOCUMENTS) for c in (0, 1)]
    # Twice SAMPLE_DOCUMENTS rows of two numbers.
    few = F.broadcast(chosen[0].unionByName(chosen[1]))
    texts = docs.select(F.col(id).alias("_doc"), F.col(text).alias("_text")).where("_text IS NOT NULL")
    met = texts.join(few, F.col("_doc") == F.col("_id"))
    return met.groupBy("_id", "_label").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text")).select("_id", "_text", "_label")


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", label: str = "toxic") -> Model:
    """A model of the labelled documents.

    Spark counts in how many documents of each class a token stands; the
    driver chooses landmarks among the tokens that tell most, unlike one
    another. A sentence has the kernel values of its most telling token. Which
    token that is, and in which sentences of a toxic document, its label does
    not say: each round takes them as the fit before sees them (the first by their
    nearest landmark), with their kernel values from another pass over the sample. What
    comes to the driver is bounded by the size of the sample.

    Nyström: with the landmarks' own kernel matrix K, sentences are mapped to
    k(sentence) K^(-1/2) and a linear support vector machine is fitted there, so
    a landmark's weight is K^(-1/2) w, and a token's margin a sum over landmarks.
    """
    sample = sampled(docs, labels, text, id, label).persist()
    try:
        return fitted(sample)
    finally:
        sample.unpersist()


def fitted(sample: DataFrame) -> Model:
    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, kind in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = sorted({t for s in plain_sentences(text.as_py()) for t in s if len(t) >= 3})
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([kind] * len(found), pa.int32())], names=["token", "kind"])

    counted = sample.select("_text", "_label").mapInArrow(tokens, "token string, kind int").groupBy("token")
    counts = counted.agg(F.sum("kind").alias("toxic"), F.count("*").alias("n"))
    totals = {r["_label"]: r["n"] for r in sample.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return Model([], np.zeros(0), 0.0, 1.0, -3.0)
    toxic, rest = totals[1], totals[0]
    score = F.log(((F.col("toxic") + 0.5) / toxic) / ((F.col("n") - F.col("toxic") + 0.5) / rest))
    telling = counts.where("toxic >= 2").withColumn("score", score).where("score > 1").orderBy(F.desc(F.col("score") * F.sqrt("toxic")), "token").limit(2000).collect()
    common = counts.where("n - toxic >= 20").withColumn("score", score).where("abs(score) < 0.3").orderBy(F.xxhash64("token"), "token").limit(LANDMARKS // 6).collect()
    landmarks = unlike([r["token"] for r in telling], LANDMARKS - len(common)) + [r["token"] for r in common]
    if not landmarks:
        return Model([], np.zeros(0), 0.0, 1.0, -3.0)
    kernel = Kernel(landmarks)
    own = kernel.values(landmarks)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    half = vectors @ np.diag(np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0.0)) @ vectors.T
    _, kind, k = examples(sample, landmarks, None)
    for _ in range(ROUNDS):
        w, offset = support_vectors(k @ half, 2.0 * kind - 1)
        weights = half @ w
        doc, kind, k = examples(sample, landmarks, weights)
    margins = np.maximum(k @ weights, 0.0) + offset
    worst: dict[tuple[int, int], float] = {}
    for d, y, m in zip(doc.tolist(), kind.tolist(), margins.tolist(), strict=True):
        worst[d, y] = max(worst.get((d, y), -np.inf), m)
    slope, shift = calibrated(np.array(list(worst.values())), np.array([y for _, y in worst]))
    return Model(landmarks, weights, offset, slope, shift)


def examples(sample: DataFrame, landmarks: list[str], weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, class and kernel values of the most telling token of each sentence that is learned from.

    Of a toxic document that is the one sentence that tells most, of another
    document also some of the others. Tokens are judged by ``weights`` of the
    landmarks, or by the largest kernel value where there are none yet.
    """
    sent = sample.sparkSession.sparkContext.broadcast((landmarks, weights))
    out = T.StructType([T.StructField("doc", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("k", T.ArrayType(T.FloatType()))])

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        landmarks, weights = sent.value
        kernel = Kernel(landmarks)
        direction = None if weights is None else kernel.direction(weights)
        for batch in batches:
            for doc, text, kind in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                found = plain_sentences(text.as_py())
                if not found:
                    continue
                tokens = sorted({t for s in found for t in s})
                seen = kernel.values(tokens).max(axis=1) if direction is None else kernel.along(tokens, direction)
                told = dict(zip(tokens, seen.tolist(), strict=True))
                best = [max(s, key=told.__getitem__) for s in found]
                order = sorted(range(len(found)), key=lambda i: -told[best[i]])
                chosen = order[:1] if kind else order[:SENTENCES] + order[SENTENCES :: max(1, len(order) // SENTENCES)][:SENTENCES]
                rows = kernel.values([best[i] for i in chosen]).astype(np.float32).tolist()
                arrays = [pa.array([doc] * len(rows), pa.int64()), pa.array([kind] * len(rows), pa.int32()), pa.array(rows, pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays(arrays, names=out.names)

    table = sample.select(F.xxhash64("_id").alias("doc"), "_text", "_label").mapInArrow(taken, out).toArrow()
    k = np.array(table.column("k").to_pylist(), np.float64).reshape(-1, len(landmarks))
    sent.unpersist()
    return table.column("doc").to_numpy(), table.column("kind").to_numpy(), k


def unlike(tokens: list[str], most: int) -> list[str]:
    """The first tokens that are not too similar to one before them."""
    chosen: list[tuple[str, dict[str, float], float]] = []
    for token in tokens:
        w = weights_of(token)
        norm = sum(x * x for x in w.values()) ** 0.5
        if not norm:
            continue
        if all(sum(x * other.get(u, 0.0) for u, x in w.items()) < 0.9 * norm * size for _, other, size in chosen):
            chosen.append((token, w, norm))
        if len(chosen) == most:
            break
    return [token for token, _, _ in chosen]


def support_vectors(x: np.ndarray, y: np.ndarray, cost: float = 10.0, steps: int = 50) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton steps on the rows inside the margin."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-3

    def loss(w: np.ndarray) -> float:
        return 0.5 * w @ ridge @ w + cost * (np.maximum(0, 1 - y * (z @ w)) ** 2).sum()

    for _ in range(steps):
        inside = y * (z @ w) < 1
        a = z[inside]
        target = np.linalg.solve(ridge + 2 * cost * a.T @ a, 2 * cost * a.T @ y[inside])
        size = 1.0
        while size > 1e-4 and loss(w + size * (target - w)) > loss(w):
            size /= 2
        if np.abs(size * (target - w)).max() < 1e-8:
            break
        w = w + size * (target - w)
    return w[:-1], float(w[-1])


def calibrated(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through (margin, label), softly held, by Newton steps."""
    x = np.column_stack([margin, np.ones(len(margin))])
    b = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -50, 50)))
        gradient = x.T @ (p - label) + 0.01 * b
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2), gradient)
        b = b - step
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1])


def scored(docs: DataFrame, model: Model, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(``id``, score, predicted) of every row, from its whole text alone.

    score is the probability of the text's most toxic sentence, predicted is 1
    from ``THRESHOLD`` on. Empty, blank and NULL texts have the score of a sentence
    without any known token, as have all texts if there was nothing to learn
    from. Rows that repeat get equal answers. Other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), T.StructField("score", T.DoubleType())])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(sent.value)
        for batch in batches:
            found = [p for group in portions(batch.column(1).to_pylist()) for p in scores.texts(group)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=[id, "score"])

    marked = docs.select(id, text).mapInArrow(judged, schema)
    return marked.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
