"""Quality scores from random-indexing word vectors and a small network.

Every token has a sparse random index vector. A word's vector is the sum of the index vectors of the words
around it in the labelled sample, so words used alike get similar vectors. A text is the mean
of its tokens' vectors. A network of two layers, written in numpy, tells label 1 from label 0, and its
logits are divided by a temperature that fits rows kept out of its training.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamfuse.llm.language import crc32_text

# Bounds of the labelled sample: rows drawn, and characters of each (from a place that its hash chooses).
SAMPLE_ROWS = 6_000
SAMPLE_CHARS = 3_000
VOCABULARY = 8_000
MIN_COUNT = 4
DIMENSIONS = 48
NONZERO = 6
WINDOW = 2
HIDDEN = 24
EPOCHS = 60
SEED = 11

# Words, or runs of other signs, case kept.
_TOKEN = re.compile(r"\w+|[^\w\s]+")


# Stands for a token that repeats the one before it.
AGAIN = "<again>"


def tokens_of(text: str) -> list[str]:
    """Words and runs of signs; a token right after its equal counts as a repetition."""
    found = _TOKEN.findall(text)
    return [AGAIN if t == before else t for before, t in zip([None, *found], found, strict=False)]


def shape(token: str) -> str:
    """What a rare token is counted as: its kind of letters and a rough length."""
    if token.isupper():
        kind = "upper"
    elif token.islower():
        kind = "lower"
    elif token.istitle():
        kind = "title"
    elif token.isdigit():
        kind = "digit"
    elif token[0].isalnum():
        kind = "mixed"
    else:
        kind = "sign"
    return f"<{kind}{min(len(token), 12) // 4}>"


def index_vector(token: str, dimensions: int = DIMENSIONS, nonzero: int = NONZERO) -> np.ndarray:
    """A few entries of +1 and -1 at places that the token's hash chooses."""
    draw = np.random.default_rng(zlib.crc32(token.encode()))
    vector = np.zeros(dimensions, dtype=np.float32)
    places = draw.choice(dimensions, nonzero, replace=False)
    vector[places] = np.where(np.arange(nonzero) % 2 == 0, 1.0, -1.0)
    return vector


class WordVectors:
    """Vectors of the sample's frequent tokens and of the shapes that stand for all others."""

    def __init__(self, texts: list[str]):
        counts: Counter[str] = Counter()
        split = [tokens_of(t) for t in texts]
        for tokens in split:
            counts.update(tokens)
        frequent = sorted((t for t in counts if counts[t] >= MIN_COUNT), key=lambda t: (-counts[t], t))
        self.number = {t: i for i, t in enumerate(frequent[:VOCABULARY])}
        for t in sorted({shape(t) for t in counts} - self.number.keys()):
            self.number[t] = len(self.number)
        # The last number is for shapes that the sample doesn't have.
        size = len(self.number) + 1
        index = np.zeros((size, DIMENSIONS), dtype=np.float32)
        for t, i in self.number.items():
            index[i] = index_vector(t)
        around = np.zeros((size, DIMENSIONS), dtype=np.float64)
        pieces = [np.append(self.ids(tokens), -1) for tokens in split]
        run = np.concatenate(pieces) if pieces else np.zeros(0, dtype=np.int64)
        for step in range(1, WINDOW + 1):
            left, right = run[:-step], run[step:]
            # A pair across the end of a text is no neighbourhood; -1 marks the ends.
            within = (left >= 0) & (right >= 0)
            if step == 2:
                within &= run[1:-1] >= 0
            left, right = left[within], right[within]
            for d in range(DIMENSIONS):
                around[:, d] += np.bincount(left, weights=index[right, d], minlength=size)
                around[:, d] += np.bincount(right, weights=index[left, d], minlength=size)
        norm = np.linalg.norm(around, axis=1, keepdims=True)
        # A token's own index vector keeps it apart from others in like surroundings.
        own = index / np.sqrt(NONZERO)
        self.vectors = (around / np.where(norm > 0, norm, 1.0) + own).astype(np.float32)
        self.vectors[-1] = 0

    def ids(self, tokens: list[str]) -> np.ndarray:
        number, other = self.number, len(self.number)
        out = []
        for t in tokens:
            i = number.get(t)
            out.append(number.get(shape(t), other) if i is None else i)
        return np.array(out, dtype=np.int64)

    def pooled(self, text: str) -> np.ndarray:
        """Mean vector of the whole text; zero for a text without tokens."""
        ids = self.ids(tokens_of(text))
        if len(ids) == 0:
            return np.zeros(DIMENSIONS, dtype=np.float64)
        # Each number once, times its count: bounded by the vocabulary, however long the text.
        seen, times = np.unique(ids, return_counts=True)
        return (times @ self.vectors[seen]) / len(ids)


@dataclass
class Network:
    """Two layers and a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on the logistic loss with a little weight decay; every fifth row fits the temperature."""
    draw = np.random.default_rng(SEED)
    kept = np.arange(len(y)) % 5 == 4
    fit_x, fit_y = (x[~kept], y[~kept]) if kept.any() else (x, y)
    mean, scale = fit_x.mean(axis=0), fit_x.std(axis=0) + 1e-6
    z = (fit_x - mean) / scale
    p = {
        "w1": draw.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)),
        "b1": np.zeros(HIDDEN),
        "w2": draw.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        "b2": np.zeros(1),
    }
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    t = 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(z))
        for at in range(0, len(order), 64):
            rows = order[at : at + 64]
            h = np.tanh(z[rows] @ p["w1"] + p["b1"])
            error = 1 / (1 + np.exp(-np.clip(h @ p["w2"] + p["b2"], -30, 30))) - fit_y[rows]
            back = error[:, None] * p["w2"] * (1 - h * h)
            n = len(rows)
            grads = {
                "w1": z[rows].T @ back / n + 1e-4 * p["w1"],
                "b1": back.mean(axis=0),
                "w2": h.T @ error / n + 1e-4 * p["w2"],
                "b2": np.array([error.mean()]),
            }
            t += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                step = first[k] / (1 - 0.9**t) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
                p[k] = p[k] - 0.01 * step
    net = Network(mean, scale, p["w1"], p["b1"], p["w2"], float(p["b2"][0]))
    if kept.any():
        raw, truth = net.logits(x[kept]), y[kept]
        choices = np.exp(np.linspace(np.log(0.25), np.log(8), 60))

        def loss(temperature: float) -> float:
            q = 1 / (1 + np.exp(-np.clip(raw / temperature, -30, 30)))
            return float(-np.mean(truth * np.log(q + 1e-12) + (1 - truth) * np.log(1 - q + 1e-12)))

        net.temperature = float(min(choices, key=loss))
    return net


def is_held_out():
    return F.coalesce(crc32_text("doc_id") % 3 == 1, F.lit(False))


def labelled_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple[int, str]]:
    """About ``rows`` (quality, excerpt) drawn by hash from the labelled documents, equal ones once."""
    known = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(
        F.min("quality").alias("low"), F.max("quality").alias("quality")
    )
    # A document whose labels disagree teaches nothing.
    known = known.filter((F.col("low") == F.col("quality")) & ~is_held_out())
    n = known.count()
    if n == 0:
        return []
    draw = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_003)) / 1_000_003.0
    drawn = known.filter(draw < min(1.0, rows / n)).select("doc_id", "quality")
    room = F.greatest(F.char_length("text") - SAMPLE_CHARS, F.lit(0))
    start = F.pmod(F.xxhash64("text"), room.cast("bigint") + 1).cast("int") + 1
    excerpt = F.substring("text", start, F.lit(SAMPLE_CHARS))
    # The drawn ids are SAMPLE_ROWS in number, give or take chance.
    found = docs.filter(F.col("text").isNotNull()).join(F.broadcast(drawn), "doc_id")
    return sorted(map(tuple, found.select("quality", excerpt.alias("t")).distinct().collect()))


def fit(sample: list[tuple[int, str]]) -> tuple[WordVectors, Network] | None:
    """None if the sample lacks one of the labels."""
    y = np.array([q for q, _ in sample], dtype=np.float64)
    if len(set(y.tolist())) < 2:
        return None
    words = WordVectors([t for _, t in sample])
    order = np.random.default_rng(SEED).permutation(len(y))
    x = np.array([words.pooled(t) for _, t in sample])
    return words, train(x[order], y[order])


def with_quality(docs: DataFrame, model, fallback: float) -> DataFrame:
    """Add ``score``, the probability of label 1, from the whole text."""

    def of_batches(batches):
        for texts in batches:
            if model is None:
                yield pa.array([fallback] * len(texts), pa.float64())
                continue
            words, net = model
            pooled = [words.pooled(t.as_py() or "") for t in texts]
            x = np.array(pooled, dtype=np.float64).reshape(len(pooled), DIMENSIONS)
            yield pa.array(net.probability(x), pa.float64())

    of_batches.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn("score", F.arrow_udf(of_batches, "double")(F.col("text")))


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Quality of every text, learned from the labels of documents that are not held out.

    A null or empty text has no tokens and gets the network's score of the zero vector. Without labels of
    both kinds every text gets the share of label 1, or 0.5 if there is none. Repeated rows get equal scores. Only
    doc_id and text of the documents, doc_id and quality of the labels are looked at.
    """
    docs = docs.select("doc_id", "text")
    sample = labelled_rows(docs, labels.select("doc_id", "quality"))
    fallback = sum(q for q, _ in sample) / len(sample) if sample else 0.5
    told = with_quality(docs.withColumn("held_out", is_held_out()), fit(sample), fallback)
    return told.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
