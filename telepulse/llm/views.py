"""Two views of a document, for classifiers that are fitted on bounded samples of labelled rows.

The text view says which of the chosen words a text holds, and how it is
written. The page view sees what is known of a page without reading it: its
language, source, length, lines and how far it can be compressed.
"""

from __future__ import annotations

import functools
import math
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELLED, WORDS = 6000, 512  # bounds of the sample and of the words chosen
SLOTS = 32


def split_words(text: str) -> list[str]:
    return text.lower().split()


def text_view(text: str, chosen: dict[str, int]) -> np.ndarray:
    words = split_words(text)
    out = np.zeros(len(chosen) + 6, np.float32)
    different = set(words)
    for word in chosen.keys() & different:
        out[chosen[word]] = 1
    n = max(1, len(words))
    repeats = sum(map(str.__eq__, words, words[1:]))
    letters = sum(map(str.isalpha, different))
    out[len(chosen) :] = (
        repeats / n,
        len(different) / n,
        letters / max(1, len(different)),
        text.count("!") / n,
        text.count("|") / n,
        min(1.0, n / 20),
    )
    return out


@functools.cache
def _lowered() -> np.ndarray:
    """For every code point, whether lower() changes it."""
    return np.fromiter((chr(c).lower() != chr(c) for c in range(0x110000)), bool, 0x110000)


def upper_share(text: str) -> float:
    """Share of upper-case characters in the whole text, read in pieces."""
    count = 0
    for at in range(0, len(text), 1 << 20):
        piece = text[at : at + (1 << 20)]
        if piece.isascii():
            codes = np.frombuffer(piece.encode(), np.uint8)
            count += np.count_nonzero((codes >= 65) & (codes <= 90))
        else:
            count += np.count_nonzero(_lowered()[np.frombuffer(piece.encode("utf-32-le"), np.uint32)])
    return count / max(1, len(text))


def page_view(text: str, lang: str | None, source: str | None) -> np.ndarray:
    size = max(1, len(text))
    data = text.encode()
    packed = len(zlib.compress(data, 1)) / max(1, len(data))
    lines = text.count("\n") + 1
    out = np.zeros(2 * SLOTS + 6, np.float32)
    out[zlib.crc32((lang or "").encode()) % SLOTS] = 1
    out[SLOTS + zlib.crc32((source or "").encode()) % SLOTS] = 1
    out[2 * SLOTS :] = (
        math.log1p(len(text)) / 10,
        math.log1p(lines) / 10,
        math.log1p(size / lines) / 10,
        min(packed, 1.5),
        upper_share(text),
        text.count(" ") / size,
    )
    return out


def with_defaults(docs: DataFrame) -> DataFrame:
    """doc_id, text, lang, source as the views read them; columns that are not there are null."""
    have = set(docs.columns)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *((F.col(c) if c in have else F.lit(None)).cast("string").alias(c) for c in ("lang", "source")),
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, value, bound: int) -> DataFrame:
    """At most ``bound`` rows with a label: the views' columns and ``y``. Only their ids, so bounded, are broadcast.

    Of rows that repeat an id the smallest counts, by text, language and source.
    """
    ids = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), value.alias("y"))
        .where("doc_id IS NOT NULL AND y IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    rows = with_defaults(docs).join(F.broadcast(ids), "doc_id").groupBy("doc_id")
    one = rows.agg(F.min(F.struct("text", "lang", "source")).alias("row"), F.min("y").alias("y"))
    return one.select("doc_id", "row.*", "y")


def chosen_words(sample: DataFrame, bound: int = WORDS) -> dict[str, int]:
    """Words of the sample whose presence tells classes apart, at most ``bound``, with their columns.

    Per class, z is the excess of a word's documents over what its share of the whole sample would give.
    """
    spread = sample.select("doc_id", "y", F.explode(F.array_distinct(F.split(F.lower("text"), r"\s+"))).alias("word"))
    sizes = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    total = sum(sizes.values())
    if len(sizes) < 2:
        return {}
    counts = spread.where("word <> ''").groupBy("word").agg(
        F.count("*").alias("n"), *(F.count(F.when(F.col("y") == y, 1)).alias(f"n_{y}") for y in sizes)
    )
    z = [
        F.abs(F.col(f"n_{y}") - F.col("n") * (size / total)) / F.sqrt(F.col("n") * (size / total) * (1 - size / total) + 0.5)
        for y, size in sizes.items()
    ]
    best = F.greatest(*z)
    found = counts.where("n >= 8").select("word", best.alias("z")).where("z > 4").orderBy(F.desc("z"), "word").limit(bound).collect()
    return {r.word: k for k, r in enumerate(found)}


class Softmax:
    """Multinomial logistic regression on standardised columns, weighted so that classes count alike up to a power."""

    def __init__(self, classes: int, penalty: float = 1e-3):
        self.classes, self.penalty = classes, penalty

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 300, rate: float = 0.3) -> Softmax:
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 0.05)
        z = self._columns(x)
        wanted = np.eye(self.classes)[y]
        w = np.zeros((z.shape[1], self.classes))
        first, second = np.zeros_like(w), np.zeros_like(w)
        for step in range(1, steps + 1):
            p = softmax(z @ w)
            slope = z.T @ (p - wanted) / len(z) + self.penalty * w
            first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
            w -= rate * 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        self.weights = w
        return self

    def _columns(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def copy(self) -> Softmax:
        """The same model, to be fitted on; of two classes."""
        out = Softmax(self.classes, self.penalty)
        out.mean, out.scale, out.weights = self.mean, self.scale, self.weights.copy()
        return out

    def slope(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Gradient of the log loss, summed over rows, in the weights of the log odds of two classes."""
        z = self._columns(x)
        return z.T @ (softmax(z @ self.weights)[:, 1] - y)

    def newton(self, x: np.ndarray, y: np.ndarray, slope: np.ndarray, weight: float) -> None:
        """One step on rows and on the gradient ``slope`` of others that weigh ``weight``; these rows give the curvature."""
        z = self._columns(x)
        p = softmax(z @ self.weights)[:, 1]
        odds = self.weights[:, 1] - self.weights[:, 0]
        total = len(z) + weight
        bend = (z.T * np.maximum(p * (1 - p), 0.05)) @ z / len(z) + self.penalty / 2 * np.eye(len(odds))
        step = np.linalg.solve(bend, (z.T @ (p - y) + slope) / total + self.penalty / 2 * odds)
        self.weights = np.stack([step - odds, odds - step], axis=1) / 2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self._columns(x) @ self.weights


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)
