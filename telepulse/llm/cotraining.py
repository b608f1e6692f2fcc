"""Quality by co-training (operator 10).

A text-content classifier and a page-metadata classifier are fitted on a
bounded sample of labelled documents (``views.LABELLED``). Over rounds, each
gives the other its sure decisions on the documents without a quality label,
all of them, as pseudo-labels. Views are computed once and kept as a short row
a document. A step of a fit is a pass over these rows: each task decides its
rows by the models that the round began with and returns sums, the gradients
and numbers of pseudo-labels by class and view, so nothing of a document leaves
its task. Pseudo-labels weigh together at most what the labelled sample does,
good ones at most eight times as much as bad ones. Both models are calibrated
on labelled documents that neither was fitted on, their log odds are combined
and calibrated again. All documents are scored where they lie, and only ids of
the sample and the models are sent to the tasks, both bounded.

A document is acceptable if its quality label is 1 and it is not toxic.

Defined results: a null or empty text is scored like any other; documents with
repeated ids are scored row by row; without labels of both classes, every
document scores 1 and is kept; null labels don't count, contradictory labels
count as not acceptable; an empty table gives no rows; extra columns pass
through ``keep_good`` and are ignored by ``score_quality``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from telepulse.llm.tables import bound_batches, saved, slices
from telepulse.llm.views import (
    LABELLED,
    Softmax,
    chosen_words,
    labelled_sample,
    page_view,
    text_view,
    with_defaults,
)

ROUNDS, STEPS, SURE = 4, 3, 0.98  # rounds, steps of a fit in each, least probability of a pseudo-label
RATIO = 8.0  # most weight of good pseudo-labels, in that of bad ones


def _odds(model: Softmax, x: np.ndarray) -> np.ndarray:
    s = model.scores(x)
    return s[:, 1] - s[:, 0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Line:
    """Calibration of log odds by a line (Platt), fitted by Newton steps with a weak prior on the slope."""

    def fit(self, odds: np.ndarray, y: np.ndarray) -> Line:
        a = np.array([1.0, 0.0])
        x = np.stack([odds, np.ones(len(odds))], axis=1)
        for _ in range(30):
            p = _sigmoid(x @ a)
            slope = x.T @ (p - y) + 0.1 * (a - [1.0, 0.0])
            bend = (x.T * np.maximum(p * (1 - p), 1e-6)) @ x + 0.1 * np.eye(2)
            a = a - np.clip(np.linalg.solve(bend, slope), -1, 1)
        self.slope, self.shift = max(a[0], 1e-3), a[1]
        return self

    def __call__(self, odds: np.ndarray) -> np.ndarray:
        return self.slope * odds + self.shift


class Sums:
    """Of the documents without labels: their number, and by receiving view and class, the number of pseudo-labels and
    the gradients of the log loss."""

    def __init__(self, widths: list[int]):
        self.rows, self.counts, self.slopes = 0, np.zeros((2, 2), np.int64), [np.zeros((2, w)) for w in widths]

    def add(self, views, giving: CoTrained, fitted: list[Softmax]) -> None:
        self.rows += len(views[0])
        sure = [_sigmoid(line(_odds(m, v))) for m, line, v in zip(giving.models, giving.lines, views, strict=True)]
        for k in (0, 1):
            p = sure[1 - k]
            for y, rows in ((0, np.flatnonzero(p <= 1 - SURE)), (1, np.flatnonzero(p >= SURE))):
                if len(rows):
                    self.counts[k, y] += len(rows)
                    self.slopes[k][y] += fitted[k].slope(views[k][rows], np.full(len(rows), y))

    def to_bytes(self) -> bytes:
        return np.concatenate([[self.rows], self.counts.ravel(), *(s.ravel() for s in self.slopes)]).astype(np.float64).tobytes()


class CoTrained:
    """Both models, their calibrations and the combination."""

    def __init__(self, chosen: dict[str, int]):
        self.chosen = chosen

    def fit(self, views: tuple[np.ndarray, np.ndarray], y: np.ndarray, sums) -> CoTrained:
        """``sums(giving, fitted)`` has rows, counts and slopes, as Sums, over all documents without labels."""
        check = np.arange(len(y)) % 4 == 3  # rows come in hashed order
        known = [(v[~check], y[~check]) for v in views]
        size = len(known[0][1])
        self.models = [Softmax(2).fit(*k) for k in known]
        self.lines = [Line().fit(_odds(m, v[check]), y[check]) for m, v in zip(self.models, views, strict=True)]
        for _ in range(ROUNDS):
            fitted = [m.copy() for m in self.models]
            for _ in range(STEPS):
                self.seen, self.given, slopes = sums(self, fitted)
                if not self.given.any():
                    break
                for k, model in enumerate(fitted):
                    bad, good = (float(n) for n in self.given[k])
                    weight = np.array([1.0, min(1.0, RATIO * max(1.0, bad) / max(1.0, good))])
                    weight *= min(1.0, size / max(1.0, weight @ self.given[k]))
                    model.newton(*known[k], weight @ slopes[k], weight @ self.given[k])
            if not self.given.any():
                break
            self.models = fitted
            self.lines = [Line().fit(_odds(m, v[check]), y[check]) for m, v in zip(self.models, views, strict=True)]
        mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        self.prior = np.log(mean / (1 - mean))
        self.last = Line().fit(self._sum([v[check] for v in views]), y[check])
        return self

    def _sum(self, views) -> np.ndarray:
        return sum(line(_odds(m, v)) for m, line, v in zip(self.models, self.lines, views, strict=True)) - self.prior

    def probability(self, views) -> np.ndarray:
        return _sigmoid(self.last(self._sum(views)))


def _features(rows: DataFrame, chosen: dict[str, int]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, langs, sources = (batch.column(c).to_pylist() for c in ("text", "lang", "source"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("y"),
                    pa.array([text_view(t, chosen).tobytes() for t in texts], pa.binary()),
                    pa.array([page_view(*x).tobytes() for x in zip(texts, langs, sources, strict=True)], pa.binary()),
                ],
                names=["doc_id", "y", "words", "page"],
            )

    return rows.mapInArrow(run, "doc_id bigint, y int, words binary, page binary")


def acceptable(labels: DataFrame):
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) if "toxic" in labels.columns else F.lit(0)
    return F.when(F.col("quality").isNotNull(), ((F.col("quality") == 1) & (toxic == 0)).cast("int"))


def _unlabelled(docs: DataFrame, labels: DataFrame, chosen: dict[str, int]) -> DataFrame:
    """words and page, the views of every document without a quality label; those of the words as bits and six numbers."""
    n = len(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                full = np.frombuffer(b"".join(batch.column("words").to_pylist()), np.float32).reshape(batch.num_rows, -1)
                bits, rest = np.packbits(full[:, :n] > 0, axis=1), np.ascontiguousarray(full[:, n:])
                words = [a.tobytes() + b.tobytes() for a, b in zip(bits, rest, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(words, pa.binary()), batch.column("page")], names=["doc_id", "words", "page"]
                )

    rows = _features(with_defaults(docs).withColumn("y", F.lit(None).cast("int")), chosen)
    rows = saved(rows.mapInArrow(run, "doc_id bigint, words binary, page binary"), "cotraining-views")
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"))
    # rows without an id match none, and are dealt by their contents
    salt = F.when(F.col("doc_id").isNull(), F.xxhash64("words", "page")).otherwise(F.lit(0).cast("long"))
    left = rows.withColumn("salt", salt).join(known.withColumn("salt", F.lit(0).cast("long")), ["doc_id", "salt"], "left_anti")
    return saved(left.select("words", "page"), "cotraining-unlabelled")


def _sums(rows: DataFrame, chosen: dict[str, int], widths: list[int]):
    """A function as ``CoTrained.fit`` takes it: one pass over ``rows``, which returns one row of sums a task."""
    n, packed = len(chosen), (len(chosen) + 7) // 8

    def over(giving: CoTrained, fitted: list[Softmax]):
        sender = CoTrained({})
        sender.models, sender.lines = giving.models, giving.lines

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = Sums(widths)
            for whole in batches:
                for at in range(0, whole.num_rows, 2048):
                    batch = whole.slice(at, 2048)
                    raw = np.frombuffer(b"".join(batch.column("words").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                    bits = np.unpackbits(np.ascontiguousarray(raw[:, :packed]), axis=1)[:, :n].astype(np.float32)
                    rest = np.ascontiguousarray(raw[:, packed:]).view(np.float32)
                    page = np.frombuffer(b"".join(batch.column("page").to_pylist()), np.float32).reshape(batch.num_rows, -1)
                    total.add((np.concatenate([bits, rest], axis=1), page), sender, fitted)
            yield pa.RecordBatch.from_arrays([pa.array([total.to_bytes()], pa.binary())], names=["sums"])

        parts = [np.frombuffer(r.sums, np.float64) for r in rows.mapInArrow(run, "sums binary").collect()]  # one of some KB a task
        found = sum(parts, np.zeros(5 + 2 * sum(widths)))
        cut = 5 + 2 * widths[0]
        return int(found[0]), found[1:5].reshape(2, 2), (found[5:cut].reshape(2, -1), found[cut:].reshape(2, -1))

    return over


def train(docs: DataFrame, labels: DataFrame) -> CoTrained | None:
    """The models, or None where the labels don't have both classes."""
    bound_batches(docs.sparkSession)
    sample = saved(labelled_sample(docs, labels, acceptable(labels), LABELLED), "cotraining-sample")
    chosen = chosen_words(sample)
    marked = _features(sample, chosen).orderBy(F.xxhash64("doc_id"), "doc_id").collect()  # bounded by LABELLED
    stacked = lambda rows, c, width: np.array([np.frombuffer(r[c], np.float32) for r in rows]).reshape(len(rows), width)
    widths = [len(text_view("", chosen)), len(page_view("", None, None))]
    y = np.array([r.y for r in marked], int)
    if len(marked) < 8 or len(set(y)) < 2:
        return None
    views = tuple(stacked(marked, c, w) for c, w in zip(("words", "page"), widths, strict=True))
    columns = [w + 1 for w in widths]  # with the constant
    return CoTrained(chosen).fit(views, y, _sums(_unlabelled(docs, labels, chosen), chosen, columns))


def _scored(docs: DataFrame, model: CoTrained | None, out: str) -> DataFrame:
    """``docs`` with its columns and the probability ``out``."""
    have = set(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            extra = [batch.column(c).to_pylist() if c in have else [None] * len(texts) for c in ("lang", "source")]
            if model is None:
                p = np.ones(len(texts))
            else:
                page = np.array([page_view(*x) for x in zip(texts, *extra, strict=True)])
                p = model.probability([np.array([text_view(t, model.chosen) for t in texts]), page])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*batch.schema.names, out])

    schema = StructType([*docs.schema.fields, StructField(out, DoubleType())])
    return docs.mapInArrow(run, schema)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, score (probability of being acceptable) and kept of every document."""
    scored = _scored(with_defaults(docs), train(docs, labels), "score")
    return scored.select("doc_id", "score", (F.col("score") >= threshold).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of acceptable documents, with the same columns."""
    model = train(docs, labels)
    score = "__quality_score"
    typed = docs.withColumn("text", F.col("text").cast("string"))
    return _scored(typed, model, score).where(F.col(score) >= threshold).select(*(F.col(f"`{c}`") for c in docs.columns))
