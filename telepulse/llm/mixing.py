"""Mixing documents to target weights by soft domain membership (operator 7).

A classifier fitted on a bounded sample of labelled documents predicts how much
of a document belongs to each domain: ``clean``, ``poor`` and ``toxic``, from
its quality and toxicity labels. ``mixed_languages`` does the same for the
languages that documents are marked with. Rates of documents, not below ``least`` (nor above ``most``, if given),
are the least-squares solution of: the expected tokens of each domain, each
document's tokens counted by rate and posterior, are the target shares of the
total. Where rates have a least value, the total grows until every target share
can be reached by raising the others. Projected gradient starts at rate 1; its steps are scaled by a document's
tokens and a domain's mass, so the step length is known and few steps are
needed. Each step is one aggregate of a number per domain; a document's rate is
a fold over these numbers, so nothing is kept per document between steps and a
lost executor costs a rescan of a table of one short row per document. The
shares that the rates reach are returned with them.

Defined results: a null or empty text has no tokens and rate as its posterior
gives; repeated ids are rated row by row; without labels, or with one domain
only, every rate is 1 (or the nearest bound); a domain without mass is left
out; an empty table gives no rows; extra columns pass through ``mixed`` and are
ignored by ``mixing_rates``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from telepulse.llm.tables import bound_batches, saved, slices
from telepulse.llm.views import LABELLED, Softmax, chosen_words, labelled_sample, softmax, split_words, text_view

DOMAINS = ("clean", "poor", "toxic")
TARGETS = {"clean": 0.92, "poor": 0.05, "toxic": 0.03}
LEAST, MOST = 0.0, math.inf  # rates are bounded above only where a caller asks for it
LANGUAGES, FEWEST, FLATTENED = 32, 8, 0.7  # most languages that are domains, their least documents, power of their shares
STEPS, NEAR, STILL = 40, 1e-3, 5e-5  # most steps; as shares of all tokens, the miss and its change that end them


def domain_of(labels: DataFrame) -> Column:
    """0 clean, 1 poor, 2 toxic; null without labels."""
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) if "toxic" in labels.columns else F.lit(0)
    return F.when(toxic == 1, 2).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 0)


class Membership:
    """Posteriors of the domains from the text view."""

    def __init__(self, chosen: dict[str, int], model: Softmax | None, domains: int = len(DOMAINS)):
        self.chosen, self.model, self.domains = chosen, model, domains

    def posteriors(self, texts: list[str]) -> np.ndarray:
        if self.model is None:
            return np.tile(np.eye(self.domains)[0], (len(texts), 1))
        return softmax(self.model.scores(np.array([text_view(t, self.chosen) for t in texts])))


def train(docs: DataFrame, labels: DataFrame, domain: Column | None = None, domains: int = len(DOMAINS)) -> Membership:
    bound_batches(docs.sparkSession)
    sample = saved(labelled_sample(docs, labels, domain_of(labels) if domain is None else domain, LABELLED), "mixing-sample")
    chosen = chosen_words(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            views = [text_view(t, chosen).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.array(views, pa.binary())], names=["doc_id", "y", "view"]
            )

    rows = sample.mapInArrow(run, "doc_id bigint, y int, view binary").orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    y = np.array([r.y for r in rows], int)
    if len(set(y)) < 2:
        return Membership({}, None, domains)
    x = np.array([np.frombuffer(r.view, np.float32) for r in rows])
    return Membership(chosen, Softmax(domains).fit(x, y), domains)


def with_membership(docs: DataFrame, member: Membership, share: str, tokens: str) -> DataFrame:
    """``docs`` with the posteriors and the number of words of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            p = pa.array(list(member.posteriors(texts)), pa.list_(pa.float64()))
            n = pa.array([len(split_words(t)) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, p, n], names=[*batch.schema.names, share, tokens])

    extra = [StructField(share, ArrayType(DoubleType())), StructField(tokens, LongType())]
    typed = docs.withColumn("text", F.col("text").cast("string"))
    return typed.mapInArrow(run, StructType([*typed.schema.fields, *extra]))


def _rate(share: Column, steps: list[list[float]], least: float, most: float) -> Column:
    """The rate after steps, each a number per domain: what one unit of membership lowers it by."""
    start = F.lit(float(min(max(1.0, least), most)))
    if not steps:
        return start
    moves = F.array(*(F.array(*map(F.lit, s)) for s in steps))

    def step(rate: Column, move: Column) -> Column:
        down = sum((share[k] * move[k] for k in range(1, len(steps[0]))), share[0] * move[0])
        return F.least(F.greatest(rate - down, F.lit(float(least))), F.lit(float(most)))

    return F.aggregate(moves, start, step)


Targets = dict[str, float] | Callable[[np.ndarray], np.ndarray]


def flattened(mass: np.ndarray, most: float = MOST) -> np.ndarray:
    """Target shares from tokens of domains: their power, as far as no domain is raised more than ``most`` times."""
    return mass * np.minimum((mass.max() / np.maximum(mass, 1e-300)) ** (1 - FLATTENED), most)


def fit_rates(
    table: DataFrame, targets: Targets, least: float, most: float, domains: tuple[str, ...] = DOMAINS
) -> list[list[float]]:
    """Steps of the projected gradient on a table of share (posteriors) and tokens."""
    k = range(len(domains))
    share, tokens = F.col("share"), F.col("tokens").cast("double")
    products = [F.sum(tokens * share[a] * share[b]) for a in k for b in k]
    first = table.agg(F.sum(tokens), *(F.sum(tokens * share[a]) for a in k), *products).first()
    total = first[0] or 0.0
    mass = np.array([x or 0.0 for x in first[1 : 1 + len(domains)]])
    if total <= 0:
        return []
    alive = mass > 1e-9 * total
    wanted = np.where(alive, targets(mass) if callable(targets) else [targets.get(d, 0.0) for d in domains], 0.0)
    if wanted.sum() <= 0:
        return []
    wanted = wanted / wanted.sum() * total
    wanted *= max(1.0, (least * mass[wanted > 0] / wanted[wanted > 0]).max())
    weight = np.where(alive, 1 / np.maximum(mass, 1e-300), 0.0)
    gram = np.array(first[1 + len(domains) :]).reshape(len(domains), -1)
    length = 1 / np.linalg.eigvalsh(np.sqrt(weight)[:, None] * gram * np.sqrt(weight)).max()
    steps: list[list[float]] = []
    last = np.full(len(domains), np.inf)
    for _ in range(STEPS):
        rate = _rate(share, steps, least, most)
        now = table.select(rate.alias("rate"), "share", tokens.alias("tokens")).agg(
            *(F.sum(F.col("rate") * F.col("tokens") * share[a]) for a in k)
        )
        miss = np.array(now.first()) - wanted
        if np.abs(np.where(alive, miss, 0)).max() <= NEAR * total or np.abs(miss - last).max() <= STILL * total:
            break
        last = miss
        steps.append((length * weight * miss).tolist())
    return steps


def mixing_rates(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, least: float = LEAST, most: float = MOST
) -> DataFrame:
    """doc_id, n_tokens, a posterior per domain and the rate of every document; and, alike in every row, the share of all
    rated tokens that each domain reaches."""
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    member = train(docs, labels)
    found = with_membership(columns, member, "share", "tokens")
    table = saved(found.select("doc_id", "share", "tokens"), "mixing-members")
    steps = fit_rates(table, targets or TARGETS, least, most)
    rated = F.col("tokens") * _rate(F.col("share"), steps, least, most)
    sums = table.agg(F.sum(rated), *(F.sum(rated * F.col("share")[k]) for k in range(len(DOMAINS)))).first()
    reached = [(x or 0.0) / sums[0] if sums[0] else None for x in sums[1:]]
    return table.select(
        "doc_id",
        F.col("tokens").alias("n_tokens"),
        *(F.col("share")[k].alias(f"p_{d}") for k, d in enumerate(DOMAINS)),
        _rate(F.col("share"), steps, least, most).alias("rate"),
        *(F.lit(share).cast("double").alias(f"reached_{d}") for share, d in zip(reached, DOMAINS, strict=True)),
    )


def mixed(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, least: float = 1.0, most: float = MOST
) -> DataFrame:
    """The rows repeated by their rates, with the same columns.

    A rate of 2.3 gives two copies, and a third to documents whose id hashes below 0.3. With ``least`` 1, the
    default here, domains are raised and no document is lost; targets are met as far as that allows.
    """
    return _repeated(docs, train(docs, labels), targets or TARGETS, least, most, DOMAINS)


def mixed_languages(docs: DataFrame, least: float = 1.0, most: float = MOST) -> DataFrame:
    """The rows repeated so that the shares of languages come to a flattened form of what they are, with the same columns.

    The domains are the most frequent languages that documents are marked with; documents in others, or without a
    mark, belong to these as their words say.
    """
    marked = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL")
    found = marked.groupBy("lang").count().where(F.col("count") >= FEWEST).orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    languages = tuple(r.lang for r in found)
    if len(languages) < 2:
        return docs
    domain = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")).cast("int") - 1
    member = train(docs, marked, F.when(domain >= 0, domain), len(languages))
    return _repeated(docs, member, lambda mass: flattened(mass, most), least, most, languages)


def _repeated(
    docs: DataFrame, member: Membership, targets: Targets, least: float, most: float, domains: tuple[str, ...]
) -> DataFrame:
    share, tokens = "__mixing_share", "__mixing_tokens"
    rows = saved(with_membership(docs, member, share, tokens), "mixing-rows")
    steps = fit_rates(rows.select(F.col(share).alias("share"), F.col(tokens).alias("tokens")), targets, least, most, domains)
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    copies = F.floor(_rate(F.col(share), steps, least, most) + chance).cast("int")
    times = F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.expr("cast(array() as array<int>)"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return rows.select(*columns, F.explode(times).alias("__mixing_copy")).select(*columns)
