"""Approximate nearest neighbours by learned partitions (operator 4).

The neighbour graph of a bounded sample is cut into balanced parts: centres are
grown by capacity-bound assignment and refined by moving vectors to the part
that most of their neighbours are in, while parts stay within their capacity. A
softmax classifier learns the parts of a vector's neighbourhood. It files every row of the table
under its most probable part and sends a query to several; their rows are
ranked by exact inner products in double precision.

Only the classifier is sent to the tasks; its size is bounded by ``PARTS`` and
the dimension. Parts are dealt in blocks of ``BLOCK`` rows, so a part that holds
a third of all rows is many tasks; each block returns at most k rows a query.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part, as query or candidate; so do those whose length is not
the most common one of the sample; ties go to the smaller id; equal vectors are
neighbours of each other, with equal scores; of rows that repeat an id the one
with the smallest vector counts; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from telepulse.llm.tables import bound_batches, saved

SAMPLE = 8192  # vectors that the partition is learned on
PARTS = 32
PROBES = 22
GRAPH = 16
BLOCK = 8192
QUERY_BLOCK = 1024


def balanced_parts(vectors: np.ndarray, parts: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """For each vector of the sample, how much of it and its neighbours each part holds.

    The parts have few graph edges between them, none is over its capacity.
    """
    rng = np.random.default_rng(seed)
    n = len(vectors)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = np.empty((n, min(GRAPH, n - 1)), np.int64)
    for at in range(0, n, 1024):
        scores = unit[at : at + 1024] @ unit.T
        scores[np.arange(len(scores)), np.arange(at, at + len(scores))] = -np.inf
        near[at : at + 1024] = np.argpartition(-scores, near.shape[1] - 1, axis=1)[:, : near.shape[1]]
    capacity = int(np.ceil(1.1 * n / parts))
    centres = unit[rng.choice(n, parts, replace=False)]
    part = np.zeros(n, np.int64)
    for _ in range(8):
        liking = unit @ centres.T
        part = _assign(liking, capacity)
        centres = np.stack([unit[part == p].sum(axis=0) for p in range(parts)])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    both = np.concatenate([np.repeat(np.arange(n), near.shape[1]), near.ravel()])
    ends = np.concatenate([near.ravel(), np.repeat(np.arange(n), near.shape[1])])
    for _ in range(rounds):
        votes = np.zeros((n, parts))
        np.add.at(votes, (both, part[ends]), 1.0)
        moved = _assign(votes + 0.5 * (unit @ centres.T), capacity)
        if np.array_equal(moved, part):
            break
        part = moved
    own = np.eye(parts)[part]
    return (own[near].sum(axis=1) + own) / (near.shape[1] + 1)


def _assign(liking: np.ndarray, capacity: int) -> np.ndarray:
    """The part each likes most, the surest first; a full part sends the rest to their next choice."""
    n, parts = liking.shape
    order = np.argsort(-liking, axis=1, kind="stable")
    sure = np.sort(liking, axis=1)
    part, free = np.full(n, -1), np.full(parts, capacity)
    for row in np.argsort(-(sure[:, -1] - sure[:, -2 if parts > 1 else -1]), kind="stable"):
        for p in order[row]:
            if free[p]:
                part[row], free[p] = p, free[p] - 1
                break
    return part


def classifier(vectors: np.ndarray, wanted: np.ndarray, steps: int = 400, rate: float = 0.5) -> np.ndarray:
    """Weights of a softmax over parts fitted to the wanted shares, last row the bias."""
    parts = wanted.shape[1]
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    x = np.concatenate([unit, np.ones((len(unit), 1))], axis=1)
    weights, speed = np.zeros((x.shape[1], parts)), np.zeros((x.shape[1], parts))
    for _ in range(steps):
        scores = x @ weights * 8
        chance = np.exp(scores - scores.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        speed = 0.9 * speed - rate * (x.T @ (chance - wanted) / len(x) * 8 + 1e-5 * weights)
        weights += speed
    return weights


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, size)


def nearest(
    table: DataFrame,
    k: int = 20,
    every: int = 20,
    parts: int = PARTS,
    probes: int = PROBES,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The k rows of largest inner product found for each row whose id is divisible by ``every``: query_id, rank, vec_id, score."""
    spark = table.sparkSession
    bound_batches(spark)
    out = "query_id bigint, rank int, vec_id bigint, score double"
    vector = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("vector"))).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()  # bounded by SAMPLE
    if not sample:
        return spark.createDataFrame([], out)
    size = Counter(len(r.vector) for r in sample).most_common(1)[0][0]
    rows = rows.where(F.size("vector") == size)
    learned = np.unique(np.array([r.vector for r in sample if len(r.vector) == size]), axis=0)
    parts = max(1, min(parts, len(learned) // 8))
    weights = classifier(learned, balanced_parts(learned, parts)) if parts > 1 else np.zeros((size + 1, 1))
    probes = min(probes, parts)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("vector"), size)
                scores = x / np.linalg.norm(x, axis=1, keepdims=True) @ weights[:-1] + weights[-1]
                best = np.argsort(-scores, axis=1, kind="stable")[:, :probes].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(list(best), pa.list_(pa.int32()))], names=["vec_id", "vector", "parts"]
                )

    routed = saved(rows.mapInArrow(route, "vec_id bigint, vector array<double>, parts array<int>"), "partition-routed")
    filed = routed.select("vec_id", "vector", F.col("parts")[0].alias("part"))
    # a row a part: how many blocks its candidates and its queries need
    queries = routed.where(F.col("vec_id") % every == 0).select("vec_id", "vector", F.explode("parts").alias("part"))
    blocks = {r.part: -(-r["count"] // BLOCK) for r in filed.groupBy("part").count().collect()}
    asked = {r.part: -(-r["count"] // QUERY_BLOCK) for r in queries.groupBy("part").count().collect()}
    of = lambda counts: F.coalesce(
        F.create_map(*(F.lit(int(x)) for pair in counts.items() for x in pair))[F.col("part")], F.lit(0)
    ) if counts else F.lit(0)
    hashed = lambda n: F.pmod(F.xxhash64("vec_id"), n).cast("int")
    none = F.expr("cast(array() as array<int>)")
    steps = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(none)
    candidates = filed.withColumn("c", hashed(of(blocks))).withColumn("q", F.explode(steps(of(asked)))).withColumn("side", F.lit(0))
    asking = queries.withColumn("q", hashed(of(asked))).withColumn("c", F.explode(steps(of(blocks)))).withColumn("side", F.lit(1))
    dealt = candidates.select("part", "c", "q", "side", "vec_id", "vector").union(
        asking.select("part", "c", "q", "side", "vec_id", "vector")
    )

    def rank(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids, side = group.column("vec_id").to_numpy(), group.column("side").to_numpy()
        x = _matrix(group.column("vector").combine_chunks(), size)
        mine, there = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
        there = there[np.argsort(ids[there])]
        found = []
        for at in range(0, len(mine), 256):
            asks = mine[at : at + 256]
            scores = x[asks] @ x[there].T
            scores[ids[asks][:, None] == ids[there][None]] = -np.inf
            # what may be among the k best is scored again in one order of summation, so that equal vectors are equal
            least = np.partition(scores, -k, axis=1)[:, -k, None] if scores.shape[1] > k else -np.inf
            near = 1e-9 * np.abs(x[asks]).sum(axis=1, keepdims=True) * np.abs(x[there]).max(initial=0.0)
            row, column = np.nonzero(np.isfinite(scores) & (scores >= least - near))
            exact = (x[asks][row] * x[there][column]).sum(axis=1)
            order = np.lexsort((ids[there][column], -exact, row))
            row, column, exact = row[order], column[order], exact[order]
            first = np.searchsorted(row, row)
            keep = np.arange(len(row)) - first < k
            found.append((ids[asks][row[keep]], ids[there][column[keep]], exact[keep]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] or [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table({"query_id": columns[0].astype(np.int64), "vec_id": columns[1].astype(np.int64), "score": columns[2]})

    found = dealt.groupBy("part", "c", "q").applyInArrow(rank, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
