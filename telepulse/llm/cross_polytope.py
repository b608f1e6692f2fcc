"""Near-duplicate vectors by cross-polytope hashing (operator 11).

A vector is rotated by random signs and fast Hadamard transforms; the axis it
then lies nearest to, with its sign, is one hash. A bucket is a label, a table
and a few such hashes. Each vector lives in one bucket a table and also visits
the next likeliest ones (multiprobe), so a pair is a candidate where one lives
in a bucket that the other lives in or visits.

1. Equal vectors of a label are one node with a number of copies.
2. Each node of a shared bucket goes home to the smallest node it shares one
   with, if that is near (cosine 0.9), or else to itself. Nodes that lie within
   half the limit's angle of their home's node are its core: any two of a core
   are linked by the triangle inequality, so its links are counted and never
   compared.
3. Buckets name the pairs of homes that meet, each pair once. Homes are cut into
   blocks of ``BLOCK`` nodes; each pair of blocks is one group, which compares
   all their vectors in double precision. It returns a sum and one link a node,
   not pairs.

The number of hashes a bucket grows with the logarithm of the number of nodes,
so that buckets of unlike vectors stay rare. A pair at a cosine of 0.98 shares
no bucket with a probability of 0.08 to 0.18 a table (simulated; 64 dimensions,
two and three hashes), so of eight tables with one to nine in 10 million; no
pair below the limit is linked. What two homes meet in one bucket is a pair of
homes, not of vectors. Comparing a group of m distinct near copies whose cores
are small is still m * m inner products, in blocks.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and those with a null label, link with nothing and are components
of their own; so do vectors of unequal length with each other. Of rows that
repeat an id one counts (the smallest by digest), and an id has one row in the
result. Rows with a null id link with nothing, have no component and are kept.
An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telepulse.llm.components import components
from telepulse.llm.shingles import mixed
from telepulse.llm.tables import bound_batches, saved

TABLES, PROBES, MOST_HASHES, CHOICES, ROTATIONS = 8, 4, 4, 3, 3
COSINE, NEAR, ROUNDING = 0.98, 0.9, 1e-9
BLOCK = 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Walsh-Hadamard transform of every row; the width is a power of two."""
    width, half = x.shape[1], 1
    while half < width:
        pairs = x.reshape(-1, width // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(-1, width)
        half *= 2
    return x / math.sqrt(width)


@functools.lru_cache(maxsize=256)
def _signs(table: int, hash_no: int, width: int) -> np.ndarray:
    return np.random.default_rng([table, hash_no, width]).choice([-1.0, 1.0], (ROTATIONS, width))


def _width(dims: int) -> int:
    """A power of two that holds the vectors; how likely near vectors meet depends on it, so it is 64 at least."""
    return max(64, 1 << (dims - 1).bit_length())


def buckets(unit: np.ndarray, table: int, hashes: int) -> np.ndarray:
    """Per row the codes of its bucket (first) and of the next likeliest ones, one column each."""
    width = _width(unit.shape[1])
    wide = np.zeros((len(unit), width))
    wide[:, : unit.shape[1]] = unit
    axes, gaps = [], []
    for h in range(hashes):
        turned = wide
        for signs in _signs(table, h, width):
            turned = hadamard(turned * signs)
        top = np.argsort(-np.abs(turned), axis=1, kind="stable")[:, :CHOICES]
        at = np.take_along_axis(turned, top, axis=1)
        axes.append(2 * top + (at > 0))
        gaps.append((np.abs(at[:, :1]) - np.abs(at)) ** 2)
    choices = np.array(list(itertools.product(range(CHOICES), repeat=hashes)))
    lost = sum(gap[:, choices[:, h]] for h, gap in enumerate(gaps))
    best = choices[np.argsort(lost, axis=1, kind="stable")[:, :PROBES]]
    codes = np.zeros(best.shape[:2], np.uint64)
    for h, axis in enumerate(axes):
        codes = codes * np.uint64(2 * width) + np.take_along_axis(axis, best[:, :, h], axis=1).astype(np.uint64)
    return codes


def packed(vector: np.ndarray) -> bytes:
    """The components as single floats where those are exact, or else as doubles."""
    with np.errstate(over="ignore"):
        short = vector.astype("<f4")
    return short.tobytes() if np.array_equal(short.astype(np.float64), vector) else vector.astype("<f8").tobytes()


def unpacked(data: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(data, "<f4" if len(data) == 4 * dims else "<f8").astype(np.float64)


def units(vectors: list[np.ndarray]) -> np.ndarray:
    """Rows of length one. Scaling by a power of two first keeps squares finite and changes no digit."""
    x = np.stack(vectors)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def linked(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of a and b have the cosine; those at the limit are looked at again in one fixed order of summation."""
    found = a @ b.T
    hit = found >= cosine
    for i, j in np.argwhere(np.abs(found - cosine) < ROUNDING):
        hit[i, j] = math.fsum(a[i] * b[j]) >= cosine
    return hit


def _vectors(rows: DataFrame) -> DataFrame:
    """vec_id, digest (of label and vector; null where it takes no part), label, dims and packed vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for label, vector in zip(batch.column("label").to_pylist(), batch.column("vector"), strict=True):
                values = vector.values
                fine = label is not None and values is not None and len(values) > 0 and values.null_count == 0
                x = values.to_numpy(zero_copy_only=False) if fine else np.zeros(1)
                if not fine or not np.isfinite(x).all() or not x.any():
                    out.append((None, None, None))
                    continue
                data = packed(x + 0.0)  # no negative zero
                name = label.encode()
                digest = hashlib.blake2b(b"%d:%s:%d:%s" % (len(name), name, len(x), data), digest_size=16).digest()
                out.append((digest, len(x), data))
            digests, dims, data = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array(digests, pa.binary()),
                    batch.column("label").cast(pa.string()),
                    pa.array(dims, pa.int32()),
                    pa.array(data, pa.binary()),
                ],
                names=["vec_id", "digest", "label", "dims", "vector"],
            )

    return rows.mapInArrow(run, "vec_id bigint, digest binary, label string, dims int, vector binary")


def _by_dims(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and unit vectors of the rows of a batch, for each length of vectors."""
    dims = batch.column("dims").to_numpy(zero_copy_only=False)
    data = batch.column("vector").to_pylist()
    for size in np.unique(dims):
        at = np.flatnonzero(dims == size)
        yield at, units([unpacked(data[i], int(size)) for i in at])


def _keys(nodes: DataFrame, hashes: int) -> DataFrame:
    """node, key (one number a bucket) and own (it lives there) for all tables and probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            labels = {
                name: int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")
                for name in set(batch.column("label").to_pylist())
            }
            label = np.array([labels[name] for name in batch.column("label").to_pylist()], np.uint64)
            node = batch.column("node").to_numpy()
            for at, unit in _by_dims(batch):
                for table in range(TABLES):
                    codes = buckets(unit, table, hashes)
                    place = mixed(label[at] ^ mixed(np.array([unit.shape[1] * TABLES + table + 1], np.uint64)))
                    keys = mixed(codes ^ place[:, None])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(node[at], keys.shape[1])),
                            pa.array(keys.ravel().view(np.int64)),
                            pa.array(np.tile(np.arange(keys.shape[1]) == 0, len(at))),
                        ],
                        names=["node", "key", "own"],
                    )

    return nodes.select("node", "label", "dims", "vector").mapInArrow(run, "node bigint, key bigint, own boolean")


def _homes(pairs: DataFrame, cosine: float) -> DataFrame:
    """node, home, core of rows (node, pivot, label, dims, vector and the pivot's as p_label, p_dims, p_vector)."""
    core_from = math.sqrt((1 + cosine) / 2) + ROUNDING

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for r in rows:
                alike = -1.0
                if r["node"] == r["pivot"]:
                    alike = 1.0
                elif (r["label"], r["dims"]) == (r["p_label"], r["p_dims"]):
                    a, b = units([unpacked(r["vector"], r["dims"]), unpacked(r["p_vector"], r["dims"])])
                    alike = float(a @ b)
                out.append((r["pivot"], alike >= core_from) if alike >= NEAR else (r["node"], True))
            homes, cores = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(homes, pa.int64()), pa.array(cores, pa.bool_())], names=["node", "home", "core"]
            )

    return pairs.mapInArrow(run, "node bigint, home bigint, core boolean")


FOUND = "node bigint, root bigint, n bigint"


def _compare(cosine: float):
    """Of one pair of blocks: per linked node the smallest node it is joined with there, and the copies it links to."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        node, copies, side = (group.column(c).to_numpy() for c in ("node", "copies", "side"))
        kind = list(zip(group.column("label").to_pylist(), group.column("dims").to_pylist(), strict=True))
        data = group.column("vector").to_pylist()
        out: list[list[np.ndarray]] = [[], [], []]
        for key in sorted(set(kind)):
            at = np.array([i for i, k in enumerate(kind) if k == key])
            left, right = at[side[at] == 0], at[side[at] == 1]
            itself = not len(right) and bool(group.column("itself")[0].as_py())
            if itself:
                right = left
            if not len(left) or not len(right):
                continue
            a = units([unpacked(data[i], key[1]) for i in left])
            b = a if itself else units([unpacked(data[i], key[1]) for i in right])
            hit = linked(a, b, cosine)
            if itself:
                np.fill_diagonal(hit, False)
            over, under = hit @ copies[right], copies[left] @ hit
            up, down = node[left].copy(), node[right].copy()
            top = np.iinfo(np.int64).max
            while True:  # labels spread until they stay
                new_down = np.minimum(down, np.where(hit, up[:, None], top).min(axis=0))
                new_up = np.minimum(up, np.where(hit, new_down[None], top).min(axis=1))
                if np.array_equal(new_up, up) and np.array_equal(new_down, down):
                    break
                up, down = new_up, new_down
            if itself:
                up, under = np.minimum(up, down), None
            for nodes, roots, counts in ((node[left], up, over), (node[right], down, under)):
                if counts is not None:
                    keep = counts > 0
                    for column, values in zip(out, (nodes, roots, counts), strict=True):
                        column.append(values[keep].astype(np.int64))
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        return pa.table({"node": columns[0], "root": columns[1], "n": columns[2]})

    return run


def near_vectors(
    table: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding"
) -> DataFrame:
    """Per id: n_links (other vectors linked directly), component_id (the smallest id that is reachable over links), kept."""
    bound_batches(table.sparkSession)
    rows = table.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    vectors = saved(_vectors(rows), "vectors")
    ids = vectors.where("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min("digest").alias("digest"))
    ids = saved(ids, "vector-ids")
    classes = saved(
        ids.where("digest IS NOT NULL").groupBy("digest").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")),
        "vector-classes",
    )
    chosen = classes.withColumnRenamed("node", "vec_id")
    nodes = saved(
        vectors.join(chosen, ["vec_id", "digest"])
        .select(F.col("vec_id").alias("node"), "copies", "label", "dims", "vector")
        .dropDuplicates(["node"]),
        "vector-nodes",
    )
    sizes = nodes.agg(F.count("*").alias("n"), F.min("dims").alias("dims")).first()
    axes = 2 * _width(sizes.dims or 1)
    hashes = min(MOST_HASHES, max(1, math.ceil(math.log(PROBES * max(sizes.n, 1)) / math.log(axes))))

    keys = _keys(nodes, hashes)
    shared = keys.groupBy("key").agg(
        F.count("*").alias("members"), F.max("own").alias("lived_in"), F.min("node").alias("pivot")
    )
    shared = saved(shared.where("members > 1 AND lived_in").select("key", "pivot"), "vector-shared")
    members = saved(keys.join(shared, "key"), "vector-members")
    lead = members.groupBy("node").agg(F.min("pivot").alias("pivot"))
    of_pivot = nodes.select(
        F.col("node").alias("pivot"), F.col("label").alias("p_label"), F.col("dims").alias("p_dims"), F.col("vector").alias("p_vector")
    )
    homes = saved(_homes(lead.join(nodes.drop("copies"), "node").join(of_pivot, "pivot"), cosine), "vector-homes")

    # blocks of each home's core and of what lies around it
    home = ["home", "core"]
    blocks = saved(
        homes.groupBy(*home).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("n")),
        "vector-blocks",
    )
    located = saved(
        homes.join(blocks, home)
        .join(nodes, "node")
        .select(*home, F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"), "node", "copies", "label", "dims", "vector"),
        "vector-located",
    )
    met = saved(members.join(homes, "node").groupBy("key", *home).agg(F.max("own").alias("own")), "vector-met")
    side = lambda s: met.select(
        "key", F.struct(*home).alias(s), F.col("own").alias(f"own_{s}")
    )
    meeting = side("a").join(side("b"), "key").where("a < b AND (own_a OR own_b)").select("a", "b").distinct()
    alone = blocks.where("NOT core AND n > 1").select(F.struct(*home).alias("a"), F.struct(*home).alias("b"))
    count_of = lambda s: blocks.select(F.struct(*home).alias(s), F.col("blocks").alias(f"blocks_{s}"))
    steps = lambda s: F.sequence(F.lit(0), F.col(f"blocks_{s}") - 1)
    dealt = saved(
        meeting.union(alone)
        .join(count_of("a"), "a")
        .join(count_of("b"), "b")
        .withColumn("i", F.explode(steps("a")))
        .withColumn("j", F.explode(steps("b")))
        .where("a <> b OR i <= j")
        .select(
            F.struct("a", "b", "i", "j").alias("group"),
            (F.col("a").eqNullSafe(F.col("b")) & (F.col("i") == F.col("j"))).alias("itself"),
            F.array(
                F.struct(F.lit(0).alias("side"), "a.*", F.col("i").alias("block")),
                F.struct(F.lit(1).alias("side"), "b.*", F.col("j").alias("block")),
            ).alias("at"),
        )
        .select("group", "itself", F.explode("at").alias("at"))
        .where("at.side = 0 OR NOT itself")
        .select("group", "itself", "at.*"),
        "vector-dealt",
    )
    sent = dealt.join(located, [*home, "block"]).select("group", "itself", "side", "node", "copies", "label", "dims", "vector")
    found = saved(sent.groupBy("group").applyInArrow(_compare(cosine), FOUND), "vector-found")

    core = homes.where("core").join(nodes.select("node", "copies"), "node")
    whole = core.groupBy("home").agg(F.min("node").alias("root"), F.sum("copies").alias("all"))
    within = core.join(whole, "home").select("node", "root", (F.col("all") - F.col("copies")).alias("n"))
    sums = found.unionByName(within)
    linked_to = sums.groupBy("node").agg(F.sum("n").alias("n"))
    joined = sums.where("n > 0 AND node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    labels = components(homes.select("node"), joined, "vector-cc")
    of_node = saved(labels.join(linked_to, "node"), "vector-labels")

    of_class = classes.join(of_node, "node", "left").select(
        "digest", F.coalesce("label", "node").alias("component_id"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    known = ids.join(of_class, "digest", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    nameless = vectors.where("vec_id IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return known.union(nameless).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def near_vectors_sql(cosine: float = COSINE) -> str:
    """The same rows in SQL, from all pairs of a label: for small tables."""
    return f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
), u AS (
  SELECT vec_id, label, x FROM v
  WHERE label IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(x, lambda e: e <> 0)) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE CASE WHEN len(a.x) = len(b.x) THEN list_cosine_similarity(a.x, b.x) >= {cosine} ELSE false END
), reach AS (
  SELECT vec_id, vec_id AS r FROM embeddings
  UNION SELECT reach.vec_id, links.y FROM reach JOIN links ON links.x = reach.r
), least AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN n USING (vec_id)"""
