"""Near-duplicates by SetSketch registers (operator 8).

Each distinct shingle set is sketched once, whatever the number of its copies:
register i holds a floored logarithm of the smallest exponential value that the
i-th hash gives to a shingle, so sketches of parts merge by the maximum of
registers. Bands of five registers put alike sets into common buckets.

1. A bucket's members are paired with its smallest one. Pairs whose likelihood
   estimate of the Jaccard similarity lies more than four standard deviations
   below the limit go; the others are confirmed on whole sets. Links join
   components.
2. Buckets that still hold several components compare, in blocks, all members
   of different components by their registers; what may be a link is
   confirmed in the same way. Pairs within a component are never made.

So no link between different sets is lost but for those that share no band, and
those the estimate rejects: at similarity 0.85 about three in 100,000.
Sets are compared as 64-bit shingle hashes, blocks of documents with blocks, so
a set is sent once for many pairs. Nodes are 64-bit hashes of whole sets.

Defined results: a null or empty text, or one without words, has an empty set,
is linked with nothing and kept; rows with a null id belong to no component
(null) and are kept; repeated rows count as copies; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telepulse.llm.components import components
from telepulse.llm.shingles import mixed, shingle_sets
from telepulse.llm.tables import bound_batches, saved, slices, texts

REGISTERS, ROWS, BANDS = 128, 5, 25
BASE, RATE, TOP = 1.02, 20.0, (1 << 16) - 2
SIGMAS = 4.0
BLOCK = 256
SALTS = mixed(np.arange(1, REGISTERS + 1, dtype=np.uint64))
FACTORS = mixed(SALTS) | np.uint64(1)


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch of a non-empty set: per register floor(1 - log_b(smallest exponential)), truncated to 0 .. q + 1."""
    least = np.full(REGISTERS, ~np.uint64(0))
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048]
        least = np.minimum(least, ((part ^ SALTS[:, None]) * FACTORS[:, None]).min(axis=1))
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    level = np.floor(1 - np.log(np.maximum(exponential, 1e-300)) / np.log(BASE))
    return np.clip(level, 0, TOP + 1).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def estimate(above: np.ndarray, below: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Likeliest Jaccard similarity, given how many registers of A are above and below those of B, and both sizes.

    The likelihood is unimodal in the similarity, so thirds of the range are dropped until it is small.
    """
    u = n_a / (n_a + n_b)
    v = 1 - u
    same = REGISTERS - above - below
    log_base = np.log(BASE)

    def chance(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / log_base, 1e-12, 1.0)

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = chance(u - v * j), chance(v - u * j)
        return above * np.log(up) + below * np.log(down) + same * np.log(np.maximum(1 - up - down, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(24):
        third = (high - low) / 3
        left, right = low + third, high - third
        better = likelihood(left) < likelihood(right)
        low, high = np.where(better, left, low), np.where(better, high, right)
    return (low + high) / 2


def lower_bound(percent: int) -> float:
    """SIGMAS standard deviations below the limit."""
    limit = percent / 100
    return limit - SIGMAS * float(np.sqrt(limit * (1 - limit) / REGISTERS))


def hopeful(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs of sketches may reach the limit: by size, by equal registers, and by the likeliest similarity.

    Both bounds lie SIGMAS standard deviations below the limit; registers agree at least as often as sets do.
    """
    least = lower_bound(percent)
    fine = np.minimum(n_a, n_b) * 100 >= percent * np.maximum(n_a, n_b)
    at = np.flatnonzero(fine)
    fine[at] = (a[at] == b[at]).sum(axis=1) >= REGISTERS * least
    at = np.flatnonzero(fine)
    if len(at):
        a, b = a[at], b[at]
        guess = estimate((a > b).sum(axis=1) * 1.0, (a < b).sum(axis=1) * 1.0, n_a[at] * 1.0, n_b[at] * 1.0)
        fine[at] = guess >= least
    return fine


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, node (null for an empty set) and registers of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            sets = shingle_sets(texts(batch.column("text")), words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "node", "registers"],
            )

    return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, node bigint, registers binary")


def _node(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node, shingles (as bytes) of the documents whose ids are wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            sets = [s for s in shingle_sets(texts(batch.column("text")), words) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["node", "shingles"],
            )

    rows = docs.join(wanted, "doc_id", "left_semi").select("text")
    found = rows.mapInArrow(run, "node bigint, shingles binary")
    return found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def band_values(found: np.ndarray) -> np.ndarray:
    """The bands of every row of registers, hashed to one number each."""
    parts = found[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    return mixed((parts * FACTORS[:ROWS]).sum(axis=2, dtype=np.uint64)).view(np.int64)


def _bands(nodes: DataFrame) -> DataFrame:
    """node, band, value: the bands of five registers as one number each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
                values = band_values(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(batch.column("node").to_numpy(), BANDS)),
                        pa.array(np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)),
                        pa.array(values.ravel()),
                    ],
                    names=["node", "band", "value"],
                )

    return nodes.select("node", "registers").mapInArrow(run, "node bigint, band int, value bigint")


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that the sketches don't rule out."""
    side = lambda n: nodes.select(
        F.col("node").alias(n), F.col("registers").alias(f"r_{n}"), F.col("n_shingles").alias(f"n_{n}")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("r_a", "r_b")
                )
                sizes = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
                yield batch.select(["a", "b"]).filter(pa.array(hopeful(a, b, *sizes, percent)))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a bigint, b bigint")


PAIRS = "a bigint, label_a bigint, h_a bigint, h_b bigint, partners array<bigint>, labels array<bigint>"


def _confirmed(pairs: DataFrame, sets: DataFrame, homes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b, with their labels) that whole sets confirm, of rows as in PAIRS.

    Rows are grouped by the blocks (homes) of both sides; a group gets the sets of its two blocks once. Links that
    join what earlier links of the group have joined are left out.
    """
    placed = saved(pairs.withColumn("group", F.xxhash64("h_a", "h_b")), "near-pairs")
    both = placed.select("group", "h_a", "h_b").distinct()
    of_group = both.select("group", F.explode(F.array_distinct(F.array("h_a", "h_b"))).alias("home"))
    needed = of_group.join(homes, "home").join(sets, "node").select(F.col("group").alias("set_group"), "node", "shingles")

    def confirm(pairs: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
        found = {n: np.frombuffer(s, np.uint64) for n, s in zip(sets["node"], sets["shingles"], strict=True)}
        up: dict[int, int] = {}

        def top(x: int) -> int:
            while up.get(x, x) != x:
                up[x] = x = up.get(up[x], up[x])
            return x

        out = []
        for a, label, partners, labels in zip(pairs["a"], pairs["label_a"], pairs["partners"], pairs["labels"], strict=True):
            x = found[a]
            for b, other in zip(partners.tolist(), labels.tolist(), strict=True):
                one, two = top(label), top(other)
                if one == two:
                    continue
                y = found[b]
                at = np.searchsorted(x, y)
                at[at == len(x)] = 0
                common = int(np.count_nonzero(x[at] == y))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    up[max(one, two)] = min(one, two)
                    out.append((a, b, label, other))
        return pd.DataFrame(out, columns=["a", "b", "label_a", "label_b"], dtype=np.int64)

    grouped = placed.groupBy("group").cogroup(needed.groupBy("set_group"))
    return grouped.applyInPandas(confirm, "a bigint, b bigint, label_a bigint, label_b bigint")


def _rest(members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Rows as in PAIRS: documents of different components in common buckets that the sketches don't rule out, each pair
    in its first common band.

    ``members``: node, band, value, label, home. The members of a bucket's largest component are cut into blocks and
    compared with blocks of the others, and the others among each other.
    """
    key = ["band", "value"]
    sized = members.groupBy(*key, "label").count()
    largest = sized.groupBy(*key).agg(
        F.max(F.struct("count", "label")).alias("most"), F.sum("count").alias("total"), F.count("*").alias("labels")
    )
    mixed_up = saved(
        largest.where("labels > 1").select(
            *key,
            F.col("most.label").alias("main"),
            F.ceil(F.col("most.count") / BLOCK).cast("int").alias("mains"),
            F.ceil((F.col("total") - F.col("most.count")) / BLOCK).cast("int").alias("others"),
        ),
        "near-mixed",
    )
    spread = F.pmod(F.xxhash64("node"), F.when(F.col("label") == F.col("main"), F.col("mains")).otherwise(F.col("others"))).cast("int")
    block = F.when(F.col("label") == F.col("main"), spread).otherwise(F.col("mains") + spread)
    first_other, last = F.col("mains"), F.col("mains") + F.col("others") - 1
    targets = F.when(
        F.col("block") < first_other,
        F.transform(F.sequence(first_other, last), lambda j: F.struct(F.col("block").alias("i"), j.alias("j"))),
    ).otherwise(
        F.concat(
            F.transform(F.sequence(F.lit(0), F.col("block")), lambda i: F.struct(i.alias("i"), F.col("block").alias("j"))),
            F.when(
                F.col("block") < last,
                F.transform(F.sequence(F.col("block") + 1, last), lambda j: F.struct(F.col("block").alias("i"), j.alias("j"))),
            ).otherwise(F.expr("cast(array() as array<struct<i:int,j:int>>)")),
        )
    )
    dealt = (
        members.join(mixed_up, key)
        .withColumn("block", block)
        .select("node", "band", "value", "label", "home", "block", F.explode(targets).alias("at"))
        .join(nodes.select("node", "registers", "n_shingles"), "node")
        .select(
            "node", "band", "label", "home", "registers", "n_shingles", "block", F.col("at.i").alias("i"), F.xxhash64(*key, "at").alias("group")
        )
    )

    # few bytes are much work here, so groups are not packed into few tasks by their bytes
    tasks = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = dealt.repartition(tasks, "group").sortWithinPartitions("group")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: pa.RecordBatch | None = None  # a group that may go on
        for batch in batches:
            if left is not None:
                batch = pa.concat_batches([left, batch])
            group = batch.column("group").to_numpy()
            cut = int(np.searchsorted(group, group[-1])) if len(group) else 0
            left = batch.slice(cut)
            if cut:
                yield from _compared(batch.slice(0, cut), percent)
        if left is not None and left.num_rows:
            yield from _compared(left, percent)

    return sorted_.mapInArrow(run, PAIRS)


PAIRS_AT_ONCE = 16_384


def _compared(rows: pa.RecordBatch, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows as in PAIRS of whole groups, sorted by group: many small groups are compared at once."""
    found = np.frombuffer(b"".join(rows.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
    group, band, node, label, size, home = (
        rows.column(c).to_numpy() for c in ("group", "band", "node", "label", "n_shingles", "home")
    )
    left = rows.column("block").to_numpy() == rows.column("i").to_numpy()
    low_bytes, values, least = (found & 255).astype(np.uint8), band_values(found), REGISTERS * lower_bound(percent)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])).tolist()
    waiting, count = [], 0
    for a, b in zip(starts, [*starts[1:], len(group)], strict=True):
        one, two = a + np.flatnonzero(left[a:b]), a + np.flatnonzero(~left[a:b])
        x, y = np.repeat(one, len(two) or len(one)), np.tile(two if len(two) else one, len(one))
        fine = label[x] != label[y]
        if not len(two):
            fine &= node[y] > node[x]
        fine &= np.minimum(size[x], size[y]) * 100 >= percent * np.maximum(size[x], size[y])
        waiting.append((x[fine], y[fine]))
        count += int(fine.sum())
        if count >= PAIRS_AT_ONCE or b == len(group):
            every = [np.concatenate(c) for c in zip(*waiting, strict=True)]
            waiting, count = [], 0
            for at in range(0, len(every[0]), PAIRS_AT_ONCE):
                x, y = (c[at : at + PAIRS_AT_ONCE] for c in every)
                # low bytes of equal registers are equal
                keep = (low_bytes[x] == low_bytes[y]).sum(axis=1, dtype=np.uint16) >= least
                x, y = x[keep], y[keep]
                keep = (values[x] == values[y]).argmax(axis=1) == band[x]  # in the first band that they share
                x, y = x[keep], y[keep]
                keep = hopeful(found[x], found[y], size[x], size[y], percent)
                yield _listed(x[keep], y[keep], found, node, label, home)


def _listed(x: np.ndarray, y: np.ndarray, found: np.ndarray, node: np.ndarray, label: np.ndarray, home: np.ndarray) -> pa.RecordBatch:
    """Pairs of rows as lists of partners, those with the most equal registers first."""
    order = np.lexsort((-(found[x] == found[y]).sum(axis=1), home[y], x))
    x, y = x[order], y[order]
    first = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (home[y[1:]] != home[y[:-1]])])) if len(x) else np.zeros(0, np.int64)
    offsets = pa.array(np.append(first, len(x)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(c[y])) for c in (node, label)]
    columns = [node[x[first]], label[x[first]], home[x[first]], home[y[first]]]
    return pa.RecordBatch.from_arrays(
        [*map(pa.array, columns), *lists], names=["a", "label_a", "h_a", "h_b", "partners", "labels"]
    )


def near_duplicates(
    docs: DataFrame, words: int = 3, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: n_shingles, component_id (the smallest id that is reachable over links) and kept."""
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    all_rows = saved(sketches(rows, words), "near-sketches")
    known = all_rows.where("node IS NOT NULL AND doc_id IS NOT NULL")
    firsts = known.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"))
    one = known.select("node", "doc_id", "registers").dropDuplicates(["node", "doc_id"])
    nodes = saved(firsts.join(one, ["node", "doc_id"]), "near-nodes")

    bands = saved(_bands(nodes), "near-bands")
    shared = saved(
        bands.groupBy("band", "value").agg(F.count("*").alias("members"), F.min("node").alias("pivot")).where("members > 1"),
        "near-shared",
    )
    members = saved(bands.join(shared.drop("members"), ["band", "value"]), "near-members")
    stars = members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    lowest = saved(members.groupBy("node").agg(F.min("pivot").alias("pivot")), "near-lowest")
    salts = lowest.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).alias("salts"))
    homes = saved(
        lowest.join(saved(salts, "near-salts"), "pivot").select(
            "node", F.xxhash64("pivot", F.pmod(F.xxhash64("node"), F.col("salts"))).alias("home")
        ),
        "near-homes",
    )
    sets = saved(_sets(rows, nodes.join(homes, "node", "left_semi").select("doc_id", "node"), words), "near-sets")
    home = lambda n: homes.select(F.col("node").alias(n), F.col("home").alias(f"h_{n}"))
    likely = _likely(stars, nodes, percent).join(home("a"), "a").join(home("b"), "b")
    rows_of = likely.select(
        F.col("b").alias("a"),
        F.col("b").alias("label_a"),
        F.col("h_b").alias("h_a"),
        F.col("h_a").alias("h_b"),
        F.array("a").alias("partners"),
        F.array("a").alias("labels"),
    )
    links = saved(_confirmed(rows_of, sets, homes, percent).select("a", "b"), "near-links")
    first = components(homes.select("node"), links, "near-first")
    placed = members.join(first, "node").join(homes, "node")
    more = _confirmed(_rest(placed, nodes, percent), sets, homes, percent)
    joined = components(
        first.select(F.col("label").alias("node")).distinct(),
        more.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")),
        "near-last",
    )
    labels = first.join(joined.select(F.col("node").alias("label"), F.col("label").alias("final")), "label").select("node", "final")
    # a set that shares no band is a component of its own
    ends = nodes.select("node", "doc_id").join(labels, "node", "left").withColumn("final", F.coalesce("final", "node"))
    smallest = ends.groupBy("final").agg(F.min("doc_id").alias("component_id"))
    of_node = saved(ends.join(smallest, "final").select("node", "component_id"), "near-components")
    whole = all_rows.join(of_node, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return whole.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def near_duplicates_sql(size: int = 3, percent: int = 85) -> str:
    """The same rows in SQL, by joining documents on every shingle: for small tables."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    gram = " || ' ' || ".join(f"ws[i + {k}]" for k in range(size))
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, unnest(CASE
    WHEN len(ws) >= {size} THEN list_distinct(list_transform(range(1, len(ws) - {size - 2}), lambda i: {gram}))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), half AS (
  SELECT x, y FROM common JOIN n m ON m.doc_id = x JOIN n o ON o.doc_id = y WHERE 100 * c >= {percent} * (m.n + o.n - c)
), links AS (SELECT x, y FROM half UNION ALL SELECT y, x FROM half),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.r
), least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN n USING (doc_id)"""
