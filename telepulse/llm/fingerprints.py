"""Document fingerprints by a homomorphic multiset hash (operator 9).

Paragraphs (lines) are hashed to 8 lanes that are summed modulo 2^64; these say
whether two documents have the same paragraphs in any order. Phrases (what ends
at punctuation, or 48 letters) are hashed to 256 signs that are summed modulo
2^64; their cosine says how alike two documents are. Both are sums, so a
paragraph is inserted by ``add`` and deleted by ``subtract`` without the text.

The edited text of a document takes from the one after it. Documents are dealt
to ranges of ids and sorted there; the first of each range is also sent to the
range before it, so no text but these is moved twice and no task sees all.

Defined results: null or empty text has the zero fingerprint, two such are
alike by 1, and one of them and another text by 0; rows with equal ids follow
each other by text, a null id comes first; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telepulse.llm.tables import bound_batches, slices

LANES, SIGNS = 8, 256
PHRASE = re.compile(r"[^.,;:!?|\n]{1,48}[.,;:!?|]*")
FIRST = -(1 << 63)

Fingerprint = tuple[np.ndarray, np.ndarray]


def zero() -> Fingerprint:
    return np.zeros(LANES, np.uint64), np.zeros(SIGNS, np.int64)


def fingerprint(text: str | None) -> Fingerprint:
    """The sums over the paragraphs of a text."""
    if not text:
        return zero()
    lines = [hashlib.blake2b(line.encode(), digest_size=64).digest() for line in text.split("\n")]
    lanes = np.frombuffer(b"".join(lines), "<u8").reshape(-1, LANES).sum(axis=0, dtype=np.uint64)
    phrases = [hashlib.blake2b(p.encode(), digest_size=32).digest() for p in PHRASE.findall(text)]
    signs = np.zeros(SIGNS, np.int64)
    for at in range(0, len(phrases), 4096):
        part = phrases[at : at + 4096]
        bits = np.unpackbits(np.frombuffer(b"".join(part), np.uint8)).reshape(-1, SIGNS)
        signs += 2 * bits.sum(axis=0, dtype=np.int32) - len(part)
    return lanes, signs


def add(a: Fingerprint, b: Fingerprint) -> Fingerprint:
    return a[0] + b[0], a[1] + b[1]


def subtract(a: Fingerprint, b: Fingerprint) -> Fingerprint:
    return a[0] - b[0], a[1] - b[1]


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """1 for equal sums; else the cosine of the signs, 0 at least and below 1."""
    if np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1]):
        return 1.0
    x, y = a[1].astype(np.float64), b[1].astype(np.float64)
    size = np.sqrt((x @ x) * (y @ y))
    return float(min(max(x @ y / size, 0.0), 1 - 1e-9)) if size else 0.0


def written(f: Fingerprint) -> str:
    return base64.b64encode(f[0].astype("<u8").tobytes() + f[1].astype("<i8").tobytes()).decode()


def edited(text: str, after: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ranges of ids (``part``), in order within each, the first row of the next range at its end (``copy``).

    The range after the last is the first.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("place", F.coalesce("doc_id", F.lit(FIRST)))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = rows.select("doc_id").stat.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.2 / parts)
    cuts = F.array(*(F.lit(int(c)) for c in sorted(set(cuts)))) if cuts else F.expr("cast(array() as array<bigint>)")
    rows = rows.withColumn("part", F.size(F.filter(cuts, lambda c: c <= F.col("place"))))
    heads = sorted(tuple(r) for r in rows.groupBy("part").agg(F.min("place")).collect())  # a row a range at most
    if not heads:
        return rows.withColumn("copy", F.lit(False))
    before = {place: heads[k - 1][0] for k, (_, place) in enumerate(heads)}
    sent = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("copy"))
    copy = F.struct(sent[F.col("place")].alias("part"), F.lit(True).alias("copy"))
    targets = F.when(sent[F.col("place")].isNotNull(), F.array(own, copy)).otherwise(F.array(own))
    dealt = rows.select("doc_id", "place", "text", F.explode(targets).alias("target")).select(
        "doc_id", "place", "text", "target.part", "target.copy"
    )
    return dealt.repartition(parts, "part").sortWithinPartitions("part", "copy", "place", "text")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they are."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in slices(batches, "text"):
            out = []
            for doc_id, text, part, copy in zip(
                *(batch.column(c).to_pylist() for c in ("doc_id", "text", "part", "copy")), strict=True
            ):
                text = text or ""
                row = (doc_id, text, fingerprint(text), part, copy)
                if last and not last[4] and last[3] == part:
                    other = edited(last[1], text)
                    mark = fingerprint(other)
                    out.append(
                        (
                            last[0],
                            len(last[1]),
                            hashlib.sha256(other.encode()).hexdigest(),
                            written(last[2]),
                            written(mark),
                            likeness(last[2], mark),
                            likeness(last[2], row[2]),
                        )
                    )
                last = row
            columns = list(zip(*out, strict=True)) or [[]] * len(SCHEMA)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True)], schema=SCHEMA)

    return with_next(docs, id_col, text_col).mapInArrow(
        run,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
