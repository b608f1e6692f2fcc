"""BPE encoding and decoding with a segment tree over adjacent pair ranks (operator 5).

Each pretoken is a row of leaves, one per pair of neighbours, holding the
pair's merge rank and its place. An inner node holds the smaller of its two
children, so the root is the leftmost pair of lowest rank. A merge changes
three leaves and the paths above them; it ends when the root is no pair.
Many short pretokens are worked on at once as rows of one array; a long one has
a tree of its own. Equal pretokens of a worker are encoded once; that memory
is emptied when it is full.

Defined results: null or empty text has no tokens and decodes to the empty
text; repeated rows give repeated results; an empty table gives no rows; extra
columns are ignored, their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telepulse.llm.pretokens import Pieces, Vocabulary, vocabulary
from telepulse.llm.tables import bound_batches, slices, texts

NONE = np.int64(1) << 62
WIDE = 128  # pretokens with more pairs get a tree of their own
ROWS = 1 << 14
REMEMBERED = 200_000  # pretokens a worker keeps
SLICE = 1 << 20  # bytes of text encoded at once
FILE = public_tokenizers.path("byte_bpe_50k.json")


def _leaf(vocab: Vocabulary, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Rank and place of pairs in one number; NONE where they don't merge or a side is missing."""
    key = (left << 32) | np.maximum(right, 0)
    at = np.minimum(np.searchsorted(vocab.pair_keys, key), len(vocab.pair_keys) - 1)
    known = (vocab.pair_keys[at] == key) & (left >= 0) & (right >= 0)
    return np.where(known, (vocab.pair_order[at] << 24) | place, NONE)


def encode_rows(words: list[bytes], vocab: Vocabulary, leaves: int) -> list[bytes]:
    """Encode pretokens of at most ``leaves`` pairs (a power of two), all rows together."""
    n, width = len(words), leaves + 2
    tokens = np.full((n, width), -1, np.int64)
    lengths = np.fromiter(map(len, words), np.int64, n)
    filled = np.arange(width) < lengths[:, None]
    tokens[filled] = vocab.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    after = np.where(np.arange(width) + 1 < lengths[:, None], np.arange(width) + 1, leaves + 1)
    before = np.broadcast_to(np.arange(width) - 1, (n, width)).copy()
    tree = np.full((n, 2 * leaves), NONE, np.int64)
    places = np.broadcast_to(np.arange(leaves), (n, leaves))
    tree[:, leaves:] = _leaf(vocab, tokens[:, :leaves], tokens[:, 1 : leaves + 1], places)
    level = leaves
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2
    rows = np.flatnonzero(tree[:, 1] < NONE)
    while len(rows):
        root = tree[rows, 1]
        place, rank = root & 0xFFFFFF, root >> 24
        gone = after[rows, place]
        behind = after[rows, gone]
        tokens[rows, place] = vocab.merged[rank]
        tokens[rows, gone] = -1
        after[rows, place] = behind
        before[rows, behind] = place
        front = before[rows, place]
        changed = np.stack([place, np.minimum(gone, leaves - 1), np.maximum(front, 0)])
        new = tokens[rows, place]
        here = _leaf(vocab, new, np.where(behind <= leaves, tokens[rows, np.minimum(behind, width - 1)], -1), place)
        tree[rows, leaves + place] = here
        inside = gone < leaves
        tree[rows[inside], leaves + gone[inside]] = NONE
        ahead = front >= 0
        tree[rows[ahead], leaves + front[ahead]] = _leaf(vocab, tokens[rows[ahead], front[ahead]], new[ahead], front[ahead])
        node = changed + leaves
        while (node[0, 0]) > 1:
            node >>= 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
        rows = rows[tree[rows, 1] < NONE]
    kept = tokens >= 0
    ends = np.cumsum(kept.sum(axis=1)) * 4
    data = tokens[kept].astype("<u4").tobytes()
    return [data[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]


def encode_long(word: bytes, vocab: Vocabulary) -> bytes:
    """Encode one pretoken of any length with a tree of plain numbers."""
    n, none, ranks, merged = len(word), 1 << 62, vocab.ranks, vocab.merged
    tokens = vocab.byte_ids[np.frombuffer(word, np.uint8)].tolist()
    leaves = 1 << max(1, (n - 1).bit_length())
    after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
    tree = [none] * (2 * leaves)

    def leaf(i: int) -> int:
        j = after[i]
        rank = ranks.get((tokens[i], tokens[j])) if j < n else None
        return none if rank is None else (rank << 32) | i

    for i in range(n - 1):
        tree[leaves + i] = leaf(i)
    for k in range(leaves - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])

    def put(i: int, value: int) -> None:
        k = leaves + i
        tree[k] = value
        while k > 1:
            k >>= 1
            low = min(tree[2 * k], tree[2 * k + 1])
            if tree[k] == low:
                break
            tree[k] = low

    while (root := tree[1]) < none:
        i = root & 0xFFFFFFFF
        gone = after[i]
        tokens[i], after[i] = int(merged[root >> 32]), after[gone]
        tokens[gone] = -1
        if after[i] < n:
            before[after[i]] = i
        put(gone, none)
        put(i, leaf(i))
        if before[i] >= 0:
            put(before[i], leaf(before[i]))
    return np.array([t for t in tokens if t >= 0], "<u4").tobytes()


def encode_words(words: list[bytes], vocab: Vocabulary) -> list[bytes]:
    """Ids of each pretoken as little-endian 32-bit numbers."""
    out: list[bytes] = [b""] * len(words)
    sized: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        sized.setdefault(1 << max(1, (len(word) - 2).bit_length() if len(word) > 1 else 1), []).append(i)
    for leaves, group in sized.items():
        if leaves > WIDE:
            for i in group:
                out[i] = encode_long(words[i], vocab)
            continue
        for k in range(0, len(group), ROWS):
            part = group[k : k + ROWS]
            for i, ids in zip(part, encode_rows([words[i] for i in part], vocab, leaves), strict=True):
                out[i] = ids
    return out


class Encoder:
    """Encodes and decodes texts; remembers pretokens it has seen."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.known: dict[str, bytes] = {}

    def encode(self, batch: list[str]) -> list[bytes]:
        pieces = Pieces(batch, self.vocab.specials)
        words, first = pieces.words()
        fresh = list(set(words).difference(self.known))
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known, fresh = {}, list(set(words))
        coded = encode_words([w.encode() for w in fresh], self.vocab)
        self.known.update(zip(fresh, coded, strict=True))
        ids = list(map(self.known.__getitem__, words))
        # a break follows every segment but the last
        stop = [*(first[1:] - 1).tolist(), len(ids)] if len(first) else []
        parts: list[list[bytes]] = [[] for _ in batch]
        specials = iter([*pieces.special, (len(batch), len(pieces.segments), -1)])
        text, before, special = next(specials)
        for k in range(len(pieces.segments) + 1):
            while before == k and special >= 0:
                parts[text].append(special.to_bytes(4, "little"))
                text, before, special = next(specials)
            if k < len(pieces.segments):
                parts[pieces.owner[k]].append(b"".join(ids[int(first[k]) : stop[k]]))
        return [b"".join(p) for p in parts]

    def decode(self, ids: bytes) -> str:
        names = self.vocab.token_bytes
        return b"".join([names[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", errors="replace")


def bpe_encode(docs: DataFrame, path: str = FILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids and decoded text of every whole text: id, n_tokens, token_ids binary, decoded."""
    bound_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in slices(batches, "text", SLICE):
            ids = encoder.encode(texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array([encoder.decode(x) for x in ids], pa.string()),
                ],
                names=["doc_id", "n_tokens", "token_ids", "decoded"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, token_ids binary, decoded string")


def bpe_digests(docs: DataFrame, path: str = FILE) -> DataFrame:
    """One row per document with digests of its ids and of the text they decode to."""
    coded = bpe_encode(docs, path)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
