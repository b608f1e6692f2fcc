"""Token counts from a compiled finite-state tokenizer (operator 2).

Two deterministic transducers read a text. The first (``pretokens``) reads
code-point classes and flags pretoken starts; chunks of fixed length are run
from every state and their state maps composed by a parallel prefix scan. The
second reads the bytes of a pretoken. Its state is what later bytes can still
change: for every place from which some vocabulary entry may go on, the entry's
trie node, the last token before that place and how many tokens fewer there
were. The encoding of a prefix ends in the one entry that fits the token before
it, so the state decides the next state, and the transition carries the change
of the token count. States are compiled when first met and dropped when there
are too many. A pretoken start always leads to the first state, so chunks that
begin there have constant maps: their counts add up, and thousands of chunks
advance together, one byte a step.

Defined results: null or empty text has 0 tokens; special strings inside texts
are one token each, as the library's default; repeated rows give repeated
results; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telepulse.llm.bpe import FILE
from telepulse.llm.pretokens import Pieces, Vocabulary, vocabulary
from telepulse.llm.tables import bound_batches, slices, texts

CHUNK_BYTES = 2048
RUN_IN = 512  # bytes before a chunk within a pretoken, from which the state at its start is guessed
MOST_STATES = 1 << 18


class Transducer:
    """Next state and count change for (state, byte), compiled on demand."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.trie: dict[int, int] = {}
        self.token, self.inner = [-1], [True]
        for name, i in vocab.ids.items():
            node = 0
            for byte in name:
                self.inner[node] = True
                step = node << 8 | byte
                node = self.trie.get(step) or self.trie.setdefault(step, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
                    self.inner.append(False)
            self.token[node] = i
        self.columns, self.bytes = np.full(256, -1, np.int64), []  # bytes that have been met
        self.fits: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.keys: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.to = np.full((1 << 12, 64), -1, np.int32)
        self.change = np.zeros(self.to.shape, np.int8)
        self.number(((0, -1, 0),))

    def grow(self, axis: int) -> None:
        """Double the table along an axis."""
        self.to = np.concatenate([self.to, np.full_like(self.to, -1)], axis)
        self.change = np.concatenate([self.change, np.zeros_like(self.change)], axis)

    def number(self, key: tuple) -> int:
        found = self.numbers.get(key)
        if found is None:
            found = self.numbers[key] = len(self.keys)
            self.keys.append(key)
            if found == len(self.to):
                self.grow(0)
        return found

    def fit(self, last: int, token: int) -> bool:
        """Whether ``token`` is encoded as itself after the token ``last`` (-1: at the start)."""
        known = self.fits.get((last, token))
        if known is None:
            names = self.vocab.token_bytes
            word, want = (names[last] + names[token], [last, token]) if last >= 0 else (names[token], [token])
            known = self.fits[last, token] = self.merge(word) == want
        return known

    def merge(self, word: bytes) -> list[int]:
        tokens, ranks = [int(self.vocab.byte_ids[b]) for b in word], self.vocab.ranks
        while len(tokens) > 1:
            rank, i = min((ranks.get((a, b), 1 << 40), i) for i, (a, b) in enumerate(zip(tokens, tokens[1:])))
            if rank == 1 << 40:
                break
            tokens[i : i + 2] = [int(self.vocab.merged[rank])]
        return tokens

    def compile(self, state: int, column: int) -> None:
        """Fill the transition of a state for a byte, which is given by its column."""
        byte = self.bytes[column]
        token, less, open_ends = -1, 0, []
        for node, last, behind in self.keys[state]:
            child = self.trie.get(node << 8 | byte)
            if child is None:
                continue
            if token < 0 and self.token[child] >= 0 and self.fit(last, self.token[child]):
                token, less = self.token[child], behind + 1
            if self.inner[child]:
                open_ends.append((child, last, behind))
        if token < 0:
            raise ValueError("a byte of the text is in no vocabulary entry")
        key = (*((node, last, behind - less) for node, last, behind in open_ends), (0, token, 0))
        to = self.number(key)
        self.to[state, column], self.change[state, column] = to, less

    def run(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Change of the token count at each byte; ``starts``: bytes where pretokens begin, the first is 0."""
        n = len(data)
        if len(self.keys) > MOST_STATES:
            self.reset()
        for byte in np.flatnonzero((np.bincount(data, minlength=256) > 0) & (self.columns < 0)).tolist():
            self.columns[byte] = len(self.bytes)
            self.bytes.append(byte)
            if len(self.bytes) > self.to.shape[1]:
                self.grow(1)
        columns = self.columns[data]
        fresh = np.zeros(n, bool)
        fresh[starts] = True
        wanted = np.arange(0, n, CHUNK_BYTES)
        begin = np.unique(starts[np.minimum(np.searchsorted(starts, wanted), len(starts) - 1)])
        if begin[0]:
            begin = np.concatenate([[0], begin])
        begin, run_in = self._cut(begin, n)
        end = np.append(begin[1:], n)
        length = end - begin + run_in
        order = np.argsort(-length, kind="stable")
        first, skip, length = (begin - run_in)[order], run_in[order], length[order]
        alive = np.searchsorted(-length, -np.arange(length[0]), "left")
        out = np.zeros(n, np.int8)
        state = np.zeros(len(begin), np.int64)
        guessed = np.zeros(len(begin), np.int64)
        wide = self.to.shape[1]
        table, change = self.to.ravel(), self.change.ravel()
        for step, count in enumerate(alive.tolist()):
            at = first[:count] + step
            now = state[:count]
            entered = skip[:count] == step
            guessed[:count][entered] = now[entered]
            now[fresh[at]] = 0
            move = now * wide + columns[at]
            to = table[move]
            if to.min() < 0:
                for missing in np.unique(move[to < 0]).tolist():
                    self.compile(*divmod(missing, wide))
                table, change = self.to.ravel(), self.change.ravel()
                to = table[move]
            counted = skip[:count] <= step
            out[at[counted]] = change[move[counted]]
            state[:count] = to
        # chunks compose where each was entered in the state that the one before it ends in; others are run again
        left, entry = np.empty_like(state), np.empty_like(state)
        left[order], entry[order] = state, guessed
        for k in np.flatnonzero(run_in).tolist():
            if not fresh[begin[k]] and left[k - 1] != entry[k]:
                left[k] = self._again(columns, fresh, out, int(begin[k]), int(end[k]), int(left[k - 1]))
        return out

    def _cut(self, begin: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Chunks of what is longer than two, and how many bytes before each of these its run begins, in the first state."""
        more = [
            np.arange(a + CHUNK_BYTES, b - CHUNK_BYTES, CHUNK_BYTES)
            for a, b in zip(begin.tolist(), [*begin[1:].tolist(), n], strict=True)
            if b - a > 2 * CHUNK_BYTES
        ]
        cut = np.concatenate([np.zeros(0, np.int64), *more])
        every = np.concatenate([begin, cut])
        order = np.argsort(every)
        return every[order], np.repeat([0, RUN_IN], [len(begin), len(cut)])[order]

    def _again(self, columns: np.ndarray, fresh: np.ndarray, out: np.ndarray, begin: int, end: int, state: int) -> int:
        """One chunk from the state it is entered in; returns the state it ends in."""
        for at in range(begin, end):
            if fresh[at]:
                state = 0
            if self.to[state, columns[at]] < 0:
                self.compile(state, int(columns[at]))
            out[at] = self.change[state, columns[at]]
            state = int(self.to[state, columns[at]])
        return state


@functools.lru_cache(maxsize=1)
def transducer(path: str) -> Transducer:
    """One for all tasks of a worker, so that states are compiled once."""
    return Transducer(vocabulary(path))


def count_tokens(batch: list[str], machine: Transducer) -> np.ndarray:
    pieces = Pieces(batch, machine.vocab.specials)
    counts = np.zeros(len(batch), np.int64)
    for text, _, _ in pieces.special:
        counts[text] += 1
    if pieces.segments:
        codes = pieces.codes
        width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        offset = np.concatenate([[0], np.cumsum(width)])
        data = np.frombuffer(pieces.joined.encode(), np.uint8)
        total = np.concatenate([[0], np.cumsum(machine.run(data, offset[pieces.starts]), dtype=np.int64)])
        np.add.at(counts, pieces.owner, total[offset[pieces.end]] - total[offset[pieces.begin]])
    return counts


def token_counts(
    docs: DataFrame, path: str = FILE, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per whole text: doc_id, n_bytes, n_tokens and whether that is over ``limit``."""
    bound_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in slices(batches, "text", 2 << 20):
            found = texts(batch.column("text"))
            counts = count_tokens(found, machine)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t.encode()) for t in found], pa.int64()),
                    pa.array(counts),
                    pa.array(counts > limit),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
