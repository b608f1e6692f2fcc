"""Blocks of the context tree: memory, and grams against a plain count."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from telepulse.llm import context_tree

WORDS = ["the", "cat", "sat", "zebra", "é", "ß", "中", "😀", "\n", "A"]


def _docs(texts, trained=None):
    trained = trained or [i % 5 > 0 for i in range(len(texts))]
    rows = {"doc_id": list(range(len(texts))), "text": texts, "held_out": [not t for t in trained], "block": [0] * len(texts)}
    return pa.table(rows)


def _peak(run):
    tracemalloc.start()
    try:
        out = run()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_block_takes_little_memory():
    rng = random.Random(1)
    texts, size = [], 0
    while size < context_tree.BLOCK_BYTES:
        texts.append(" ".join(rng.choices(WORDS, k=4000)) + str(size))
        size += len(texts[-1].encode()) + 1
    docs = _docs(texts)
    counts, peak = _peak(lambda: context_tree._count_block(docs))
    assert peak < 15 * size
    prices = counts.select(["key"]).append_column("price", pa.array(np.full(counts.num_rows, -1.0)))
    scored, peak = _peak(lambda: context_tree._score_block(-1.0, True, -2.0, 9)(docs, prices))
    assert peak < 15 * size
    assert scored.column("score").to_pylist() == [-float(len(t.encode()) + 1) for t in texts]


@pytest.mark.parametrize("piece", [3, 64, 1 << 18])
def test_grams_equal_a_plain_count(monkeypatch, piece):
    monkeypatch.setattr(context_tree, "SLICE", piece)
    rng = random.Random(2)
    texts = ["", "a", *(" ".join(rng.choices(WORDS, k=rng.randint(0, 9))) for _ in range(60)), "", "z" * 200]
    trained = [rng.random() < 0.7 for _ in texts]
    depth, pad = context_tree.DEPTH, bytes([context_tree.END])
    grams = []
    for text in texts:
        data = pad * depth + text.encode() + pad
        grams.append([int.from_bytes(data[i - depth : i + 1]) for i in range(depth, len(data))])
    wanted = Counter({g: 0 for one in grams for g in one})
    wanted.update(g for one, t in zip(grams, trained, strict=True) if t for g in one)
    halves = pa.chunked_array([texts[:20], texts[20:]])
    trie = context_tree.Trie(halves)
    assert trie.grams.tolist() == sorted(wanted)
    assert trie.counts(np.array(trained)).tolist() == [wanted[g] for g in sorted(wanted)]
    place = {g: float(i) for i, g in enumerate(sorted(wanted))}
    assert trie.sums(np.arange(len(wanted), dtype=float)).tolist() == [sum(place[g] for g in one) for one in grams]
