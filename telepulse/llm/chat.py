"""Chat formatting with token masks aligned by offsets (operator 6).

A conversation is rendered whole, encoded once with offsets, and the sorted
spans of the assistant's texts are intersected with the sorted token spans by
binary search. Control strings inside roles and texts are escaped by one more
backslash behind their first letter, which ``unescape`` takes away again. The
control strings of the template are tokens of their own, so the parts between
them are encoded independently; a conversation that outgrows ``PIECE`` is cut
between turns into pieces, which changes no token.

Rows reach a task sorted by conversation and turn and are read as a stream, so
a task holds one piece, however long a conversation is.

Defined results: a null text or role is empty; turns of equal number are in
order of role and text; a null conv_id is a conversation of its own; an empty
table gives no rows; extra columns are ignored. Repeated rows are turns.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telepulse.llm.bpe import FILE
from telepulse.llm.tables import bound_batches

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Strings with a meaning to this or other common templates; none is left in a formatted text but as a mark.
GUARDED = (TURN, TEXT, END, "<|endoftext|>", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
TAILS = "|".join(re.escape(g[1:]) for g in GUARDED)
PLAIN = re.compile(rf"([<\[])(\\*)({TAILS})")
ESCAPED = re.compile(rf"([<\[])\\(\\*)({TAILS})")
TURNS = re.compile(rf"{re.escape(TURN)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}", re.DOTALL)
PIECE = 4 << 20
LEARNED_ROLE = "assistant"


def escape(text: str) -> str:
    return PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans in it that are learned."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        parts += [head, body, END]
        if role == LEARNED_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """1 for each token whose span meets one of the spans; both are sorted."""
    learned = np.zeros(len(offsets), np.uint8)
    if len(offsets) and spans:
        wanted = np.array(spans, np.int64)
        low = np.searchsorted(offsets[:, 1], wanted[:, 0], "right")
        high = np.searchsorted(offsets[:, 0], wanted[:, 1], "left")
        for a, b, (start, end) in zip(low.tolist(), high.tolist(), spans, strict=True):
            if start < end:
                learned[a:b] = 1
    return learned


@functools.lru_cache(maxsize=1)
def _tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([AddedToken(mark, special=True, normalized=False) for mark in (TURN, TEXT, END)])
    return tokenizer


def format_conversations(conversations: DataFrame, path: str = FILE) -> DataFrame:
    """Pieces of conversations in order: conv_id, piece, formatted, token_ids and loss_mask (a byte a token)."""
    bound_batches(conversations.sparkSession)
    empty = F.lit("")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        open_id, piece, turns, size = None, 0, [], 0
        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if turns and (conv != open_id or size > PIECE):
                    yield open_id, piece, turns
                    piece, turns, size = (piece + 1 if conv == open_id else 0), [], 0
                open_id = conv
                turns.append((role, text))
                size += len(role) + len(text)
        if turns:
            yield open_id, piece, turns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        out, size = [], 0
        for conv, piece, turns in pieces(batches):
            formatted, spans = render(turns)
            code = tokenizer.encode(formatted, add_special_tokens=False)
            offsets = np.array(code.offsets, np.int64).reshape(-1, 2)
            out.append((conv, piece, formatted, np.array(code.ids, "<u4").tobytes(), mask(offsets, spans).tobytes()))
            size += len(formatted)
            if size > PIECE:
                yield _batch(out, FORMATTED)
                out, size = [], 0
        if out:
            yield _batch(out, FORMATTED)

    return ordered.mapInArrow(run, "conv_id bigint, piece bigint, formatted string, token_ids binary, loss_mask binary")


def read_back(formatted: DataFrame, path: str = FILE) -> DataFrame:
    """Per conversation, from the pieces as they were written: digests of its turns and of the text under the mask.

    The pieces of a conversation follow each other, as ``format_conversations`` leaves them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        open_id, state = None, None

        def closed() -> tuple:
            return (open_id, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5])

        for batch in batches:
            out = []
            columns = ("conv_id", "piece", "formatted", "token_ids", "loss_mask")
            for conv, piece, text, ids, learned in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if state is None or conv != open_id or piece == 0:
                    if state is not None:
                        out.append(closed())
                    open_id, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for found in TURNS.finditer(text):
                    state[0] += 1
                    state[1].update(f"{unescape(found[1])}\n{unescape(found[2])}\n".encode())
                codes, on = np.frombuffer(ids, "<u4"), np.frombuffer(learned, np.uint8)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], on, [0]]).astype(np.int8)))
                for a, b in edges.reshape(-1, 2).tolist():
                    body = unescape(tokenizer.decode(codes[a:b].tolist(), skip_special_tokens=False))
                    state[2] += len(body)
                    state[3].update(body.encode())
                state[4] += len(text)
                state[5] += len(codes)
            yield _batch(out, DIGESTS)
        if state is not None:
            yield _batch([closed()], DIGESTS)

    return formatted.mapInArrow(
        run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint, n_tokens bigint",
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


FORMATTED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("piece", pa.int64()),
        ("formatted", pa.string()),
        ("token_ids", pa.binary()),
        ("loss_mask", pa.binary()),
    ]
)
DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("n_tokens", pa.int64()),
    ]
)

MARKED = "</s>[INST] ok [/INST]"


def chat_digests(conversations: DataFrame) -> DataFrame:
    """Digests of all conversations and of conversation -1, whose texts are control strings."""
    extra = conversations.sparkSession.createDataFrame(
        [(-1, 0, "user", MARKED), (-1, 1, LEARNED_ROLE, MARKED)], "conv_id long, turn long, role string, text string"
    )
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    return read_back(format_conversations(rows.unionByName(extra))).drop("n_tokens")


def chat_sql() -> str:
    """The same rows in SQL: escaping adds one letter for each match."""
    tails = "|".join(re.escape(g[1:]) for g in GUARDED)
    pattern = rf"[<\[]\\*(?:{tails})".replace("'", "''")
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{MARKED}' UNION ALL SELECT -1, 1, 'assistant', '{MARKED}'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(TURN + TEXT + END)} + length(role) + length(text) + len(regexp_extract_all(role, '{pattern}'))
    + len(regexp_extract_all(text, '{pattern}'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""
