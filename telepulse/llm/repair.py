"""Conversation structure repair by a square-root checkpointed DP (operator 13).

A repaired conversation has roles ``(s?(ua)+)?`` by their initials. Keep costs
0, Rerole to user or assistant 2, Delete 3 (a blank or repeated row must go),
Insert of an empty user or assistant turn 2, and a truncated row that stays 1.
What an edit leads to follows from its initial and the place in the pattern, so
the initials tell the whole repair, and of the cheapest the ASCII-least is
taken: Delete, Insert, Keep, Rerole, the first that keeps the cost.

Rows are sorted by conversation over all tasks and cut into blocks of ``BLOCK``
rows, so a conversation with a third of all rows is many blocks in many tasks.
Costs over a block are a matrix of four places by four.

1. Back over a conversation's blocks, the matrices give the cost vector behind
   each block: these are the outer checkpoints.
2. Each block walks from each of the four places to where it ends; forward over
   the blocks, this gives where each block starts.
3. Each block emits its edits and repaired rows.

Within a block, backward vectors are stored at every square root of its rows
only; the stretch before each is computed again while the walk goes forward.
Only the digest of the repaired text and the joined initials pass through one
task a conversation, as a stream of blocks.

Defined results: a null conv_id is a conversation of its own; null roles, texts
and turns are damaged as one space (turns stay null in their order); rows of
equal turn are in order of role and text; repeated rows are duplicates; other
roles than system, user and assistant count by their initial; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telepulse.llm.tables import bound_batches, saved

BLOCK, BLOCK_CHARS = 1024, 1 << 20
# places in the pattern: nothing yet, behind the system turn, behind a user's, behind an assistant's
PLACES = range(4)
USER, ASSISTANT = 2, 3
INSERTED = (USER, USER, ASSISTANT, USER)  # where an inserted or reroled turn leads from each place
KEPT = ({"s": 1, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ROLES = {USER: "user", ASSISTANT: "assistant"}
ENDING = (0, 4, 2, 0)  # cost of the turns that must be inserted at the end
NEVER = 1 << 40
INITIALS = ("", "s", "u", "a")  # of a row's code: initial + 4 (must go) + 8 (truncated)
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def damaged(rows: DataFrame) -> DataFrame:
    """Rows conv_id, turn, role, text damaged by a hash of their place; dropped ones stay, marked as gone."""
    space = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(F.encode(place, "UTF-8")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault")).select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") <= 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("fault") == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))),
    ).drop("col")


def faults(rows: DataFrame) -> DataFrame:
    """Add blank, truncated and later: whether the same role and text is in an earlier turn of the conversation."""
    marked = rows.withColumns(
        {
            "blank": ~F.col("text").rlike(r"[^\x20\x09-\x0D]"),
            "truncated": ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"),
            "words": F.unhex(F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "text"), 256)),
        }
    )
    first = (
        marked.where("NOT gone AND NOT blank")
        .groupBy("conv_id", "words")
        .agg(F.count("*").alias("n"), F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
        .where("n > 1")
        .select(F.col("conv_id").alias("c"), F.col("words").alias("w"), "first.turn")
        .withColumnRenamed("turn", "first_turn")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("words") == F.col("w"))
    later = F.col("w").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first_turn"))
    return marked.join(first, same, "left").withColumn("later", later).drop("c", "w", "words", "first_turn")


@functools.lru_cache(maxsize=1 << 16)
def step(code: int, after: tuple[int, ...]) -> tuple[int, tuple[int, ...], tuple[tuple[str, int], ...]]:
    """One row back: what the costs rise by, the costs before it (the least is 0), and per place its initials and what follows."""
    initial, forced, extra = INITIALS[code & 3], code & 4, code >> 3 & 1
    edits = []
    for place in PLACES:
        found = [("D", 3 + after[place], place)]
        if not forced:
            to = KEPT[place].get(initial)
            if to is not None:
                found.append(("K", extra + after[to], to))
            found.append(("R", 2 + extra + after[INSERTED[place]], INSERTED[place]))
        edits.append(found)
    least = [min(cost for _, cost, _ in found) for found in edits]
    once = [min(least[p], 2 + least[INSERTED[p]]) for p in PLACES]
    costs = [min(least[p], 2 + once[INSERTED[p]]) for p in PLACES]
    moves = []
    for place in PLACES:
        letters, at = "", place
        while True:
            tight = {letter: to for letter, cost, to in edits[at] if cost == costs[at]}
            if "D" in tight or 2 + costs[INSERTED[at]] != costs[at]:
                letter = min(tight)
                moves.append((letters + letter, tight[letter]))
                break
            letters, at = letters + "I", INSERTED[at]
    low = min(costs)
    return low, tuple(min(c - low, NEVER) for c in costs), tuple(moves)


def back(codes: bytes, after: tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
    """Costs before the rows: a number and the rest by place."""
    total = 0
    for code in reversed(codes):
        rise, after, _ = step(code, after)
        total += rise
    return total, after


def matrix(codes: bytes) -> list[int]:
    """Costs of the rows from each place (rows of four) to each place behind them."""
    columns = []
    for end in PLACES:
        total, costs = back(codes, tuple(0 if p == end else NEVER for p in PLACES))
        columns.append([min(total + c, NEVER) for c in costs])
    return [columns[end][start] for start in PLACES for end in PLACES]


def before(matrix: list[int], after: list[int]) -> list[int]:
    """The cost vector before a block with this matrix, the least 0."""
    costs = [min(min(matrix[4 * s + e] + after[e] for e in PLACES), NEVER) for s in PLACES]
    return [min(c - min(costs), NEVER) for c in costs]


def walk(codes: bytes, after: tuple[int, ...], starts: list[int]) -> Iterator[tuple[tuple[str, int], ...]]:
    """The moves of every row for the places that the starts have come to, which are moved on.

    Vectors are stored at every square root of the rows; a stretch's are computed again before it is walked.
    """
    low = min(after)
    after = tuple(min(c - low, NEVER) for c in after)
    stride = max(1, math.isqrt(len(codes)))
    stored, costs = {len(codes): after}, after
    for i in range(len(codes) - 1, -1, -1):
        costs = step(codes[i], costs)[1]
        if i % stride == 0:
            stored[i] = costs
    for begin in range(0, len(codes), stride):
        end = min(begin + stride, len(codes))
        costs, moves = stored[end], []
        for code in reversed(codes[begin:end]):
            _, costs, move = step(code, costs)
            moves.append(move)
        for move in reversed(moves):
            taken = tuple(move[at] for at in starts)
            starts[:] = [to for _, to in taken]
            yield taken


BLOCKS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("block", pa.int64()),
        ("codes", pa.binary()),
        ("matrix", pa.list_(pa.int64())),
        ("faults", pa.list_(pa.int64())),  # blank, duplicate, truncated, illegal within
        ("turns", pa.list_(pa.int64())),  # first, last, distinct; empty without turns
        ("roles", pa.list_(pa.string())),
        ("texts", pa.list_(pa.string())),
    ]
)
BLOCKS_DDL = (
    "conv_id bigint, block bigint, codes binary, matrix array<bigint>, faults array<bigint>, turns array<bigint>, "
    "roles array<string>, texts array<string>"
)


class Block:
    """Rows of one conversation that follow each other."""

    def __init__(self, conv: int | None, block: int) -> None:
        self.conv, self.block, self.codes = conv, block, bytearray()
        self.roles, self.texts, self.turns, self.faults, self.chars = [], [], [], [0, 0, 0, 0], 0

    def add(self, turn: int | None, role: str, text: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        fault = 0 if blank else 1 if duplicate else 2 if truncated else None
        if fault is not None:
            self.faults[fault] += 1
        initial = role[:1]
        if self.roles and (self.roles[-1][:1], initial) not in LEGAL:
            self.faults[3] += 1
        code = INITIALS.index(initial) if initial in ("s", "u", "a") else 0
        self.codes.append(code + 4 * (fault in (0, 1)) + 8 * (fault == 2))
        if turn is not None:
            self.turns = [self.turns[0], turn, self.turns[2] + (turn != self.turns[1])] if self.turns else [turn, turn, 1]
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)

    def full(self) -> bool:
        return len(self.codes) >= BLOCK or self.chars > BLOCK_CHARS

    def row(self) -> tuple:
        codes = bytes(self.codes)
        return (self.conv, self.block, codes, matrix(codes), self.faults, self.turns, self.roles, self.texts)


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _blocks(rows: DataFrame) -> DataFrame:
    """Blocks of all conversations, numbered in the order of their rows."""
    turn = F.col("turn").asc_nulls_first()
    spread = rows.repartitionByRange("conv_id", turn, "role", F.substring("text", 1, 64))
    ordered = spread.sortWithinPartitions("conv_id", turn, "role", "text").withColumn("task", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_block, number, last, out, chars = None, 0, None, [], 0
        columns = ("conv_id", "turn", "role", "text", "gone", "blank", "truncated", "later", "task")
        for batch in batches:
            for conv, turn, role, text, gone, blank, truncated, later, task in zip(
                *(batch.column(c).to_pylist() for c in columns), strict=True
            ):
                if open_block is None or open_block.conv != conv or open_block.full():
                    if open_block is not None:
                        out.append(open_block.row())
                        chars += open_block.chars
                    open_block, number = Block(conv, (task << 40) + number), number + 1
                    if chars > BLOCK_CHARS or len(out) >= BLOCK:
                        yield _arrow(out, BLOCKS)
                        out, chars = [], 0
                if not gone:
                    again = last == (conv, turn, role, text)
                    open_block.add(turn, role, text, blank, later or again, truncated)
                    last = (conv, turn, role, text)
        if open_block is not None:
            out.append(open_block.row())
        yield _arrow(out, BLOCKS)

    return ordered.mapInArrow(run, BLOCKS_DDL)


def _in_order(blocks: DataFrame, order) -> DataFrame:
    return blocks.repartition("conv_id").sortWithinPartitions("conv_id", order)


def _scan(blocks: DataFrame, backwards: bool) -> DataFrame:
    """block, at: the cost vector behind each block, from matrices; or the place each starts at, from where walks end."""
    column = "matrix" if backwards else "ends"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, at, begun = None, None, False
        for batch in batches:
            found = []
            for this, over in zip(batch.column("conv_id").to_pylist(), batch.column(column).to_pylist(), strict=True):
                if not begun or this != conv:
                    conv, begun, at = this, True, list(ENDING) if backwards else [0]
                found.append(at)
                at = before(over, at) if backwards else [over[at[0]]]
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(found, pa.list_(pa.int64()))], names=["block", "at"])

    order = F.col("block").desc() if backwards else F.col("block")
    return _in_order(blocks.select("conv_id", "block", column), order).mapInArrow(run, "block bigint, at array<bigint>")


def _ends(blocks: DataFrame) -> DataFrame:
    """conv_id, block, ends: where a walk over the block ends from each place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for codes, after in zip(batch.column("codes").to_pylist(), batch.column("at").to_pylist(), strict=True):
                at = list(PLACES)
                for _ in walk(codes, tuple(after), at):
                    pass
                found.append(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("block"), pa.array(found, pa.list_(pa.int64()))], names=["conv_id", "block", "ends"]
            )

    return blocks.select("conv_id", "block", "codes", "at").mapInArrow(run, "conv_id bigint, block bigint, ends array<bigint>")


REPAIRED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("block", pa.int64()),
        ("faults", pa.list_(pa.int64())),
        ("turns", pa.list_(pa.int64())),
        ("edges", pa.string()),  # initials of the first and the last row; empty without rows
        ("cost", pa.int64()),
        ("audit", pa.string()),
        ("lines", pa.list_(pa.string())),
        ("place", pa.int32()),
    ]
)
REPAIRED_DDL = (
    "conv_id bigint, block bigint, faults array<bigint>, turns array<bigint>, edges string, cost bigint, audit string, "
    "lines array<string>, place int"
)
COSTS = {"D": 3, "I": 2, "K": 0, "R": 2}


def _repaired(blocks: DataFrame) -> DataFrame:
    """Per block its edits, the rows that they leave as ``role:text``, and the place they end at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                at, place, audit, lines, cost = list(row["start"]), row["start"][0], [], [], 0
                kinds = zip(walk(row["codes"], tuple(row["at"]), at), row["codes"], row["roles"], row["texts"], strict=True)
                for ((letters, to),), code, role, text in kinds:
                    audit.append(letters)
                    for letter in letters:
                        cost += COSTS[letter] + (letter in "KR" and code >> 3 & 1)
                        if letter == "I":
                            place = INSERTED[place]
                            lines.append(f"{ROLES[place]}:")
                        elif letter != "D":
                            lines.append(f"{role if letter == 'K' else ROLES[INSERTED[place]]}:{text}")
                    place = to
                # an empty role has no initial
                edges = "".join((r[:1] or " ") for r in (row["roles"][0], row["roles"][-1])) if row["roles"] else ""
                out.append(
                    (row["conv_id"], row["block"], row["faults"], row["turns"], edges, cost, "".join(audit), lines, place)
                )
            yield _arrow(out, REPAIRED)

    return blocks.mapInArrow(run, REPAIRED_DDL)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Blocks of repaired conversations in the order of ``block``: faults, edits as initials and lines ``role:text``.

    ``rows``: conv_id, turn, role, text, gone (a row that only keeps its conversation's id). The turns that a
    conversation lacks at its end follow from the place of its last block.
    """
    blocks = saved(_blocks(faults(rows)), "repair-blocks")
    costs = saved(_scan(blocks, backwards=True), "repair-costs")
    ends = _ends(blocks.join(costs, "block"))
    starts = saved(_scan(ends, backwards=False), "repair-starts")
    return _repaired(blocks.join(costs, "block").join(starts.withColumnRenamed("at", "start"), "block"))


DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        *((name, pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        ("audit", pa.string()),
        ("repaired_sha256", pa.string()),
    ]
)


class _Digest:
    def __init__(self, conv: int | None) -> None:
        self.conv, self.faults, self.turns, self.edge = conv, [0, 0, 0, 0], [], ""
        self.cost, self.audit, self.sha, self.place, self.any_line = 0, [], hashlib.sha256(), 0, False

    def add(self, row: dict) -> None:
        self.faults = [a + b for a, b in zip(self.faults, row["faults"], strict=True)]
        if row["edges"]:
            if self.edge and (self.edge, row["edges"][0]) not in LEGAL:
                self.faults[3] += 1
            self.edge = row["edges"][-1]
        if row["turns"]:
            first, last, distinct = row["turns"]
            if self.turns:
                distinct += self.turns[2] - (first == self.turns[1])
            self.turns = [self.turns[0] if self.turns else first, last, distinct]
        self.cost += row["cost"]
        self.audit.append(row["audit"])
        self._write(row["lines"])
        self.place = row["place"]

    def _write(self, lines: list[str]) -> None:
        for line in lines:
            if self.any_line:
                self.sha.update(b"\n")
            self.any_line = True
            self.sha.update(line.encode())

    def row(self) -> tuple:
        while ENDING[self.place]:
            self.place = INSERTED[self.place]
            self.cost += 2
            self.audit.append("I")
            self._write([f"{ROLES[self.place]}:"])
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        return (self.conv, gaps, *self.faults, self.cost, "".join(self.audit), self.sha.hexdigest())


def repair_digests(conversations: DataFrame) -> DataFrame:
    """Per conversation, damaged and repaired: faults, cost, initials of the edits and a digest of the result."""
    bound_batches(conversations.sparkSession)
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    repaired = repair_conversations(damaged(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if digest is None or row["conv_id"] != digest.conv:
                    if digest is not None:
                        out.append(digest.row())
                    digest = _Digest(row["conv_id"])
                digest.add(row)
            yield _arrow(out, DIGESTS)
        if digest is not None:
            yield _arrow([digest.row()], DIGESTS)

    numbers = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'bigint'}" for f in DIGESTS)
    return _in_order(repaired, F.col("block")).mapInArrow(run, numbers)


def repair_sql() -> str:
    """The same rows in SQL: forward over the rows of a conversation, the best edits to each place so far."""

    def edit(state: str, cost: str, letter: str, line: str | None = None) -> str:
        lines = f"list_append(({state}).t, {line})" if line else f"({state}).t"
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': ({state}).c + {cost}, 'a': ({state}).a || '{letter}', 't': {lines}}} END"

    def least(*found: str) -> str:
        return f"list_min([{', '.join(found)}])"

    def kept(state: str, initial: str) -> str:
        return f"CASE WHEN NOT forced AND initial = '{initial}' THEN {edit(state, 'extra', 'K', 'role || chr(58) || text')} END"

    def given(state: str, role: str) -> str:
        return f"CASE WHEN NOT forced THEN {edit(state, '2 + extra', 'R', f"'{role}:' || text")} END"

    user = least("u", *(edit(s, "2", "I", "'user:'") for s in ("n", "s", "a")))
    assistant = least("a", edit("u2", "2", "I", "'assistant:'"))

    def filled(rows: str) -> str:
        return f"SELECT *, {assistant} AS a2 FROM (SELECT *, {user} AS u2 FROM ({rows}))"

    none = "CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR[]))"
    return rf"""
WITH RECURSIVE hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda ch: ascii(ch)::BIGINT),
    lambda crc, ch: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, ch)),
    4294967295), 4294967295) % 20 AS fault FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hashed, range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) copies(k)
), marked AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut_off
  FROM damaged
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS i FROM marked
), r AS (
  SELECT conv_id, i, turn, role, text, substr(role, 1, 1) AS initial, blank, NOT blank AND again AS duplicate,
    NOT blank AND NOT again AND cut_off AS truncated, blank OR again AS forced,
    CAST(NOT blank AND NOT again AND cut_off AS INTEGER) AS extra,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS earlier
  FROM placed
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
    count_if(duplicate) AS duplicate, count_if(truncated) AS truncated,
    count_if(i > 1 AND (earlier || initial) NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM r GROUP BY conv_id
), ids AS (SELECT DISTINCT conv_id FROM conversations),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, CAST({{'c': 0, 'a': '', 't': []}} AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR[])) AS n,
    {none} AS s, {none} AS u, {none} AS a FROM ids
  UNION ALL
  SELECT conv_id, i, {edit("n", "3", "D")} AS n, {least(edit("s", "3", "D"), kept("n", "s"))} AS s,
    {least(edit("u2", "3", "D"), *(kept(x, "u") for x in ("n", "s", "a2")), *(given(x, "user") for x in ("n", "s", "a2")))} AS u,
    {least(edit("a2", "3", "D"), kept("u2", "a"), given("u2", "assistant"))} AS a
  FROM ({filled("SELECT r.*, w.n, w.s, w.u, w.a FROM walk w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1")})
), best AS (
  SELECT conv_id, {least("n", "a2")} AS b FROM ({filled("SELECT walk.* FROM walk LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM walk.conv_id WHERE walk.i = coalesce(c.n, 0)")})
)
SELECT best.conv_id, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal"))},
  b.c AS cost, b.a AS audit,
  sha256(array_to_string(b.t, chr(10))) AS repaired_sha256
FROM best LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM best.conv_id"""
