"""Phrase collocation mining by HAT-trie counting (operator 12).

A phrase is counted under a 64-bit key: a byte of the id (hash) of its first
word, one of its second word's, and 48 bits of a hash of all. A task counts in a
HAT-trie: a shallow trie over the two bytes of word ids, whose leaves are
containers of hashed phrases with counts; a container that grows too large
bursts into a node. A trie that reaches its limit spills its largest subtrees
as sorted runs. Spark deals the runs by prefix (both word bytes) and merges them
there.

A phrase can reach the least count only if its parts do, so words are counted
first, then pairs of words that may be frequent, then longer phrases whose pairs
all may be. That is asked of Bloom filters, which let some others pass but never
stop one. A filter has 16 bits for a key that reached the count, and
``FILTER_BITS`` (16 MB) at most; beyond that it lets more pass and results stay
the same. Filters are all that is sent to every task. Keys that collide only add
to what may be frequent: a last pass counts those phrases by their own text.
(Within one chunk of text, equal keys are taken for equal phrases.)

Scores are exact: products are 38-digit decimals, divided as whole numbers. A
phrase is dropped for a longer one if it is for one that is a word longer, so
each length is compared with the next one only.

Defined results: a null text is empty, a null language ``und``; repeated rows
and rows without an id count as texts; a text of any length is read in chunks
that share their edges; ties in score and count are in order of the phrase's
bytes; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from telepulse.llm.shingles import BYTES, ROUND, mixed
from telepulse.llm.tables import bound_batches, saved, slices

LONGEST, LEAST, TOP, PERCENT = 5, 100, 2000, 100
BURST, LIMIT, TEXTS, BUCKET = 16_384, 2_000_000, 200_000, 10_000
CHUNK = 2 << 20
FILTER_BITS, PLACES = 1 << 27, 3
DIGITS = 2  # bytes of word ids that the trie branches on

# A-Z in lower case, tabs as blanks, what ends a piece as a line feed
LETTERS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 10)
BLANK, END = 0x20, 0x0A


class Words:
    """The words of a stretch of text: their places, the pieces they are in, and hashes."""

    def __init__(self, data: bytes) -> None:
        self.data = data
        letters = np.frombuffer(data, np.uint8)
        solid = (letters != BLANK) & (letters != END)
        edge = np.diff(solid.view(np.int8), prepend=0, append=0)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.cumsum(letters == END, dtype=np.int32)[self.start]
        self.hash = np.zeros(0, np.uint64)
        self.fine: dict[int, np.ndarray] = {}  # which runs of one and of two words may be frequent
        if len(self.start):
            length = self.end - self.start
            first = np.concatenate([[0], np.cumsum(length)[:-1]])
            place = np.arange(int(length.sum())) - np.repeat(first, length)
            powers = np.cumprod(np.full(int(length.max()), ROUND, np.uint64))
            sums = np.add.reduceat(BYTES[letters[solid]] * powers[place], first)
            self.hash = mixed(sums ^ length.astype(np.uint64))

    def keys(self, size: int, lang: np.uint64) -> np.ndarray:
        """Keys of all runs of ``size`` words, whether they are in one piece or not."""
        n = max(0, len(self.hash) - size + 1)
        total = np.full(n, lang + np.uint64(size), np.uint64)
        for k in range(size):
            total += self.hash[k : k + n] * (mixed(np.array([k + 1], np.uint64)) | np.uint64(1))
        first, second = self.hash[:n] >> np.uint64(56), self.hash[min(1, size - 1) :][:n] >> np.uint64(48) & np.uint64(255)
        return first << np.uint64(56) | second << np.uint64(48) | mixed(total) >> np.uint64(16)

    def whole(self, size: int, known: int) -> np.ndarray:
        """Which runs lie in one piece and end behind the first ``known`` words."""
        n = max(0, len(self.hash) - size + 1)
        return (self.piece[:n] == self.piece[size - 1 :][:n]) & (np.arange(n) >= known - size + 1)

    def text(self, at: int, size: int) -> str:
        return b" ".join(self.data[self.start[at] : self.end[at + size - 1]].split()).decode()


def chunks(data: bytes, shared: int) -> Iterator[tuple[Words, int]]:
    """Stretches of a text that end between words; each starts with the last ``shared`` words of the one before, if there
    are as many, and says how many those are."""
    begin, at, known = 0, 0, 0
    while at < len(data):
        stop = len(data)
        if stop - at > CHUNK:
            ends = [e for e in (data.find(b" ", at + CHUNK), data.find(b"\n", at + CHUNK)) if e >= 0]
            stop = min(ends) + 1 if ends else stop
        words = Words(data[begin:stop])
        yield words, known
        known = min(shared, len(words.start))
        begin, at = (begin + int(words.start[-known]) if known else stop), stop


class Container:
    """Keys with counts; what is added waits until it is as much as what is there."""

    def __init__(self) -> None:
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size > 2 * len(self.keys) + 256:
            self.combine()

    def combine(self) -> None:
        if self.waiting:
            keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
            counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            self.keys, self.counts, self.waiting = keys[first], np.add.reduceat(counts[order], first), []
            self.size = len(self.keys)


class Node(dict):
    """Nodes or containers by the next byte."""


class HatTrie:
    def __init__(self) -> None:
        self.root, self.size = Node(), 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Keys in their order."""
        self._add(self.root, keys, counts, 0)

    def _add(self, node: Node, keys: np.ndarray, counts: np.ndarray, depth: int) -> None:
        if not len(keys):
            return
        digits = keys >> np.uint64(56 - 8 * depth) & np.uint64(255)
        starts = np.flatnonzero(np.concatenate([[True], digits[1:] != digits[:-1]])).tolist()
        for digit, a, b in zip(digits[starts].tolist(), starts, [*starts[1:], len(keys)], strict=True):
            child = node.get(digit)
            if isinstance(child, Node):
                self._add(child, keys[a:b], counts[a:b], depth + 1)
                continue
            if child is None:
                child = node[digit] = Container()
            before = child.size
            child.add(keys[a:b], counts[a:b])
            self.size += child.size - before
            if child.size > BURST and depth + 1 < DIGITS:
                self.size -= child.size
                child.combine()
                node[digit] = Node()
                self._add(node[digit], child.keys, child.counts, depth + 1)

    def spill(self, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take the largest subtrees out until ``keep`` keys are left, each as a sorted run."""
        for size, digit in sorted(((_size(child), digit) for digit, child in self.root.items()), reverse=True):
            if self.size <= keep:
                break
            self.size -= size
            found = list(_containers(self.root.pop(digit)))
            for container in found:
                container.combine()
            yield np.concatenate([c.keys for c in found]), np.concatenate([c.counts for c in found])


def _size(tree: Node | Container) -> int:
    return tree.size if isinstance(tree, Container) else sum(map(_size, tree.values()))


def _containers(tree: Node | Container) -> Iterator[Container]:
    """In the order of their keys."""
    if isinstance(tree, Container):
        yield tree
    else:
        for digit in sorted(tree):
            yield from _containers(tree[digit])


class Filter:
    """A Bloom filter over keys."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits  # as 64-bit numbers

    def holds(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for place in places(keys, len(self.bits) * 64):
            found &= (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return found


def places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    return [mixed(keys + np.uint64(k + 1)) & np.uint64(bits - 1) for k in range(PLACES)]


def key_filter(keys: DataFrame) -> Filter:
    """The filter of a table (key); each of its numbers is one row at most on its way to the driver."""
    bits = min(FILTER_BITS, 1 << max(16, (16 * keys.count() - 1).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(places(batch.column("key").to_numpy().view(np.uint64), bits))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((at >> np.uint64(6)).astype(np.int32)),
                    pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64)),
                ],
                names=["slot", "mask"],
            )

    slots = keys.select("key").mapInArrow(run, "slot int, mask bigint").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    found = np.zeros(bits // 64, np.uint64)
    found[slots.column("slot").to_numpy()] = slots.column("mask").to_numpy().view(np.uint64)
    return Filter(found)


def possible(words: Words, known: int, size: int, lang: np.uint64, filters: list[Filter]) -> np.ndarray:
    """Which runs of ``size`` words may be frequent: pairs by their words, longer ones by their pairs."""
    found = words.whole(size, known)
    parts = min(size - 1, 2)
    if parts:
        if parts not in words.fine:
            words.fine[parts] = filters[parts - 1].holds(words.keys(parts, lang))
        for k in range(size - parts + 1):
            found &= words.fine[parts][k : k + len(found)]
    return found


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.uint64, bytes]]:
    """Language, its number, and texts with line feeds between them, ready to be cut into words."""
    for batch in slices(batches, "text"):
        texts = defaultdict(list)
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            texts[lang].append(text.encode())
        for lang, found in texts.items():
            yield lang, np.uint64(xxhash.xxh3_64_intdigest(lang.encode())), (b"\n".join(found) + b"\n").translate(LETTERS)


def count_keys(rows: DataFrame, sizes: list[int], filters: list[Filter]) -> DataFrame:
    """key, f of the phrases of these sizes (lang, text), of those that may be frequent by the filters of words and pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = HatTrie()

        def spilled(keep: int) -> Iterator[pa.RecordBatch]:
            for keys, counts in trie.spill(keep):
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["key", "f"])

        for _, lang, data in _texts(batches):
            for words, known in chunks(data, max(sizes) - 1):
                for size in sizes:
                    keys = words.keys(size, lang)[possible(words, known, size, lang, filters)]
                    trie.add(*np.unique(keys, return_counts=True))
                    if trie.size > LIMIT:
                        yield from spilled(LIMIT // 2)
        yield from spilled(0)

    prefix = F.shiftrightunsigned("key", 64 - 8 * DIGITS)
    runs = rows.mapInArrow(run, "key bigint, f bigint").withColumn("prefix", prefix)
    return runs.repartition("prefix").groupBy("prefix", "key").agg(F.sum("f").alias("f")).drop("prefix")


RUN = pa.schema(
    [
        ("bucket", pa.int32()),
        ("lang", pa.string()),
        ("words", pa.int32()),
        ("phrases", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
    ]
)


def count_texts(rows: DataFrame, longest: int, filters: list[Filter], least: int, buckets: int) -> DataFrame:
    """lang, words, phrase, f of the phrases that are found ``least`` times, of those that the filters of words, pairs and
    longer ones hold; and all words of a language under a null phrase.

    A task's counts leave it as sorted runs, one row for each language, length and bucket of prefixes (first two words).
    A bucket's runs are merged in one task; there are as many buckets as keep each to about ``BUCKET`` phrases.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = defaultdict(int)
        names: dict[tuple[str, int], dict[int, str]] = defaultdict(dict)
        counts: dict[tuple[str, int], dict[int, int]] = defaultdict(dict)
        held = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for (lang, size), found in counts.items():
                dealt: dict[int, list[tuple[str, int]]] = defaultdict(list)
                for key, n in found.items():
                    phrase = names[lang, size][key]
                    prefix = " ".join(phrase.split(" ", 2)[:2])
                    dealt[xxhash.xxh3_64_intdigest(f"{lang} {prefix}".encode()) % buckets].append((phrase, n))
                for bucket, run in dealt.items():
                    run.sort()
                    yield _run(bucket, lang, size, *zip(*run, strict=True))
            names.clear()
            counts.clear()

        for name, lang, data in _texts(batches):
            for words, known in chunks(data, longest - 1):
                total[name] += len(words.start) - known
                for size in range(1, longest + 1):
                    at = np.flatnonzero(possible(words, known, size, lang, filters))
                    keys = words.keys(size, lang)[at]
                    fine = filters[min(size, len(filters)) - 1].holds(keys)
                    keys, first, n = np.unique(keys[fine], return_index=True, return_counts=True)
                    at = at[fine][first]
                    spelled, found = names[name, size], counts[name, size]
                    for key, place, count in zip(keys.tolist(), at.tolist(), n.tolist(), strict=True):
                        if key in found:
                            found[key] += count
                        else:
                            found[key], spelled[key] = count, words.text(place, size)
                            held += 1
                    if held > TEXTS:
                        yield from flushed()
                        held = 0
        yield from flushed()
        for name, n in total.items():
            yield _run(xxhash.xxh3_64_intdigest(name.encode()) % buckets, name, 1, [None], [n])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, found = None, {}

        def frequent() -> pa.RecordBatch:
            kept = [(*key, n) for key, n in found.items() if n >= least or key[2] is None]
            columns = list(zip(*kept, strict=True)) or [[]] * 4
            kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "words", "phrase", "f"]
            )

        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    yield frequent()
                    bucket, found = row["bucket"], {}
                for phrase, n in zip(row["phrases"], row["counts"], strict=True):
                    key = (row["lang"], row["words"], phrase)
                    found[key] = found.get(key, 0) + n
        yield frequent()

    kind = "bucket int, lang string, words int, phrases array<string>, counts array<bigint>"
    dealt = rows.mapInArrow(runs, kind).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(merged, "lang string, words int, phrase string, f bigint")


def _run(bucket: int, lang: str, size: int, phrases, counts) -> pa.RecordBatch:
    columns = [[bucket], [lang], [size], [list(phrases)], [list(counts)]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RUN, strict=True)], schema=RUN)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, words (1 to ``longest``), phrase, f of all phrases found ``least`` times, and the words of a language under a null phrase."""
    bound_batches(docs.sparkSession)
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).where("text <> ''")
    filters, n = [], 0
    for sizes in ([1], [2], list(range(3, longest + 1))):
        if sizes and sizes[-1] <= longest:
            counted = saved(count_keys(rows, sizes, filters).where(F.col("f") >= least).select("key"), f"phrases-{sizes[0]}")
            filters.append(key_filter(counted))
            n += counted.count()
    return saved(count_texts(rows, longest, filters, least, 1 + n // BUCKET), "phrases")


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    top: int = TOP,
    percent: int = PERCENT,
    longest: int = LONGEST,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    found = frequent_phrases(docs, least, longest, text_col, lang_col)
    phrases = found.where("phrase IS NOT NULL")
    n = found.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    words = F.split("phrase", " ")
    candidates = phrases.where("words > 1").withColumn("w", words)
    without = lambda start: F.array_join(F.slice("w", start, F.size("w") - 1), " ")
    held = (
        candidates.where("words > 2")
        .select("lang", "f", F.explode(F.array(without(1), without(2))).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer"))
    )
    free = candidates.join(held, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(22,0)") * 100 < F.col("f").cast("decimal(22,0)") * percent)
    )
    cut = free.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang",
        "phrase",
        F.col("f").alias("a"),
        "k",
        F.array_join(F.slice("w", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("words")), " ").alias("right"),
    )
    of = lambda part, f: phrases.select("lang", F.col("phrase").alias(part), F.col("f").alias(f))
    whole = cut.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"]).join(n, "lang")
    number = lambda c: f"cast({c} as decimal(19,0))"
    score = F.expr(f"cast(({number('a')} * {number('n')} * 1000) div ({number('l')} * {number('r')}) as bigint)")
    worst = whole.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = worst.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations_sql(least: int = LEAST, top: int = TOP, percent: int = PERCENT, longest: int = LONGEST) -> str:
    """The same rows in SQL, counting every phrase."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), ws AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
grams AS (
  SELECT lang, k AS words, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM ws, range(1, {longest + 1}) t(k) WHERE len(ws) >= k
), f AS (SELECT lang, words, phrase, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= {least}),
inside AS (
  SELECT DISTINCT s.lang, s.phrase FROM c s JOIN (
    SELECT lang, a, array_to_string(w[i:i + k - 1], ' ') AS part FROM c, range(2, {longest}) t(k), range(1, {longest}) u(i)
    WHERE k < words AND i + k - 1 <= words
  ) b ON b.lang = s.lang AND b.part = s.phrase AND 100 * b.a >= {percent} * s.a
), cuts AS (
  SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r, n,
    CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM c JOIN range(1, {longest}) t(k) ON k < c.words
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:c.words], ' ')
  JOIN n ON n.lang = c.lang
  WHERE NOT EXISTS (SELECT 1 FROM inside WHERE inside.lang = c.lang AND inside.phrase = c.phrase)
), worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM worst QUALIFY rank <= {top}"""
