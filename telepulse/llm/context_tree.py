"""LM scoring by context-tree weighting over bytes (operator 1).

A byte is eight binary decisions, so each context of 0 to ``DEPTH`` bytes holds
a binary tree of 255 counters. A counter's block probability is the
Krichevsky-Trofimov estimate of its zeros and ones; from the longest contexts
down, a context weighs its own estimate against the product of its extensions.
Those weights, frozen after training, mix the estimates of all depths for each
decision; a context that training has not seen leaves the weight to the longest
one that it has. Texts end with the byte 0xFF, which no UTF-8 text has, and
begin after a run of it.

Documents are dealt to blocks of about ``BLOCK_BYTES``. A block counts its
distinct grams (context and byte) with a trie built level by level, so counts
are combined before anything is shuffled. The tree is one table a depth; the
mixed price of each gram goes back to the blocks that have it, and a block
prices its texts by the same trie. Nothing of the corpus passes the driver or is
broadcast. Word counts for the base score travel the same way.

Defined results: a null or empty text is its end alone; repeated rows each
count; rows with a null id are trained on (their checksum is that of the empty
text); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telepulse.llm.shingles import word_hashes
from telepulse.llm.tables import bound_batches, byte_lengths, saved

DEPTH = 4
BLOCK_BYTES = 12 << 20
SLICE = 1 << 18  # places of a block that are numbered at once
PART_BYTES = 1 << 20  # words are hashed in parts of a block
END = 0xFF


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


class Ranks:
    """Numbers the marked ones of ``size`` values from 0, in a bit each and a count for every 64."""

    def __init__(self, size: int):
        self.seen = np.zeros(-(-size // 64) * 64, bool)

    def mark(self, values: np.ndarray) -> None:
        self.seen[values] = True

    def found(self) -> np.ndarray:
        """The marked values in ascending order; nothing is marked after this."""
        found = np.flatnonzero(self.seen)
        self.bits = np.packbits(self.seen, bitorder="little").view("<u8")
        del self.seen
        ones = np.bitwise_count(self.bits)
        self.before = np.cumsum(ones, dtype=np.int32) - ones
        return found

    def of(self, values: np.ndarray) -> np.ndarray:
        word = values >> 6
        lower = (np.uint64(1) << (values & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.bits[word] & lower)


class Trie:
    """Numbers, in lexicographic order, the distinct (DEPTH + 1)-grams of texts, for every place of a text.

    It holds a byte and a number for each place; all else is made for ``SLICE`` places at a time.
    """

    def __init__(self, texts: pa.ChunkedArray):
        sizes = byte_lengths(texts)
        self.lengths = sizes + 1
        # a gram ends at each byte but those of the run before a text
        data = np.full(int(self.lengths.sum()) + DEPTH * len(sizes), END, np.uint8)
        self.ends = np.cumsum(self.lengths + DEPTH)
        self.starts = self.ends - self.lengths
        at = 0
        for chunk in texts.chunks:
            for text in chunk:
                if sizes[at]:
                    data[self.starts[at] : self.ends[at] - 1] = np.frombuffer(text.as_buffer(), np.uint8)
                at += 1
        seen = np.zeros(256, bool)
        for a in range(0, len(data), SLICE):
            seen[data[a : a + SLICE]] = True
        present = np.flatnonzero(seen)
        letter = np.zeros(256, np.uint8)
        letter[present] = np.arange(len(present))
        for a in range(0, len(data), SLICE):
            data[a : a + SLICE] = letter[data[a : a + SLICE]]
        # the number of the gram that ends at a place grows by one byte a level; at last, none ends in the run before a text
        number = np.zeros(len(data), np.int32)
        number[DEPTH:] = data[: len(data) - DEPTH]
        grams = present.astype(np.uint64)
        for level in range(DEPTH - 1, -1, -1):
            size = len(grams) * len(present)
            number = number.astype(np.int32 if size < 1 << 31 else np.int64, copy=False)
            ranks = Ranks(size)
            for a in range(DEPTH, len(data), SLICE):
                b = min(a + SLICE, len(data))
                step = number[a:b]
                step *= len(present)
                step += data[a - level : b - level]
                ranks.mark(step if level else step[self._kept(a, b)])
            found = ranks.found()
            for a in range(DEPTH, len(data), SLICE):
                number[a : a + SLICE] = ranks.of(number[a : a + SLICE])
            grams = (grams[found // len(present)] << np.uint64(8)) | present[found % len(present)].astype(np.uint64)
        self.number, self.grams = number, grams

    def _slices(self) -> Iterator[tuple[np.ndarray, int, int, np.ndarray]]:
        """The numbers at the places of texts, ``SLICE`` places at a time, with the first text that they are of, the one
        after the last, and how many each has."""
        for a in range(DEPTH, len(self.number), SLICE):
            b = min(a + SLICE, len(self.number))
            first, stop = self._owners(a, b)
            if first < stop:
                sizes = np.minimum(self.ends[first:stop], b) - np.maximum(self.starts[first:stop], a)
                yield self.number[a:b][self._kept(a, b)], first, stop, sizes

    def _owners(self, a: int, b: int) -> tuple[int, int]:
        """The texts that have places from ``a`` to before ``b``."""
        return int(np.searchsorted(self.ends, a, "right")), int(np.searchsorted(self.starts, b, "left"))

    def _kept(self, a: int, b: int) -> np.ndarray:
        """Which places from ``a`` to before ``b`` are of texts."""
        first, stop = self._owners(a, b)
        change = np.zeros(b - a + 1, np.int8)
        change[np.maximum(self.starts[first:stop], a) - a] = 1
        change[np.minimum(self.ends[first:stop], b) - a] = -1
        return np.cumsum(change[:-1], dtype=np.int8).view(bool)

    def counts(self, trained: np.ndarray) -> np.ndarray:
        """How often each gram ends in the texts that are trained on."""
        total = np.zeros(len(self.grams), np.int64)
        for number, first, stop, sizes in self._slices():
            np.add.at(total, number[np.repeat(trained[first:stop], sizes)], 1)
        return total

    def sums(self, price: np.ndarray) -> np.ndarray:
        """Sum over each text of the prices of its grams."""
        total = np.zeros(len(self.lengths))
        for number, first, stop, sizes in self._slices():
            total[first:stop] += np.add.reduceat(price[number], np.cumsum(sizes) - sizes)
        return total


def _log_gamma(x: Column) -> Column:
    """ln of the gamma function for x > 0, by Stirling's series at x + 8."""
    y, product = x + 8, x
    for k in range(1, 8):
        product = product * (x + k)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def block_estimate(zeros: Column, ones: Column) -> Column:
    """ln of the Krichevsky-Trofimov probability of a block with so many zeros and ones."""
    a, b = zeros.cast("double"), ones.cast("double")
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1) - math.log(math.pi)


def _shorter(context: Column, depth: int) -> Column:
    """The context without its oldest byte: the last ``depth`` bytes of it."""
    return context.bitwiseAND(F.lit((1 << 8 * depth) - 1))


def tree(grams: DataFrame) -> list[DataFrame]:
    """Counters of every depth, the longest contexts last: context, node, zeros, ones, own (ln of the block estimate) and
    weighted (ln of the weighted probability). ``grams``: gram (a long of DEPTH + 1 bytes), n."""
    power = lambda k: F.pow(F.lit(2), k).cast("int")
    bits = F.transform(
        F.sequence(F.lit(0), F.lit(7)),
        lambda k: F.struct(
            (power(k) + F.floor(F.col("byte") / power(8 - k)).cast("int")).alias("node"),
            (F.floor(F.col("byte") / power(7 - k)).cast("int") % 2).alias("bit"),
        ),
    )
    spread = grams.select(
        F.shiftright("gram", 8).alias("context"), F.col("gram").bitwiseAND(F.lit(255)).cast("int").alias("byte"), "n"
    ).select("context", "n", F.explode(bits).alias("at"))
    one = F.col("at.bit")
    counted = spread.groupBy("context", F.col("at.node").alias("node")).agg(
        F.sum(F.col("n") * (1 - one)).alias("zeros"), F.sum(F.col("n") * one).alias("ones")
    )
    own = block_estimate(F.col("zeros"), F.col("ones"))
    levels = [saved(counted.withColumn("own", own).withColumn("weighted", F.col("own")), "context-level")]
    for depth in range(DEPTH - 1, -1, -1):
        summed = (
            levels[-1]
            .groupBy(_shorter(F.col("context"), depth).alias("context"), "node")
            .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("split"))
        )
        best = F.greatest("own", "split")
        mean = best + F.log(F.exp(F.col("own") - best) + F.exp(F.col("split") - best)) - math.log(2)
        levels.append(saved(summed.withColumn("own", own).withColumn("weighted", mean), "context-level"))
    return levels[::-1]


def prices(levels: list[DataFrame]) -> DataFrame:
    """context, node, zero and one: log10 of the mixed probability of each decision in the longest contexts."""
    half = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
    stay = F.exp(F.col("own") - math.log(2) - F.col("weighted"))  # posterior weight of this depth over all longer ones
    # done: share of ones from shorter depths; left: weight that goes on; p: probability of a one if it ends here
    top = levels[0].select(
        "context",
        "node",
        (stay * half).alias("done"),
        (1 - stay).alias("left"),
        half.alias("p"),
    )
    above = top
    for depth in range(1, DEPTH + 1):
        here = levels[depth].select(
            F.col("context").alias("longer"), _shorter(F.col("context"), depth - 1).alias("context"), "node",
            (F.col("zeros") + F.col("ones") > 0).alias("seen"), half.alias("half"),
            F.when(F.lit(depth == DEPTH), F.lit(1.0)).otherwise(stay).alias("stay"),
        )
        joined = here.join(above, ["context", "node"])
        p = F.when(F.col("seen"), F.col("done") + F.col("left") * F.col("half")).otherwise(F.col("p"))
        above = joined.select(
            F.col("longer").alias("context"),
            "node",
            (F.col("done") + F.col("left") * F.col("stay") * F.col("half")).alias("done"),
            (F.col("left") * (1 - F.col("stay"))).alias("left"),
            p.alias("p"),
        )
        if depth < DEPTH:
            above = saved(above, "context-above")
    return above.select("context", "node", F.log10(1 - F.col("p")).alias("zero"), F.log10("p").alias("one"))


def gram_prices(grams: DataFrame, priced: DataFrame, rows: int = 200_000) -> DataFrame:
    """gram, price: log10 of the probability of the last byte after the others. Contexts are dealt to buckets of about
    ``rows`` grams; a bucket is priced at once."""
    buckets = max(1, math.ceil(grams.count() / rows))

    def price(grams: pd.DataFrame, priced: pd.DataFrame) -> pd.DataFrame:
        order = priced["context"].to_numpy() * 256 + priced["node"].to_numpy()
        at = np.argsort(order)
        order, both = order[at], np.stack([priced["zero"].to_numpy()[at], priced["one"].to_numpy()[at]])
        gram = grams["gram"].to_numpy()
        context, byte, total = gram >> 8, gram & 255, np.zeros(len(gram))
        for k in range(8):
            node = (1 << k) | (byte >> (8 - k))
            total += both[(byte >> (7 - k)) & 1, np.searchsorted(order, context * 256 + node)]
        return pd.DataFrame({"gram": gram, "price": total})

    a = grams.select("gram", F.pmod(F.xxhash64(F.shiftright("gram", 8)), F.lit(buckets)).alias("bucket"))
    b = priced.withColumn("bucket_of", F.pmod(F.xxhash64("context"), F.lit(buckets)))
    return a.groupBy("bucket").cogroup(b.groupBy("bucket_of")).applyInPandas(price, "gram bigint, price double")


def _tokens(texts: pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of the words of texts, and the text of each, by parts of about ``PART_BYTES``. They are negative 64-bit
    hashes; keys of grams are not."""
    ends = np.cumsum(byte_lengths(texts))
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + PART_BYTES, "right")))
        words, begins = word_hashes(texts.slice(at, stop - at).to_pylist())
        yield (words | np.uint64(1 << 63)).view(np.int64), np.repeat(np.arange(at, stop), np.diff(begins))
        at = stop


def _count_words(texts: pa.ChunkedArray, trained: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of words in ascending order, and how often each occurs in the texts that are trained on."""
    names, times = [np.zeros(0, np.int64)], [np.zeros(0)]
    for words, owner in _tokens(texts):
        name, place = np.unique(words, return_inverse=True)
        names.append(name)
        times.append(np.bincount(place, weights=trained[owner], minlength=len(name)))
    name, place = np.unique(np.concatenate(names), return_inverse=True)
    return name, np.bincount(place, weights=np.concatenate(times), minlength=len(name)).astype(np.int64)


def _count_block(table: pa.Table) -> pa.Table:
    texts, trained = table.column("text"), ~table.column("held_out").to_numpy()
    trie = Trie(texts)
    grams, n = trie.grams.view(np.int64), trie.counts(trained)
    del trie  # the words need its memory
    names, times = _count_words(texts, trained)
    keys = np.concatenate([grams, names])
    return pa.table(
        {
            "block": np.full(len(keys), table.column("block")[0].as_py(), np.int64),
            "key": keys,
            "n": np.concatenate([n, times]),
        }
    )


def _score_block(end_price: float, end_known: bool, unknown_price: float, total: int):
    def score(docs: pa.Table, prices: pa.Table) -> pa.Table:
        texts, n = docs.column("text"), docs.num_rows
        key, price = prices.column("key").to_numpy(), prices.column("price").to_numpy()
        order = np.argsort(key)
        key, price = key[order], price[order]
        grams = np.searchsorted(key, 0)  # words before, grams from here
        trie = Trie(texts)
        if not np.array_equal(key[grams:], trie.grams.view(np.int64)):
            raise ValueError("the prices of a block are not those of its grams")
        scores, n_bytes = trie.sums(price[grams:]), trie.lengths - 1
        del trie  # the words need its memory
        n_tokens, n_known, base = np.ones(n, np.int64), np.full(n, int(end_known), np.int64), np.full(n, end_price)
        for words, owner in _tokens(texts):
            paid = price[np.searchsorted(key[:grams], words)]
            n_tokens += np.bincount(owner, minlength=n)
            n_known += np.bincount(owner[paid > unknown_price], minlength=n)
            base += np.bincount(owner, weights=paid, minlength=n)
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "held_out": docs.column("held_out"),
                "n_tokens": n_tokens,
                "n_known": n_known,
                "train_tokens": np.full(n, total, np.int64),
                "base_score": base,
                "score": scores,
                "n_bytes": n_bytes,
            }
        )

    return score


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base score and model score (log10 of the text's probability) of every whole text, and its bits per byte, end included."""
    bound_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    ).withColumn("held_out", held_out(F.col("doc_id")))
    sizes = rows.agg(F.sum(F.octet_length("text") + 1), F.sum((~F.col("held_out")).cast("long"))).first()
    blocks, ends = max(1, math.ceil((sizes[0] or 0) / BLOCK_BYTES)), sizes[1] or 0
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    counts = saved(
        dealt.groupBy("block").applyInArrow(_count_block, "block bigint, key bigint, n bigint"), "context-counts"
    )
    grams = saved(
        counts.where("key >= 0").groupBy(F.col("key").alias("gram")).agg(F.sum("n").alias("n")), "context-grams"
    )
    words = saved(counts.where("key < 0").groupBy("key").agg(F.sum("n").alias("c")), "context-words")
    seen = words.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, distinct = seen[0] + ends, seen[1] + int(ends > 0)

    def base(c):
        return F.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))

    end_price = math.log10((ends + 0.5) / (total + 0.5 * (distinct + 1)))
    # a word that training has not seen has a price of its own; half a count parts it from the others
    unknown_price = math.log10(0.75 / (total + 0.5 * (distinct + 1)))
    priced = gram_prices(grams, prices(tree(grams))).withColumnRenamed("gram", "key")
    priced = priced.union(words.select("key", base(F.col("c"))))
    sent = counts.select(F.col("block").alias("of_block"), "key").join(priced, "key")
    scored = (
        dealt.groupBy("block")
        .cogroup(sent.groupBy("of_block"))
        .applyInArrow(
            _score_block(end_price, ends > 0, unknown_price, total),
            "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
            "score double, n_bytes bigint",
        )
    )
    bits = F.col("score") * (-math.log2(10)) / (F.col("n_bytes") + 1)
    return scored.withColumn("bits_per_byte", bits)
