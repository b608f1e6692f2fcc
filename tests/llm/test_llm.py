"""The operators of ``telepulse.llm`` against brute force, libraries and edge cases."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from telepulse.llm import (
    bpe,
    chat,
    context_tree,
    cotraining,
    fingerprints,
    mixing,
    partition_index,
    pii,
    queries,
    setsketch,
    token_counts,
    views,
)
from telepulse.llm.pretokens import vocabulary

FILE = public_tokenizers.path("byte_bpe_50k.json")
SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001").rstrip("/")
TABLES = os.path.dirname(SMALL)  # of all sizes
TEXTS = [None, "", " ", "a", "the  cat\n's", "<|endoftext|>x", "é😀 ß", "The cat sat on the mat. " * 3, "word " * 9000, "z" * 3000]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns with the operators' own names."""
    rows = [(i, t, "en", None, 1.0, "x") for i, t in enumerate(TEXTS)] + [(None, "a", None, "s", None, None), (3, "a", "en", None, 1.0, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double, node string")


def _random_texts(n, seed):
    rng = random.Random(seed)
    parts = ["a", "the", "'s", "'re", "'", " ", "  ", "\n", "1", "é", "中", "😀", "!", "<|endoftext|>", " ", "tion", "\x1c", "\t", "_", " 's"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(n)]


def test_bpe_equals_the_library(tokenizer):
    texts = _random_texts(3000, 1) + [t or "" for t in TEXTS] + ["ab" * 400 + "!" * 300]
    encoder = bpe.Encoder(FILE)
    found, wanted = encoder.encode(texts), tokenizer.encode_batch(texts, add_special_tokens=False)
    for text, ids, code in zip(texts, found, wanted, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == code.ids, text
        assert encoder.decode(ids) == tokenizer.decode(code.ids, skip_special_tokens=False)


def test_long_and_short_trees_agree():
    vocab = vocabulary(FILE)
    words = [w.encode() for w in ("international", "zzzzzz", "a", "unbelievably", "thth" * 20)]
    assert bpe.encode_words(words, vocab) == [bpe.encode_long(w, vocab) for w in words]


def test_token_counts_equal_the_library(tokenizer):
    texts = _random_texts(3000, 2) + [t or "" for t in TEXTS]
    machine = token_counts.Transducer(vocabulary(FILE))
    found = token_counts.count_tokens(texts, machine)
    assert found.tolist() == [len(c.ids) for c in tokenizer.encode_batch(texts, add_special_tokens=False)]
    machine.reset()
    assert token_counts.count_tokens(texts[:50], machine).tolist() == found[:50].tolist()


def test_token_and_bpe_frames(odd_docs, tokenizer):
    counts = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(odd_docs).collect())
    rows = [(r.doc_id or -1, r.text or "") for r in odd_docs.collect()]
    wanted = sorted((i, len(t.encode()), n := len(tokenizer.encode(t).ids), n > 1024) for i, t in rows)
    assert counts == wanted
    coded = bpe.bpe_digests(odd_docs).collect()
    assert sorted(r.decoded_sha256 for r in coded) == sorted(hashlib.sha256(t.encode()).hexdigest() for _, t in rows)


# Patterns of the base spans, as they are defined.
BASE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def _base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE_PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and _luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def test_pii_equals_brute_force(spark):
    rng = random.Random(3)
    parts = [
        "a@b.c", "@", "._%", "4111111111111111", "4111 1111-1111 1111", "1.2.3.4", "256.1.1.1", "00.0001.2.255", ".", "23", " ", "-",
        "+1 (017) 555-7713", "+", "(5)", "é", "😀", "x.y@q-r.com.de_z@k.l", "DE89 3704 0044 0532 0130 00", "\n", "ssn 123-45-6789", "0",
    ]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(1500)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pii.find_pii(df).collect():
        spans = _base_spans(texts[row.doc_id] or "")
        joined = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), texts[row.doc_id]
        counts = Counter(kind for *_, kind in spans)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [counts[k] for k in pii.BASE]


def test_pii_long_texts_checksums_and_redaction(spark):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00 and DE88 3704 0044 0532 0130 00",
        "number 123-45-6789, ssn 123-45-6789",
        "1.2.3.4 " * 3000,
        "a.b@c." * 20000 + "1 " * 20000,
        "write a@b.c or +1 (017) 555-7713",
    ]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, spans int")
    found = {r.doc_id: r for r in pii.find_pii(df).collect()}
    assert found[0].n_iban == 1 and found[1].n_id_number == 1 and found[2].n_ip == 3000
    assert found[2].spans.endswith("ip:23992:23999")
    clean = {r.doc_id: r for r in pii.redact_pii(df).collect()}
    assert clean[4].text == "write [EMAIL] or [PHONE]" and clean[4].spans == 1
    assert clean[2].text == "[IP] " * 3000


def test_pii_added_kinds_whatever_stands_around_them(spark):
    iban, spaced = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    cases = {
        f"{spaced} BIC COBADEFF": [("iban", spaced)],
        f"{iban} EUR 50": [("iban", iban)],
        f"NO93 8601 1117 947 NOK 7, {spaced} GB29 NWBK 6016 1331 9268 19 A": [
            ("iban", "NO93 8601 1117 947"), ("iban", spaced), ("iban", "GB29 NWBK 6016 1331 9268 19")
        ],
        f"AB12 3456 7890 12 {spaced}": [("iban", spaced)],
        "MT84 MALT 0110 0001 2345 MTLC AST0 01S and DE88 3704 0044 0532 0130 00": [("iban", "MT84 MALT 0110 0001 2345 MTLC AST0 01S")],
        f"{iban}x {iban}X": [],
        "ssn 123-45-6789, 987-65-4321": [("id_number", "123-45-6789"), ("id_number", "987-65-4321")],
        "é😀 123-45-6789 (SSN)": [("id_number", "123-45-6789")],
        "number 123-45-6789 and nothing else": [],
        "number 123-45-6789, ssn of others": [],
        "ssn " + "123-45-6789 " * 3 + "x" * 40 + " 123-45-6789": [("id_number", "123-45-6789")] * 3,
        ("x" * 40 + " 123-45-6789 ") * 127 + ". ssn 123-45-6789, 987-65-4321": [("id_number", "123-45-6789"), ("id_number", "987-65-4321")],
    }
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    for row in pii.find_pii(df).collect():
        text, wanted = list(cases.items())[row.doc_id]
        spans = [s.split(":") for s in row.spans.split(",") if s]
        assert [(k, text[int(a) : int(b)]) for k, a, b in spans] == wanted, text[-80:]
    clean = {r.doc_id: r.text for r in pii.redact_pii(df).collect()}
    assert clean[0] == "[IBAN] BIC COBADEFF" and clean[6] == "ssn [ID_NUMBER], [ID_NUMBER]"


def test_pii_is_native(spark):
    plan = pii.find_pii(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_fingerprints_follow_the_next_document(spark, odd_docs):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    assert len(found) == len(rows)
    by_text = defaultdict(set)
    for i, (doc_id, text) in enumerate(rows):
        after, half = rows[(i + 1) % len(rows)][1], len(text) // 2
        other = text[: len(text) - half] + after[:half]
        assert found[doc_id].edited_sha256 == hashlib.sha256(other.encode()).hexdigest()
        by_text[text].add(found[doc_id].fingerprint)
    assert all(len(marks) == 1 for marks in by_text.values())
    assert np.mean([r.near_edited for r in found.values()]) > 0.3 > np.mean([r.near_next for r in found.values()])
    assert fingerprints.fingerprints(odd_docs).count() == odd_docs.count()
    assert fingerprints.fingerprints(odd_docs.limit(0)).count() == 0


def test_fingerprints_are_homomorphic():
    a, b, c = "first line, it is\n", "second line.", "first line, it is"
    whole = fingerprints.fingerprint(f"{c}\n{b}")
    parts = fingerprints.add(fingerprints.fingerprint(c), fingerprints.fingerprint(b))
    assert fingerprints.written(whole) == fingerprints.written(parts) == fingerprints.written(fingerprints.fingerprint(f"{b}\n{c}"))
    assert fingerprints.written(fingerprints.subtract(whole, fingerprints.fingerprint(b))) == fingerprints.written(fingerprints.fingerprint(c))
    assert fingerprints.likeness(whole, fingerprints.fingerprint(a + "else")) < 1


def test_fingerprints_count_a_phrase_of_40000_times(spark):
    text = "0, " * 40_000
    whole, half = fingerprints.fingerprint(text), fingerprints.fingerprint("0, " * 20_000 + "other, words")
    assert np.abs(np.abs(whole[1]) - 40_000).max() <= 3  # the first and the last phrase are others
    assert fingerprints.likeness(whole, half) > 0.999
    total = fingerprints.add(whole, whole)
    assert np.array_equal(fingerprints.subtract(total, whole)[1], whole[1]) and np.array_equal(total[1], 2 * whole[1])
    docs = spark.createDataFrame([(1, text), (2, text[:60_000] + "other, words")], "doc_id long, text string")
    assert all(r.near_edited > 0.999 and r.near_next > 0.999 for r in fingerprints.fingerprints(docs).collect())


def test_chat_escapes_and_masks(spark):
    rng = random.Random(2)
    parts = [*chat.GUARDED, "<\\|turn|>", "<\\\\/s>", "[", "\\", "<", "|", "a", " ", "é😀", "\n", ""]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(2000)]
    for text in texts:
        assert chat.unescape(chat.escape(text)) == text
        assert not any(g in chat.escape(text) for g in chat.GUARDED)
    rows = [(i // 4, i % 3, rng.choice(["user", "assistant", None, "<|end|>"]), t if i % 17 else None, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece int")
    found = sorted(map(tuple, chat.chat_digests(df).collect()))
    conversations = df.toPandas()  # noqa: F841  read by the SQL
    assert found == sorted(duckdb.sql(chat.chat_sql()).fetchall())


def test_long_conversations_are_cut_between_turns(spark, monkeypatch):
    rows = [(1, i, ("user", "assistant")[i % 2], f"text {i} </s> é") for i in range(60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = chat.read_back(chat.format_conversations(df)).collect()
    turns = [(r[2], r[3]) for r in rows]
    pieces = [chat.render(turns[:7]), chat.render(turns[7:])]
    tokenizer = chat._tokenizer(FILE)
    joined = tokenizer.encode("".join(p for p, _ in pieces), add_special_tokens=False).ids
    assert joined == [i for p, _ in pieces for i in tokenizer.encode(p, add_special_tokens=False).ids]
    assert whole[0].n_turns == 60 and whole[0].loss_chars == sum(len(r[3]) for r in rows[1::2])


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _components(docs, size, percent):
    sets = {}
    for doc_id, text in docs:
        words = WORD.findall(_lower(text or ""))
        short = {tuple(words)} if words else set()
        sets[doc_id] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else short
    holders, up = defaultdict(list), {d: d for d in sets}
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for d, s in sets.items():
        for other, common in Counter(o for g in s for o in holders[g] if o < d).items():
            if 100 * common >= percent * (len(s) + len(sets[other]) - common):
                a, b = top(d), top(other)
                up[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), top(d)) for d in sets}


def _near_group(seed, n):
    """Copies of one text with a few words changed, so that some pairs link and some don't."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(160)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 9999)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, size, percent):
    texts = _near_group(1, 60) + _near_group(2, 30) + ["", None, " \n", "one two", "One two", "one  two three"] + ["same text here"] * 5
    docs = [(i * 3, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, node string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in setsketch.near_duplicates(df, size, percent).collect()}
    assert found == _components(docs, size, percent)


def test_near_duplicates_of_odd_rows(spark, odd_docs):
    found = setsketch.near_duplicates(odd_docs).collect()
    assert len(found) == odd_docs.count()
    assert all(r.component_id is None and r.kept for r in found if r.doc_id is None)
    assert setsketch.near_duplicates(odd_docs.limit(0)).count() == 0


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(5)
    common, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (800, 100, 100))
    left, right = np.concatenate([common, a]), np.concatenate([common, b])
    x, y = setsketch.registers(left), setsketch.registers(right)
    assert np.array_equal(setsketch.merged(x, y), setsketch.registers(np.concatenate([left, right])))
    guess = setsketch.estimate(np.array([(x > y).sum()]), np.array([(x < y).sum()]), np.array([900.0]), np.array([900.0]))
    assert abs(guess[0] - 0.8) < 0.15


def _brute_ctw(texts, trained, depth):
    """The same mixture, context by context."""
    counts = [defaultdict(lambda: [0, 0]) for _ in range(depth + 1)]
    pad = bytes([context_tree.END])
    padded = [pad * depth + t.encode() + pad for t in texts]

    def steps(data):
        for i in range(depth, len(data)):
            for k in range(8):
                yield data[i - depth : i], (1 << k) | (data[i] >> (8 - k)), (data[i] >> (7 - k)) & 1

    for data, train in zip(padded, trained, strict=True):
        for context, node, bit in steps(data) if train else ():
            for d in range(depth + 1):
                counts[d][context[depth - d :], node][bit] += 1

    def own(c):
        return math.lgamma(c[0] + 0.5) + math.lgamma(c[1] + 0.5) - math.lgamma(sum(c) + 1) - math.log(math.pi)

    weighted = [{} for _ in range(depth + 1)]
    weighted[depth] = {key: own(c) for key, c in counts[depth].items()}
    for d in range(depth - 1, -1, -1):
        split = defaultdict(float)
        for (context, node), w in weighted[d + 1].items():
            split[context[1:], node] += w
        for key, c in counts[d].items():
            weighted[d][key] = np.logaddexp(own(c), split[key]) - math.log(2)
    scores = []
    for data in padded:
        total = 0.0
        for context, node, bit in steps(data):
            p, left, done = 0.5, 1.0, 0.0
            for d in range(depth + 1):
                key = (context[depth - d :], node)
                c = counts[d].get(key)
                if c is None:
                    break
                half = (c[1] + 0.5) / (sum(c) + 1)
                p = done + left * half
                stay = 1.0 if d == depth else math.exp(own(c) - math.log(2) - weighted[d][key])
                done, left = done + left * stay * half, left * (1 - stay)
            total += math.log10(p if bit else 1 - p)
        scores.append(total)
    return scores


def test_context_tree_equals_brute_force(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices(["the ", "cat ", "é", "sat ", "A", "\n"], k=rng.randint(0, 12))) for _ in range(40)] + ["", None]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, block int")
    found = {r.doc_id: r for r in context_tree.score_texts(df).collect()}
    plain = [t or "" for t in texts]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(len(texts))]
    scores = _brute_ctw(plain, [not h for h in held], context_tree.DEPTH)
    tokens = Counter(w for t, h in zip(plain, held, strict=True) if not h for w in [*WORD.findall(_lower(t)), "\n"])
    total, distinct = sum(tokens.values()), len(tokens)
    for i, text in enumerate(plain):
        words, row = [*WORD.findall(_lower(text)), "\n"], found[i]
        base = sum(math.log10((tokens[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held[i], len(words), sum(w in tokens for w in words), total)
        assert row.base_score == pytest.approx(base) and row.score == pytest.approx(scores[i])


def test_context_tree_of_odd_rows(spark, odd_docs):
    assert context_tree.score_texts(odd_docs).count() == odd_docs.count()
    assert context_tree.score_texts(odd_docs.limit(0)).count() == 0


def test_context_tree_beats_the_base_on_held_out_text(spark):
    found = context_tree.score_texts(spark.read.parquet(f"{TABLES}/sf0.1/documents.parquet"))
    row = found.where("held_out").agg(F.sum("score").alias("model"), F.sum("base_score").alias("base")).first()
    assert row.model > row.base


def test_partition_search_recall_and_order(spark):
    table = spark.read.parquet(f"{TABLES}/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, np.float64)) for r in table.collect()]
    vectors, ids = np.stack([v for _, v in rows]), np.array([i for i, _ in rows])
    found = defaultdict(list)
    for r in partition_index.nearest(table).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    hits = total = 0
    for at in np.flatnonzero(ids % 20 == 0):
        scores = vectors @ vectors[at]
        scores[at] = -np.inf
        best = set(ids[np.lexsort((ids, -scores))[:20]])
        mine = found[ids[at]]
        assert len(mine) == 20 and mine == sorted(mine, key=lambda x: (-x[1], x[0]))
        hits, total = hits + len(best & {v for v, _ in mine}), total + 20
    assert hits / total >= 0.9


def test_partition_search_of_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (40, [])]
    rows += [(6, [float("inf"), 1.0]), (7, [0.5, 0.5]), (None, [1.0, 1.0]), (1, [1.0, 0.0])]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, part int")
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in partition_index.nearest(table).collect())
    assert found == [(0, 1, 1, 1.0), (0, 2, 20, 1.0), (0, 3, 7, 0.5), (20, 1, 0, 1.0), (20, 2, 1, 1.0), (20, 3, 7, 0.5)]
    assert partition_index.nearest(table.limit(0)).count() == 0


def test_cotraining_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{TABLES}/sf0.1/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/sf0.1/labels.parquet")
    kept = {r.doc_id: r.kept for r in cotraining.score_quality(docs, labels.where("xxhash64(doc_id) % 3 <> 0")).collect()}
    clean, bad = [], []
    for r in labels.where("xxhash64(doc_id) % 3 = 0").collect():
        (clean if r.quality == 1 and r.toxic == 0 else bad).append(kept[r.doc_id])
    assert len(kept) == docs.count()
    assert np.mean(clean) > 0.97 and np.mean(bad) < 0.25


def test_cotraining_sees_every_document_without_a_label(spark):
    docs = spark.read.parquet(f"{TABLES}/sf0.1/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/sf0.1/labels.parquet").select("doc_id", "quality", "toxic")
    free = docs.join(labels.where("quality IS NOT NULL"), "doc_id", "left_anti").count()
    model = cotraining.train(docs, labels)
    assert model.seen == free > 6000 and model.given.sum(axis=1).max() > 800 and model.given.sum(axis=1).min() > 0
    # null labels take no document out, and rows without an id are there
    nulls = docs.select("doc_id", F.lit(None).cast("long").alias("quality"), F.lit(None).cast("long").alias("toxic"))
    more = docs.unionByName(docs.limit(7).withColumn("doc_id", F.lit(None).cast("long")))
    assert cotraining.train(more, labels.unionByName(nulls)).seen == free + 7


def test_upper_case_is_counted_over_the_whole_text():
    for text in ("a" * 5000 + "B" * 5000, "İ" + "A" * 99 + "b" * 100, "éÉ😀Σ" * 3000, "", "a b"):
        share = views.page_view(text, None, None)[2 * views.SLOTS + 4]
        assert share == pytest.approx(sum(c.lower() != c for c in text) / max(1, len(text))), text[:10]


def test_classifiers_without_labels_and_odd_rows(spark, odd_docs):
    none = spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int")
    assert cotraining.keep_good(odd_docs, none).count() == odd_docs.count()
    assert {r.score for r in cotraining.score_quality(odd_docs, none).collect()} == {1.0}
    assert cotraining.keep_good(odd_docs, none).columns == odd_docs.columns
    assert {r.rate for r in mixing.mixing_rates(odd_docs, none).collect()} == {1.0}
    assert mixing.mixed(odd_docs, none).count() == odd_docs.count()
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(8)] + [(0, 1, None)], "doc_id long, quality int, toxic int")
    assert cotraining.score_quality(odd_docs, labels).count() == odd_docs.count()
    assert mixing.mixing_rates(odd_docs.limit(0), labels).count() == 0


def test_mixing_meets_its_targets(spark):
    docs = spark.read.parquet(f"{TABLES}/sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/sf0.01/labels.parquet")
    rows = mixing.mixing_rates(docs, labels).toPandas()
    total = rows.n_tokens.sum()
    for domain, share in mixing.TARGETS.items():
        assert abs((rows.n_tokens * rows[f"p_{domain}"] * rows.rate).sum() / total - share) < 0.01
    assert rows.rate.between(mixing.LEAST, mixing.MOST).all()
    raised = mixing.mixed(docs, labels)
    assert raised.select("doc_id").distinct().count() == docs.count() and raised.columns == docs.columns


def test_mixing_stage_reaches_its_shares_of_languages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{TABLES}/sf0.1/documents.parquet")
    docs = docs.where("lang IS NOT NULL").withColumn("n", F.size(F.split("text", r"\s+")))
    tokens = lambda df: {r.lang: r.n for r in df.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    out = corpus_pipeline.mix(spark, docs, SMALL)
    before, after = tokens(docs), tokens(out)
    wanted = mixing.flattened(np.array(list(before.values()), float))
    for (lang, n), share in zip(before.items(), wanted / wanted.sum(), strict=True):
        print("share", lang, n / sum(before.values()), share, after[lang] / sum(after.values()))
        assert after[lang] >= n and abs(after[lang] / sum(after.values()) - share) < 0.02
    assert out.columns == docs.columns and out.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert out.count() > docs.count()


def test_mixing_steps_equal_plain_gradient_descent(spark):
    rng = np.random.default_rng(6)
    share, tokens = rng.dirichlet([1, 1, 1], 50), rng.integers(1, 100, 50)
    table = spark.createDataFrame([(list(map(float, s)), int(n)) for s, n in zip(share, tokens, strict=True)], "share array<double>, tokens long")
    steps = mixing.fit_rates(table, {"clean": 0.5, "poor": 0.3, "toxic": 0.2}, 0.0, 4.0)
    rates = np.array([r[0] for r in table.select(mixing._rate(F.col("share"), steps, 0.0, 4.0)).collect()])
    plain = np.ones(50)
    for move in steps:
        plain = np.clip(plain - share @ np.array(move), 0, 4)
    assert np.allclose(np.sort(rates), np.sort(plain))
    assert np.allclose((plain * tokens) @ share / tokens.sum(), [0.5, 0.3, 0.2], atol=2e-3)


def test_pipeline_runs_and_keeps_its_promises(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    good = corpus_pipeline.STAGES[0][1](spark, docs, SMALL)
    one = corpus_pipeline.STAGES[1][1](spark, good, SMALL)
    assert good.columns == one.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in good.collect()]
    kept = {d for d, (_, top) in _components(rows, 5, 80).items() if d == top}
    assert {r.doc_id for r in one.collect()} == kept
    out = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in out.select("doc_id").collect()} == kept


def test_near_dedup_judges_rows_by_id_and_text(spark):
    import corpus_pipeline

    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcde")
    rows = [(3, a), (5, a), (5, b), (6, c), (6, d), (6, d), (None, c), (None, e), (None, e + " more"), (7, ""), (8, None)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    one = corpus_pipeline.near_dedup(spark, docs, SMALL)
    assert one.columns == docs.columns
    found = [(r.doc_id, r.text) for r in one.collect()]
    of_e = [r for r in found if r[0] is None]
    assert len(of_e) == 1 and of_e[0][1] in (e, e + " more")
    assert sorted((i, t or "") for i, t in found if i is not None) == [(3, a), (5, b), (6, c), (6, d), (7, ""), (8, "")]
    again = corpus_pipeline.near_dedup(spark, docs.repartition(3, "text"), SMALL).collect()
    assert {(r.doc_id, r.text) for r in again} == set(found)


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    from compare import connect, differences

    assert differences(queries.QUERIES[name](spark, SMALL), connect(SMALL), queries.ORACLES[name]) == []
