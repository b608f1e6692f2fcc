"""Near-duplicate vectors, phrase collocations and conversation repair against brute force and odd input."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from telepulse.llm import collocations, cross_polytope, queries, repair

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ["op11_near_vectors", "op12_collocations", "op13_repair"])
def test_queries_equal_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLES[name]) == []


# --- vectors ------------------------------------------------------------------------------
VECTORS = "vec_id long, label int, embedding array<double>"


def _reach(links, ids):
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[max(top(a), top(b))] = min(top(a), top(b))
    return {i: top(i) for i in ids}


def _near(rows, cosine=0.98):
    """vec_id -> (links, component) by comparing all pairs."""
    usable = {
        i: (label, np.array(v) / np.linalg.norm(v))
        for i, label, v in rows
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    }
    links = [
        (a, b)
        for a in usable
        for b in usable
        if a < b and usable[a][0] == usable[b][0] and len(usable[a][1]) == len(usable[b][1]) and usable[a][1] @ usable[b][1] >= cosine
    ]
    count = Counter(x for link in links for x in link)
    parts = _reach(links, {i for i, _, _ in rows})
    return {i: (count[i], parts[i]) for i, _, _ in rows}


def _clusters(dims, seed, spread, n=60, centres=6):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(centres):
        centre = rng.normal(size=dims)
        for _ in range(n):
            rows.append((len(rows) + 1, c % 2, (centre + spread * rng.normal(size=dims)).tolist()))
    return rows


@pytest.mark.parametrize("dims,spread", [(64, 0.1), (64, 0.03), (3, 0.15), (1, 0.1), (100, 0.14)])
def test_vectors_against_all_pairs(spark, dims, spread):
    rows = _clusters(dims, dims, spread)
    found = cross_polytope.near_vectors(spark.createDataFrame(rows, VECTORS)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == _near(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found) and len(found) == len(rows)


def test_blocks_and_cores_count_the_same(spark, monkeypatch):
    rows = _clusters(16, 5, 0.08, n=120, centres=2)
    wanted = _near(rows)
    monkeypatch.setattr(cross_polytope, "BLOCK", 16)
    found = cross_polytope.near_vectors(spark.createDataFrame(rows, VECTORS)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == wanted


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, 0, [1.0, 2.0]),
        (2, 0, [2.0, 4.0]),
        (3, 1, [1.0, 2.0]),
        (4, None, [1.0, 2.0]),
        (5, 0, None),
        (6, 0, []),
        (7, 0, [0.0, 0.0]),
        (8, 0, [nan, 1.0]),
        (9, 0, [inf, 1.0]),
        (10, 0, [1.0, 2.0, 0.0]),
        (11, 0, [-1.0, -2.0]),
        (12, 0, [1e300, 2e300]),
        (13, 0, [1e-300, 2e-300]),
        (14, 0, [1.0, 2.0]),
    ]
    df = spark.createDataFrame([*rows, (1, 0, [1.0, 2.0]), (None, 0, [1.0, 2.0]), (15, 0, [1.0, None])], VECTORS)
    df = df.withColumns({"node": F.lit("x"), "key": F.lit(None).cast("string"), "home": F.lit(1)})
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cross_polytope.near_vectors(df).collect()}
    assert found.pop(None) == (0, None, True)
    linked = {1, 2, 12, 13, 14}
    for i, got in found.items():
        assert got == ((4, 1, i == 1) if i in linked else (0, i, True)), i
    assert len(found) == 15
    assert cross_polytope.near_vectors(df.limit(0)).collect() == []


def test_limit_is_exact():
    a = np.array([[0.6, 0.8]])
    assert cross_polytope.linked(a, a, 1.0).all()
    assert not cross_polytope.linked(a, np.array([[0.8, 0.6]]), 0.9600001).any()


def test_probes_find_pairs_at_the_limit():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    missed = np.ones(len(a), bool)
    for table in range(cross_polytope.TABLES):
        x, y = cross_polytope.buckets(a, table, 3), cross_polytope.buckets(b, table, 3)
        missed &= ~((x[:, :1] == y).any(axis=1) | (y[:, :1] == x).any(axis=1))
    assert missed.mean() <= 0.001


# --- phrases ------------------------------------------------------------------------------
DOCS = "doc_id long, text string, lang string"


def _phrases(rows, least, top, percent=100):
    """The result, from every phrase of every text."""
    out = []
    for lang in sorted({lang or "und" for _, _, lang in rows}):
        count, n = Counter(), 0
        for _, text, of in rows:
            if (of or "und") == lang:
                lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
                for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
                    words = re.findall(r"[^\x20\x09]+", piece)
                    n += len(words)
                    count.update(tuple(words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        gone = {
            p[i : i + k]
            for p, a in candidates.items()
            for k in range(2, len(p))
            for i in range(len(p) - k + 1)
            if 100 * a >= percent * count[p[i : i + k]]
        }
        scored = []
        for p, a in candidates.items():
            if p not in gone:
                score, _, l, r = min((1000 * a * n // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), a, l, r, n, score))
        for rank, (_, _, phrase, *rest) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), *rest))
    return out


def _texts(n, seed):
    rng = random.Random(seed)
    words = ["The", "cat", "sat", "é", "中文", "on", "mat", "x" * 40, "a\x1cb", "Ä", " "]
    gaps = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "\r\n", "!?"]
    return [
        (i, "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", None, "und"])) for i in range(n)
    ]


def _found(df, **options):
    rows = collocations.collocations(df, **options).orderBy("lang", "rank").collect()
    return [(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in rows]


@pytest.mark.parametrize("least,top,percent", [(2, 2000, 100), (5, 7, 100), (3, 50, 60)])
def test_phrases_against_all_counts(spark, least, top, percent):
    rows = _texts(300, least)
    assert _found(spark.createDataFrame(rows, DOCS), least=least, top=top, percent=percent) == _phrases(rows, least, top, percent)


def test_spilled_and_burst_tries_count_the_same(spark, monkeypatch):
    rows = _texts(200, 9)
    for name, value in {"BURST": 4, "CHUNK": 64}.items():
        monkeypatch.setattr(collocations, name, value)
    lines = spark.createDataFrame(rows, DOCS).select("lang", "text").where("lang IS NOT NULL AND text <> ''")
    batches = lines.toArrow().to_batches()
    found = Counter()
    every = _Any()
    for size in (1, 2, 3, 4, 5):
        trie, counts = collocations.HatTrie(), Counter()
        for _, lang, data in collocations._texts(iter(batches)):
            for words, known in collocations.chunks(data, size - 1):
                keys = words.keys(size, lang)[collocations.possible(words, known, size, lang, [every, every])]
                trie.add(*np.unique(keys, return_counts=True))
                if trie.size > 50:
                    for keys, n in trie.spill(25):
                        assert (keys[1:] > keys[:-1]).all()
                        _plus(counts, keys, n)
                    assert trie.size <= 25
        for keys, n in trie.spill(0):
            _plus(counts, keys, n)
        assert trie.size == 0 and not trie.root
        found[size] = (len(counts), sum(counts.values()))
    wanted = {}
    for size in (1, 2, 3, 4, 5):
        phrases = Counter()
        for _, text, lang in rows:
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text) if lang else ""):
                words = re.findall(r"[^\x20\x09]+", piece)
                phrases.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
        wanted[size] = (len(phrases), sum(phrases.values()))
    assert dict(found) == wanted


class _Any:
    def holds(self, keys):
        return np.ones(len(keys), bool)


def _plus(counts, keys, n):
    for key, k in zip(keys.tolist(), n.tolist(), strict=True):
        counts[key] += k


def test_tries_burst_and_spill_sorted_runs(monkeypatch):
    monkeypatch.setattr(collocations, "BURST", 300)
    rng = np.random.default_rng(1)
    trie, wanted = collocations.HatTrie(), Counter()
    for _ in range(40):
        keys, n = np.unique(rng.choice(5000, 400).astype(np.uint64) << np.uint64(45), return_counts=True)
        _plus(wanted, keys, n)
        trie.add(keys, n)
    assert any(isinstance(child, collocations.Node) for child in trie.root.values())
    found = Counter()
    for keys, n in trie.spill(0):
        assert (keys[1:] > keys[:-1]).all()
        _plus(found, keys, n)
    assert found == wanted


def test_filter_has_no_false_negatives(spark):
    keys = np.random.default_rng(2).integers(-(2**63), 2**63, 6000)
    some = collocations.key_filter(spark.createDataFrame([(k,) for k in keys[:3000].tolist()], "key long"))
    assert some.holds(keys[:3000].view(np.uint64)).all() and some.holds(keys[3000:].view(np.uint64)).mean() < 0.1


def test_odd_phrases(spark):
    long = "big cat " * 40_000
    rows = [(1, None, "en"), (2, "", "en"), (3, long, "en"), (3, long, "en"), (None, "big cat", None), (4, "...", "en")]
    df = spark.createDataFrame(rows, DOCS).withColumns({"phrase": F.lit("x"), "f": F.lit(1), "words": F.lit(1), "prefix": F.lit("y")})
    assert _found(df, least=100) == _phrases(rows, 100, 2000)
    assert _found(df.limit(0)) == []


def test_scores_pass_64_bits(spark):
    """1000 * a * n is over 2^63 here."""
    f = 10**9
    rows = spark.createDataFrame([("en", 1, None, 5 * f), ("en", 1, "a", f), ("en", 1, "b", f), ("en", 2, "a b", f - 1)], "lang string, words int, phrase string, f long")
    original = collocations.frequent_phrases
    try:
        collocations.frequent_phrases = lambda *a: rows
        found = _found(rows)
    finally:
        collocations.frequent_phrases = original
    assert found == [("en", 1, "a b", f - 1, f, f, 5 * f, 1000 * (f - 1) * 5 * f // (f * f))]


# --- conversations ------------------------------------------------------------------------
TURNS = "conv_id long, turn long, role string, text string"


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(place.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def _repaired(rows):
    """Result of one conversation's damaged rows: forward over all edits, keeping the least to each place."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    places = {"": (0, "", ())}
    count, seen = Counter(), set()
    following = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def filled(found):
        for _ in range(4):
            for place, (cost, audit, lines) in list(found.items()):
                to = "a" if place == "u" else "u"
                option = (cost + 2, audit + "I", (*lines, "assistant:" if to == "a" else "user:"))
                found[to] = min(found.get(to, option), option)
        return found

    for _, _, role, text in rows:
        solid = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        count[fault] += 1
        new = {}
        for place, (cost, audit, lines) in filled(places).items():
            options = [(place, (cost + 3, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if to := following.get((place, role[:1])):
                    options.append((to, (cost + extra, audit + "K", (*lines, f"{role}:{text}"))))
                to, name = ("a", "assistant") if place == "u" else ("u", "user")
                options.append((to, (cost + 2 + extra, audit + "R", (*lines, f"{name}:{text}"))))
            for to, option in options:
                new[to] = min(new.get(to, option), option)
        places = new
    cost, audit, lines = min(v for k, v in filled(places).items() if k in ("", "a"))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in pairwise(rows))
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _wanted(rows):
    of = defaultdict(list)
    for row in _damaged(rows):
        of[row[0]].append(row)
    return {conv: _repaired(of[conv]) for conv in {r[0] for r in rows}}


def _digests(df):
    found = repair.repair_digests(df).collect()
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: tuple(r)[1:] for r in found}


def _conversations(n, longest, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = rng.choice(["Hi.", "Hi.", "Why? ", "cut off", "ok!\n", " \t", "", None, f"number {turn}.", "é…", "no ."])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 2, None]), role, text))
    return rows


@pytest.mark.parametrize("n,longest,block", [(300, 8, 1024), (40, 60, 1024), (40, 60, 7), (3, 900, 64)])
def test_repairs_against_brute_force(spark, monkeypatch, n, longest, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = _conversations(n, longest, n + longest)
    assert _digests(spark.createDataFrame(rows, TURNS)) == _wanted(rows)


def test_matrices_give_the_costs_of_walks():
    rng = random.Random(4)
    for _ in range(200):
        codes = bytes(rng.choice([0, 1, 2, 3, 4, 6, 8, 9, 10, 11]) for _ in range(rng.randint(0, 40)))
        costs = repair.back(codes, repair.ENDING)
        part = len(codes) // 3
        after = repair.before(repair.matrix(codes[part:]), list(repair.ENDING))
        assert tuple(repair.before(repair.matrix(codes[:part]), after)) == costs[1]


def test_odd_conversations(spark):
    long = "word " * 300_000
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (7, 1, "user", long), (7, 2, "assistant", long + "."), (8, None, "", ""), (9, 5, "user", "A.")]
    rows += [(9, 5, "user", "A.")] * 3
    df = spark.createDataFrame(rows, TURNS).withColumns({"block": F.lit("x"), "gone": F.lit(None), "at": F.lit(1), "fault": F.lit("y")})
    assert _digests(df) == _wanted(rows)
    assert repair.repair_digests(df.limit(0)).collect() == []


def test_a_conversation_without_rows_after_damage(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    found = _digests(spark.createDataFrame([(gone, 0, "user", "Hi.")], TURNS))
    assert found == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


# --- earlier operators on inputs that broke them --------------------------------------------
def test_domains_of_any_length_and_many_spans(spark):
    from telepulse.llm import pii

    texts = [
        "a@b" + ".c" * 1_000_000,
        "a@b.c.c" * 100_000,
        "a@b.c." + ".c" * 1000,
        "x 1.2.3.4 " * 200_000,
        "1.2.3.4@b.c é😀 a@b.c",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r.doc_id: r for r in pii.find_pii(df).collect()}
    assert found[0].spans == f"email:0:{3 + 2_000_000}" and found[2].n_email == 1
    # 'a@b.c.ca' ends where the next '@' begins
    assert found[1].n_email == len(re.findall(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", texts[1]))
    assert found[3].n_ip == 200_000
    clean = {r.doc_id: r.text for r in pii.redact_pii(df).collect()}
    assert clean[0] == "[EMAIL]" and clean[3] == "x [IP] " * 200_000
    assert clean[4] == "[EMAIL] é😀 [EMAIL]"


def test_redaction_equals_a_plain_replacement(spark):
    from telepulse.llm import pii

    rng = random.Random(8)
    parts = ["a@b.c", "1.2.3.4", "+1 (017) 555-7713", "4111 1111 1111 1111", "é", "😀", " ", "word ", "\n", "@", "1"]
    texts = ["".join(rng.choices(parts, k=rng.choice([3, 30, 900]))) for _ in range(120)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: [s.split(":") for s in r.spans.split(",") if s] for r in pii.find_pii(df).collect()}
    for row in pii.redact_pii(df).collect():
        text, at, out = texts[row.doc_id], 0, []
        for kind, a, b in spans[row.doc_id]:
            if int(a) >= at:
                out += [text[at : int(a)], f"[{kind.upper()}]"]
            at = max(at, int(b))
        assert row.text == (text if text is None else "".join(out) + text[at:])


def test_equal_vectors_are_equally_near(spark):
    from telepulse.llm import partition_index

    rng = np.random.default_rng(2)
    base = rng.normal(size=(300, 64))
    rows = [(i, base[i % 300].tolist()) for i in range(900)] + [(5, [9.0] * 64), (20, base[20].tolist())]
    found = defaultdict(list)
    for r in partition_index.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), parts=4, probes=4).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    vectors = {i: min(tuple(v) for j, v in rows if j == i) for i in range(900)}
    for query, got in found.items():
        got.sort()
        scores = defaultdict(set)
        for _, i, s in got:
            scores[vectors[i]].add(s)
        assert all(len(s) == 1 for s in scores.values())
        assert [(-s, i) for _, i, s in got] == sorted((-s, i) for _, i, s in got) and len(got) == 20, query


def test_intermediate_tables_are_removed(spark, tmp_path, monkeypatch):
    from telepulse.llm import tables

    monkeypatch.setattr(tables, "shared_folder", lambda _: str(tmp_path))
    with tables.intermediates_removed(spark):
        kept = tables.saved(tables.saved(spark.range(5), "one"), "two", keep=True)
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["two"] and kept.count() == 5


def test_long_pretokens_are_cut_and_composed(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    from telepulse.llm import token_counts
    from telepulse.llm.pretokens import vocabulary

    file = public_tokenizers.path("byte_bpe_50k.json")
    machine, library = token_counts.Transducer(vocabulary(file)), Tokenizer.from_file(file)
    rng = random.Random(6)
    texts = [
        "".join(rng.choices("etaoinshr", k=30_000)),
        "a" * 20_001,
        "word " * 700 + "".join(rng.choices(["the", "ing", "a", "zz"], k=9000)) + " and" * 900,
        " " * 9000 + "x" + "=" * 9001,
        "é" * 7001,
        "short",
    ]
    wanted = [len(c.ids) for c in library.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.count_tokens(texts, machine).tolist() == wanted
    for run_in in (1, 7):  # guesses from so few bytes are often wrong
        monkeypatch.setattr(token_counts, "RUN_IN", run_in)
        monkeypatch.setattr(token_counts, "CHUNK_BYTES", 64)
        assert token_counts.count_tokens(texts, machine).tolist() == wanted
