"""Personal data: proposed by regular expressions, confirmed by checksums, scored by context (operator 3).

DataFrame functions only. The places of matches come from the lengths of the
matches and of the pieces between them. All patterns run in linear time: each
starts at the edge of a run of its letters (or where the last match ended) and
takes runs without giving them back. A group that repeats without a bound is
taken possessively: otherwise the regex engine goes one call deeper each time,
and a long domain would end in a stack overflow.

Base kinds: email, ip (parts to 255), card (12 to 19 digits, Luhn), phone (9 to
15 digits). Added kinds: iban (mod-97) and id_number (a grouped number that
counts only near a context word). An IBAN has the length of its country, where
the registry has the country, whatever follows it. A context word in the 40 code
points of text before a span raises its score, and so does one in the 20 behind
it, as far as the clause goes on and no other candidate of the kind starts; base
spans stay whatever their score is.

Defined results: null or empty text has no spans; repeated rows give repeated
results; an empty table gives no rows; extra columns pass through
``redact_pii`` and are ignored by ``find_pii``. Starts and ends count code
points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban", "id_number")
BASE = KINDS[:4]

LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9][0-9 \-]+",  # after lone separators are masked
    "phone": r"\+[0-9][ ().0-9\-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?: ?[A-Z0-9]){11})(?=([\s\S]{0,90}))",  # its head; group 1 is what follows
    "id_number": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# Texts without this can't hold the kind, and are not searched for places.
NEEDED = {
    "email": "@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]++\.[0-9]",
    "card": "[0-9](?:[ -]?[0-9]){11}",
    "phone": r"\+[0-9]",
    "iban": "[A-Z]{2}[0-9]{2}",
    "id_number": "-[0-9]{2}-",
}
# Letters of an IBAN by country.
IBAN_LETTERS = {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
LONE_SEPARATOR = r"[ \-](?![0-9])|(?<![0-9])[ \-]"
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

START_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.9, "id_number": 0.3}
CONTEXT_WORDS = {
    "email": "mail|contact|write to",
    "ip": "address|host|server|client",
    "card": "card|credit|visa|payment|account",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|bank|account|transfer",
    "id_number": "ssn|social security|national id|passport|licen[cs]e no",
}
CONTEXT, BEHIND, BONUS, KEEP = 40, 20, 0.3, 0.5
PAIRS_BEFORE = CONTEXT // 2  # a hit has two code points at least
BLOCK = 128


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _mod97(text: Column) -> Column:
    """Remainder of an IBAN whose first four letters are moved behind the others."""
    packed = F.regexp_replace(text, " ", "")
    letters = F.split(F.concat(F.substring(packed, 5, 64), F.substring(packed, 1, 4)), "")

    def step(rest: Column, letter: Column) -> Column:
        code = F.ascii(letter)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(letters, F.lit(0), step)


def _iban(head: Column, rest: Column) -> Column:
    """The IBAN that starts with ``head``: as long as its country's are, or else as far as letters go."""
    country = F.substring(head, 1, 2)
    body = F.lit(r"^(?: ?[A-Z0-9]){11,30}+(?![A-Za-z0-9])")
    for letters, countries in IBAN_LETTERS.items():
        of_length = F.lit(rf"^(?: ?[A-Z0-9]){{{letters - 4}}}(?![A-Za-z0-9])")
        body = F.when(country.isin(countries.split()), of_length).otherwise(body)
    return F.concat(head, F.call_function("regexp_extract", rest, body, F.lit(0)))


def _confirmed(kind: str, found: Column) -> Column:
    digits = _digits(found)
    return {
        "email": F.lit(True),
        "ip": found.rlike(rf"^{PART}(?:\.{PART}){{3}}$"),
        "card": F.length(digits).between(12, 19) & F.call_function("luhn_check", digits),
        "phone": F.length(digits).between(9, 15),
        "iban": F.length(F.regexp_replace(found, " ", "")).between(15, 34) & (_mod97(found) == 1),
        "id_number": F.lit(True),
    }[kind]


SPANS = "array<struct<start:int,rank:int,end:int,score:double>>"


def _block(kind: str, pairs: Column, first: Column) -> Column:
    """Length of a block of (gap, hit, rest) pairs, and its confirmed spans counted from its start.

    The text before a span is put together of the ends of the pairs before it, those of earlier blocks too.
    """
    state = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {SPANS})").alias("spans"))
    words = rf"(?:^|[^a-z])(?:{CONTEXT_WORDS[kind]})"

    def end_of(text: Column) -> Column:
        return F.substring(F.coalesce(text, F.lit("")), -CONTEXT, CONTEXT)

    def step(acc: Column, k: Column) -> Column:
        pair = F.get(pairs, k)
        gap, hit = pair["gap"], pair["hit"]
        start = acc["at"] + F.length(gap)
        after_hit = start + F.coalesce(F.length(hit), F.lit(0))
        found = _iban(hit, pair["rest"]) if kind == "iban" else hit
        end = start + F.length(found)
        earlier = F.slice(pairs, F.greatest(k - PAIRS_BEFORE, F.lit(0)) + 1, F.least(k, F.lit(PAIRS_BEFORE)))
        before = F.concat(
            F.array_join(F.transform(earlier, lambda p: F.concat(end_of(p["gap"]), end_of(p["hit"]))), ""), end_of(gap)
        )
        if kind == "iban":
            behind = F.call_function("substring", pair["rest"], F.length(found) - F.length(hit) + 1, F.lit(BEHIND))
        else:
            behind = F.substring(F.get(pairs, k + 1)["gap"], 1, BEHIND)
        behind = F.regexp_extract(F.coalesce(behind, F.lit("")), r"^[^,;.!?\n]*", 0)
        near = F.lower(end_of(before)).rlike(words) | F.lower(behind).rlike(words)
        span = F.struct(
            start.alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            end.alias("end"),
            F.least(F.lit(START_SCORE[kind]) + F.when(near, BONUS).otherwise(0.0), F.lit(1.0)).alias("score"),
        )
        keep = hit.isNotNull() & F.coalesce(_confirmed(kind, found), F.lit(False))
        if kind == "iban":  # a head within an IBAN starts none
            keep &= (F.size(acc["spans"]) == 0) | (F.coalesce(F.get(acc["spans"], F.size(acc["spans"]) - 1)["end"], F.lit(0)) <= start)
        spans = F.when(keep, F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(after_hit.alias("at"), spans.alias("spans"))

    return F.aggregate(F.sequence(first, F.least(first + BLOCK, F.size(pairs)) - 1), state, step)


def with_spans(docs: DataFrame, text_col: str = "text", out: str = "pii_spans") -> DataFrame:
    """Add the sorted spans of every text as array<struct<start, rank, end, score>>.

    Each step is a projection of its own and names what it needs twice or outside
    a lambda, so that it is computed once a row. Places are summed within blocks
    of pairs and then over blocks, as a fold copies what it has gathered.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    column = {kind: f"__{out}_{kind}" for kind in KINDS}
    masked = F.regexp_replace(text, LONE_SEPARATOR, "_")
    searched = {kind: masked if kind == "card" else text for kind in KINDS}

    def each(df: DataFrame, make) -> DataFrame:
        return df.select(*kept, *(make(kind, F.col(column[kind])).alias(column[kind]) for kind in KINDS))

    found = docs.select(
        *kept,
        *(
            F.when(
                text.rlike(NEEDED[kind]), F.regexp_extract_all(searched[kind], F.lit(PATTERNS[kind]), F.lit(0))
            ).alias(column[kind])
            for kind in KINDS
        ),
    )
    pairs = each(
        found,
        lambda kind, c: F.when(
            F.size(c) > 0,
            F.arrays_zip(
                F.split(searched[kind], PATTERNS[kind], -1).alias("gap"),
                c.alias("hit"),
                *([F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(1)).alias("rest")] if kind == "iban" else []),
            ),
        ),
    )
    blocks = each(
        pairs,
        lambda kind, c: F.when(
            F.size(c) > 0,
            F.transform(
                F.sequence(F.lit(0), F.floor((F.size(c) - 1) / BLOCK).cast("int")),
                lambda i: _block(kind, c, i * BLOCK),
            ),
        ),
    )
    placed = each(
        blocks,
        lambda kind, c: F.when(
            F.size(c) > 0,
            F.arrays_zip(
                c.alias("block"),
                F.aggregate(
                    c,
                    F.array(F.lit(0)),
                    lambda acc, b: F.array_append(acc, F.element_at(acc, -1) + b["at"]),
                ).alias("offset"),
            ),
        ),
    )

    def moved(c: Column) -> Column:
        shift = lambda z: F.transform(
            z["block"]["spans"],
            lambda s: F.struct(
                (s["start"] + z["offset"]).alias("start"),
                s["rank"].alias("rank"),
                (s["end"] + z["offset"]).alias("end"),
                s["score"].alias("score"),
            ),
        )
        whole = F.filter(c, lambda z: z["block"].isNotNull())
        return F.when(F.size(c) > 0, F.flatten(F.transform(whole, shift))).otherwise(F.expr(f"cast(array() as {SPANS})"))

    spans = F.concat(*(moved(F.col(column[kind])) for kind in KINDS))
    strong = F.filter(spans, lambda s: (s["rank"] < len(BASE)) | (s["score"] >= KEEP))
    return placed.select(*kept, F.array_sort(strong).alias(out))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["rank"]], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, digest and list of the spans of every whole text."""
    found = with_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    spans = F.col("pii_spans")

    def count(rank: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")

    return found.select(
        "doc_id",
        *(count(rank).alias(f"n_{kind}") for rank, kind in enumerate(KINDS)),
        F.sha2(_joined(F.filter(spans, lambda s: s["rank"] < len(BASE))), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
        F.array_join(F.transform(spans, lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )


def redact_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns with every span replaced by the name of its kind, as in ``[EMAIL]``.

    Of spans that overlap, the first gives the name and all are replaced. A text without spans is unchanged. Spans
    are taken in blocks of the square root of their number: a piece is cut from its block's part of the text, and
    pieces are joined once.
    """
    hidden = "__pii_spans"
    found = with_spans(docs, text_col, hidden)
    text, spans = F.col(f"`{text_col}`"), F.col(hidden)
    names = F.array(*(F.lit(f"[{kind.upper()}]") for kind in KINDS))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    some = F.size(spans) > 0
    size = F.greatest(F.lit(BLOCK), F.ceil(F.sqrt(F.size(spans))).cast("int"))
    sized = found.select(*kept, spans, F.when(some, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / size).cast("int")), lambda k: F.slice(spans, k * size + 1, size)
    )).alias("__blocks"))
    # where each block of spans begins: behind all spans before it
    begun = sized.select(*kept, "__blocks", F.aggregate(
        "__blocks",
        F.array(F.lit(0)),
        lambda acc, b: F.array_append(acc, F.greatest(F.element_at(acc, -1), F.array_max(F.transform(b, lambda s: s["end"])))),
    ).alias("__at"))

    def redacted(block: Column, k: Column) -> Column:
        """The text from where the block begins to where the next one does; places in it are counted from its start."""
        begin, end = F.get(F.col("__at"), k), F.get(F.col("__at"), k + 1)
        state = F.struct(
            F.lit(0).alias("at"), F.substring(text, begin + 1, end - begin).alias("part"), F.expr("cast(array() as array<string>)").alias("done")
        )

        def step(acc: Column, span: Column) -> Column:
            start = span["start"] - begin
            piece = F.concat(F.substring(acc["part"], acc["at"] + 1, start - acc["at"]), names[span["rank"]])
            done = F.when(start < acc["at"], acc["done"]).otherwise(F.array_append(acc["done"], piece))
            return F.struct(F.greatest(acc["at"], span["end"] - begin).alias("at"), acc["part"].alias("part"), done.alias("done"))

        return F.aggregate(block, state, step, lambda acc: F.array_join(acc["done"], ""))

    pieces = begun.select(*kept, "__blocks", "__at", F.transform("__blocks", redacted).alias("__pieces"))
    rest = F.substring(text, F.element_at("__at", -1) + 1, F.length(text))
    changed = F.when(F.col("__blocks").isNotNull(), F.concat(F.array_join("__pieces", ""), rest)).otherwise(text)
    return pieces.select(*(changed.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))
