"""Byte-level pretokens found by a deterministic transducer run on chunks.

The transducer reads code-point classes with one character of lookahead and
flags where a pretoken starts. Text is cut into chunks of equal length; each
chunk is run from every state at once, which gives its map from entry state to
exit state. A parallel prefix scan composes the maps, so each chunk learns its
true entry state, and a second run writes the flags.
"""

from __future__ import annotations

import functools
import json
import unicodedata

import numpy as np

# Symbols: classes of code points, white space by what follows it, contractions.
LETTER, NUMBER, OTHER, GAP, LAST_GAP, LAST_BLANK, CONTRACT2, CONTRACT3, BREAK = range(9)
# States: what the pretoken that is open consists of. In BLANK one leading blank waits for its run.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_GAP, BLANK, LEFT1, LEFT2 = range(8)
STATES, SYMBOLS, CHUNK = 8, 9, 256

# White space of the split pattern, and its contractions.
WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
SHORT, LONG = ("s", "t", "m", "d"), ("re", "ve", "ll")


@functools.cache
def _classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = LETTER
        elif kind == "N":
            table[code] = NUMBER
    table[list(WHITE)] = GAP
    return table


@functools.cache
def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and start flag, both at [state * SYMBOLS + symbol]."""
    to, starts = np.zeros((STATES, SYMBOLS), np.uint8), np.zeros((STATES, SYMBOLS), bool)
    runs = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, CONTRACT2: IN_OTHERS, CONTRACT3: IN_OTHERS}
    for state in range(STATES):
        for symbol in range(SYMBOLS):
            if symbol == BREAK:
                to[state, symbol], starts[state, symbol] = FRESH, True
            elif state == LEFT2:
                to[state, symbol] = LEFT1
            elif state == LEFT1:
                to[state, symbol] = FRESH
            elif symbol in runs:
                run = runs[symbol]
                to[state, symbol], starts[state, symbol] = run, state not in (run, BLANK)
                if symbol in (CONTRACT2, CONTRACT3) and state not in (IN_OTHERS, BLANK):
                    to[state, symbol] = LEFT1 if symbol == CONTRACT2 else LEFT2
            elif symbol == GAP:
                to[state, symbol], starts[state, symbol] = IN_GAP, state != IN_GAP
            else:  # the last white space before a run stands alone, or leads the run if it is a blank
                to[state, symbol], starts[state, symbol] = (BLANK if symbol == LAST_BLANK else IN_GAP), True
    return to.ravel(), starts.ravel()


def _symbols(codes: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    symbols = _classes()[codes]
    symbols[breaks] = BREAK
    gap = symbols == GAP
    solid_next = np.zeros(len(codes), bool)
    solid_next[:-1] = ~gap[1:] & (symbols[1:] != BREAK)
    last = gap & solid_next
    symbols[last] = LAST_GAP
    symbols[last & (codes == 0x20)] = LAST_BLANK
    quotes = np.flatnonzero(codes == ord("'"))
    if len(quotes):
        ahead = np.concatenate([codes, np.zeros(2, codes.dtype)])
        one, two = ahead[quotes + 1], ahead[quotes + 2]
        symbols[quotes[np.isin(one, [ord(x) for x in SHORT])]] = CONTRACT2
        long = np.zeros(len(quotes), bool)
        for a, b in LONG:
            long |= (one == ord(a)) & (two == ord(b))
        symbols[quotes[long]] = CONTRACT3
        symbols[breaks] = BREAK
    return symbols


def _scan(maps: np.ndarray) -> np.ndarray:
    """Entry state of each chunk: inclusive scan of map composition, shifted by one."""
    scanned, step = maps.copy(), 1
    while step < len(scanned):
        scanned[step:] = np.take_along_axis(scanned[step:], scanned[:-step], axis=1)
        step *= 2
    entry = np.full(len(maps), FRESH, np.uint8)
    entry[1:] = scanned[:-1, FRESH]
    return entry


def starts_of(codes: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Positions where a pretoken starts. ``breaks``: positions between texts; each is a piece of its own."""
    if not len(codes):
        return np.zeros(0, np.int64)
    to, flags = _machine()
    n = len(codes)
    chunks = -(-n // CHUNK)
    padded = np.full(chunks * CHUNK, BREAK, np.uint8)
    padded[:n] = _symbols(codes, breaks)
    columns = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T)
    states = np.repeat(np.arange(STATES, dtype=np.uint8)[None], chunks, axis=0)
    for column in columns:
        states = to[states * np.uint8(SYMBOLS) + column[:, None]]
    state = _scan(states)
    started = np.empty((CHUNK, chunks), bool)
    for row, column in zip(started, columns, strict=True):
        at = state * np.uint8(SYMBOLS) + column
        row[:] = flags[at]
        state = to[at]
    return np.flatnonzero(started.T.ravel()[:n])


class Pieces:
    """Texts joined for one run of the transducer: segments between special strings, then pretokens."""

    def __init__(self, texts: list[str], specials: dict[str, int]):
        self.segments: list[str] = []
        self.owner: list[int] = []
        self.special: list[tuple[int, int, int]] = []  # text, segments before it, id
        for i, text in enumerate(texts):
            for segment, special in _split(text, specials):
                if special is not None:
                    self.special.append((i, len(self.segments), special))
                elif segment:
                    self.segments.append(segment)
                    self.owner.append(i)
        self.joined = "\n".join(self.segments)
        self.codes = np.frombuffer(self.joined.encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, self.segments), np.int64, len(self.segments))
        self.begin = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]) if len(lengths) else np.zeros(0, np.int64)
        self.end = self.begin + lengths
        self.breaks = self.end[:-1]
        self.starts = starts_of(self.codes, self.breaks)

    def words(self) -> tuple[list[str], np.ndarray]:
        """All pieces in order, breaks among them, and the index of each segment's first."""
        bounds = [*self.starts.tolist(), len(self.joined)]
        joined = self.joined
        words = [joined[a:b] for a, b in zip(bounds, bounds[1:])]
        return words, np.searchsorted(self.starts, self.begin)


def _split(text: str, specials: dict[str, int]):
    """Parts of a text: (segment, None) or ("", id of a special string), leftmost first."""
    at = 0
    if any(name in text for name in specials):
        while found := min(((p, -len(s), s) for s in specials if (p := text.find(s, at)) >= 0), default=None):
            yield text[at : found[0]], None
            yield "", specials[found[2]]
            at = found[0] + len(found[2])
    yield text[at:], None


class Vocabulary:
    """A byte-level BPE file: token bytes, merges and special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        alphabet = {letter: byte for byte, letter in enumerate(_letters())}
        self.token_bytes = {i: bytes(alphabet[c] for c in name) for name, i in data["model"]["vocab"].items()}
        self.ids = {name: i for i, name in self.token_bytes.items()}
        self.specials = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.token_bytes |= {i: name.encode() for name, i in self.specials.items()}
        vocab = data["model"]["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in data["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.pair_keys, self.pair_order = np.unique((left << 32) | right, return_index=True)
        self.ranks = dict(zip(zip(left.tolist(), right.tolist(), strict=True), range(len(pairs)), strict=True))
        self.byte_ids = np.array([self.ids.get(bytes([b]), -1) for b in range(256)], np.int64)


def _letters() -> str:
    """The letter that stands for each byte in a byte-level vocabulary: itself if visible, else the next free one."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return "".join(chr(b if b in visible else next(spare)) for b in range(0x100))


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)
