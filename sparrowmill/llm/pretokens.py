"""Boundaries of pre-tokens by a scan over codepoint classes, without a regular expression.

The pattern of the byte-level vocabularies

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

is a finite automaton once each code point's class says what little look-ahead the pattern needs:
whether an apostrophe could open a contraction, and whether a white space is followed by something
else. A class is then a function from states to states. Composition of functions is associative and
only a few dozen distinct functions can arise, so a text is cut into blocks, all blocks are composed
side by side with a multiplication table, and the states at the block borders follow from a scan
over the blocks' products.
"""

from __future__ import annotations

import sys
from functools import cache

import numpy as np
import tiktoken

# Classes of code points, in index order. "1" and "2" are apostrophes that a one- or
# two-letter contraction ending follows; SPACE and WHITE stand before something that is not white.
LETTER, NUMBER, OTHER, QUOTE1, QUOTE2, SPACE, WHITE, RUN, END = range(9)
# What the current pre-token is, in index order. FRESH: the next code point opens one.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHER, AFTER_SPACE, IN_RUN, ENDING1, ENDING2 = range(8)
BLOCK = 128


def step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a pre-token starts at this code point)."""
    if symbol == END:
        return FRESH, False
    if state == ENDING2:
        return ENDING1, False
    if state == ENDING1:
        return FRESH, False
    if symbol in (LETTER, NUMBER, OTHER):
        own = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHER}[symbol]
        return own, state not in (own, AFTER_SPACE)
    if symbol in (QUOTE1, QUOTE2):
        if state in (IN_OTHER, AFTER_SPACE):
            return IN_OTHER, False
        return (ENDING1 if symbol == QUOTE1 else ENDING2), True
    if symbol == RUN:
        return IN_RUN, state != IN_RUN
    return (AFTER_SPACE if symbol == SPACE else FRESH), True


@cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(next state, start) by state and symbol; functions by id; the multiplication table of ids.

    Ids 0 to 8 are the symbols' own functions; the rest are found by composing until none is new.
    """
    steps = [[step(s, c) for c in range(9)] for s in range(8)]
    nexts = np.array([[x[0] for x in row] for row in steps], np.uint8)
    starts = np.array([[x[1] for x in row] for row in steps], bool)
    functions = [tuple(nexts[:, c].tolist()) for c in range(9)]
    ids = {}
    for i, f in enumerate(functions):
        ids.setdefault(f, i)
    for f in functions:  # grows while it is read
        for symbol in range(9):
            after = tuple(int(nexts[s, symbol]) for s in f)
            if after not in ids:
                ids[after] = len(functions)
                functions.append(after)
    table = np.array(
        [[ids[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint16
    )
    return nexts, starts, np.array(functions, np.uint8), table


@cache
def classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or WHITE for every code point.

    Which code points are letters, numbers and white space depends on the Unicode version. They are
    read off the tokenizer library, once a worker: an encoding of single bytes, whose pattern is one
    class, returns just the members of that class.
    """
    kinds = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    points = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF)
    single = {bytes([b]): b for b in range(256)}
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\s")):
        reader = tiktoken.Encoding(pattern, pat_str=pattern, mergeable_ranks=single, special_tokens={})
        members = bytes(reader.encode_ordinary(points)).decode()
        kinds[np.frombuffer(members.encode("utf-32-le"), np.uint32)] = kind
    return kinds


def symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The class of each code point; ``ends`` are the indexes of the marks behind the texts."""
    found = classes()[points]
    found[ends] = END
    white = found == WHITE
    following = np.append(found[1:], END)
    last = white & (following != WHITE) & (following != END)
    found[white] = RUN
    found[last] = np.where(points[last] == 0x20, SPACE, WHITE)
    quotes = np.flatnonzero((points == ord("'")) & (found == OTHER))
    if len(quotes):
        padded = np.append(points, [0, 0])
        live = np.append(found != END, [False, False])
        one = np.where(live[quotes + 1], padded[quotes + 1], 0)
        two = np.where(live[quotes + 1] & live[quotes + 2], padded[quotes + 2], 0)
        found[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = QUOTE1
        pair = np.zeros(len(quotes), bool)
        for a, b in ("re", "ve", "ll"):
            pair |= (one == ord(a)) & (two == ord(b))
        found[quotes[pair]] = QUOTE2
    return found


def token_starts(found: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each code point, by the blocked scan."""
    nexts, starts, functions, table = automaton()
    n = len(found)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, END, np.uint8)
    padded[:n] = found
    columns = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    product = columns[0].astype(np.uint16)
    for column in columns[1:]:
        product = table[product, column]
    # Scan over the blocks' products by doubling; afterwards each holds the product up to itself.
    width = 1
    while width < blocks:
        product[width:] = table[product[:-width].copy(), product[width:]]
        width *= 2
    state = np.full(blocks, FRESH, np.uint8)
    state[1:] = functions[product[:-1], FRESH]
    opened = np.empty((BLOCK, blocks), bool)
    for i, column in enumerate(columns):
        opened[i] = starts[state, column]
        state = nexts[state, column]
    return opened.T.ravel()[:n]


def byte_slices(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(UTF-8 of all texts, byte offset where each pre-token starts, pre-tokens before each text).

    The last array has one entry more than there are texts: the number of all pre-tokens. A
    pre-token ends where the next one of its text starts, or at its text's end.
    """
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths + 1) - 1
    opened = token_starts(symbols(points, ends))
    widths = np.ones(len(points), np.int64)
    for limit in (0x80, 0x800, 0x10000):
        widths += points >= limit
    widths[ends] = 0
    at = np.cumsum(widths) - widths
    before = np.append(0, np.cumsum(opened)[ends])
    return "".join(texts).encode(), at[opened], before
