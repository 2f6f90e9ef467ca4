"""Where the pre-tokens of byte-level BPE begin, without regular expressions.

The pattern is public_tokenizers.PATTERN: contractions, then letters, digits or other signs, each with
one leading space at most, then white space. Every code point gets a class from a table; a class with
what follows (a contraction, the end of a run of white space) is a symbol; and a symbol is a function
from state to state. Functions compose associatively: equal blocks of symbols are folded into one
function each, side by side; the blocks' functions are scanned by doubling; then every block runs once
more from its known first state and writes which symbols begin a pre-token.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np
from tokenizers.pre_tokenizers import ByteLevel

LETTER, DIGIT, OTHER, SPACE, WHITE = range(5)
# Symbols beyond the five classes: apostrophes that open a contraction of two or three characters,
# a space or another white character just before a text sign, and the gap between two texts.
SHORT, LONG, LAST_SPACE, LAST_WHITE, GAP = range(5, 10)
# States: nothing open; a space waits; in letters, digits, others; one or two signs of a contraction
# are still to come; in white space.
FRESH, SPACED, LETTERS, DIGITS, OTHERS, ONE, TWO, WHITES = range(8)

# The code points of the Unicode property White_Space.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
# What may follow an apostrophe in a contraction.
SHORT_ENDS, LONG_ENDS = "stmd", ("re", "ve", "ll")

BLOCK = 256
UNKNOWN = 255


@lru_cache(1)
def class_table() -> np.ndarray:
    """Class of every code point from its general category, UNKNOWN where Python's tables have none."""
    kind = {"L": LETTER, "N": DIGIT}

    def of(category: str) -> int:
        return UNKNOWN if category == "Cn" else kind.get(category[0], OTHER)

    table = np.fromiter((of(unicodedata.category(chr(c))) for c in range(sys.maxunicode + 1)), np.uint8)
    table[list(WHITE_SPACE)] = WHITE
    table[0x20] = SPACE
    return table


def classes(codes: np.ndarray) -> np.ndarray:
    """Class of every code point. Those newer than Python's tables are looked up once, in the tokenizers library."""
    out = class_table()[codes]
    if (out == UNKNOWN).any():
        joins = ByteLevel(add_prefix_space=False).pre_tokenize_str
        for code in np.unique(codes[out == UNKNOWN]).tolist():
            fits = [k for k, before in ((LETTER, "a"), (DIGIT, "1")) if len(joins(before + chr(code))) == 1]
            class_table()[code] = fits[0] if fits else OTHER
        out = class_table()[codes]
    return out


@lru_cache(1)
def machine() -> tuple[np.ndarray, np.ndarray]:
    """next[symbol, state] and begins[symbol, state]."""
    after = np.zeros((10, 8), np.uint8)
    begins = np.ones((10, 8), bool)
    for symbol, state in ((LETTER, LETTERS), (DIGIT, DIGITS), (OTHER, OTHERS)):
        after[symbol] = state
        begins[symbol, [SPACED, state]] = False
    for symbol, state in ((SHORT, ONE), (LONG, TWO)):
        after[symbol] = state
        after[symbol, [SPACED, OTHERS]] = OTHERS
        begins[symbol, [SPACED, OTHERS]] = False
    # Within a contraction only its letters can come, so any other symbol may count as at a fresh start.
    after[LETTER, [ONE, TWO]] = FRESH, ONE
    begins[LETTER, [ONE, TWO]] = False
    for symbol in (SPACE, WHITE):
        after[symbol] = WHITES
        begins[symbol, WHITES] = False
    after[LAST_SPACE], after[LAST_WHITE], after[GAP] = SPACED, FRESH, FRESH
    begins[[LAST_SPACE, LAST_WHITE, GAP]] = True
    return after, begins


def symbols(codes: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """The symbol of every code point; `gaps` are the positions between texts."""
    out = classes(codes)
    out[gaps] = GAP
    follows = np.empty(len(out), np.uint8)
    follows[:-1], follows[-1] = out[1:], GAP
    white = (out == SPACE) | (out == WHITE)
    last = np.flatnonzero(white & (follows <= OTHER))
    out[last] += LAST_SPACE - SPACE
    at = np.flatnonzero((codes[:-1] == ord("'")) & (follows[:-1] == LETTER))
    first = codes[at + 1]
    out[at[np.isin(first, [ord(c) for c in SHORT_ENDS])]] = SHORT
    at, first = at[at + 2 < len(codes)], first[at + 2 < len(codes)]
    second = codes[at + 2]
    for a, b in LONG_ENDS:
        out[at[(first == ord(a)) & (second == ord(b))]] = LONG
    return out


def composed(f: np.ndarray, g: np.ndarray) -> np.ndarray:
    """First f, then g; rows of state functions."""
    return np.take_along_axis(g, f, axis=1)


def first_states(functions: np.ndarray) -> np.ndarray:
    """State before each block, from an inclusive scan by doubling over the blocks' functions."""
    done, step = functions.astype(np.intp), 1
    while step < len(done):
        done = np.concatenate([done[:step], composed(done[:-step], done[step:])])
        step *= 2
    return np.concatenate([[FRESH], done[:-1, FRESH]])


def begins(codes: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """True where a pre-token begins; gaps count as one."""
    n = len(codes)
    rows = -(-n // BLOCK)
    padded = np.full(rows * BLOCK, GAP, np.uint8)
    padded[:n] = symbols(codes, gaps)
    blocks = padded.reshape(rows, BLOCK)
    columns = np.ascontiguousarray(blocks.T).astype(np.intp) * 8
    after, begin = machine()
    after, begin = after.ravel().astype(np.intp), begin.ravel()

    def fold(columns: np.ndarray, state: np.ndarray) -> np.ndarray:
        for column in columns:
            state += column
            np.take(after, state, out=state, mode="clip")
        return state

    # A symbol with a constant function makes that of its whole block constant, so one run will do.
    ends = fold(columns, np.zeros(rows, np.intp))
    functions = np.repeat(ends[:, None], 8, axis=1)
    open_rows = np.flatnonzero(~(blocks >= LAST_SPACE).any(axis=1))
    for state in range(8) if len(open_rows) else ():
        functions[open_rows, state] = fold(columns[:, open_rows], np.full(len(open_rows), state, np.intp))
    now = first_states(functions)
    out = np.empty((BLOCK, rows), bool)
    for j, column in enumerate(columns):
        now += column
        np.take(begin, now, out=out[j], mode="clip")
        np.take(after, now, out=now, mode="clip")
    return np.ascontiguousarray(out.T).ravel()[:n]


def joined_starts(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts joined by a gap each, where their pre-tokens and the gaps begin in it, and where texts end,
    each with the gap behind it. All in code points."""
    joined = "\0".join(texts)
    ends = np.cumsum([len(t) + 1 for t in texts])
    if not joined:
        return joined, np.zeros(0, np.intp), ends
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    return joined, np.flatnonzero(begins(codes, ends[:-1] - 1)), ends


def byte_slices(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts joined in UTF-8, first byte and bytes of every pre-token, and for every text the number of
    pre-tokens up to its end. A gap between texts is a pre-token of no bytes."""
    joined, starts, ends = joined_starts(texts)
    data = joined.encode()
    cut = np.searchsorted(starts, ends)
    gaps = cut[:-1] - 1
    if len(data) > len(joined):
        # Where characters begin: at all bytes but 10xxxxxx.
        starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)[starts]
    sizes = np.diff(starts, append=len(data))
    if len(starts):
        sizes[gaps] = 0
    return data, starts, sizes, cut


def split_all(texts: list[str]) -> tuple[list[str], list[tuple[int, int]]]:
    """Pre-tokens of all texts in one list, and the range of each text in it."""
    joined, starts, ends = joined_starts(texts)
    if not joined:
        return [], [(0, 0)] * len(texts)
    bounds = starts.tolist()
    bounds.append(len(joined))
    words = [joined[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
    # A gap is a pre-token of its own behind its text; the last text has none behind it.
    cut = np.searchsorted(starts, ends).tolist()
    stops = [stop - 1 for stop in cut[:-1]] + cut[-1:]
    return words, list(zip([0, *cut[:-1]], stops, strict=True))


def split(texts: list[str]) -> list[list[str]]:
    """Pre-tokens of every text."""
    words, ranges = split_all(texts)
    return [words[a:b] for a, b in ranges]
