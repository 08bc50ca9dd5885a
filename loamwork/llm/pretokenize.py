"""Where byte-level BPE cuts a text, without a regular expression.

The pattern is public_tokenizers.PATTERN: contractions ('s 't 're 've 'm 'll 'd), runs
of letters, of numbers and of other characters, each with a space before it if there is
one, and runs of white space. Every code point gets a class from an array; the class
already tells what follows (a contraction's letters, or whether a white space is the
last of its run). An automaton over these classes knows at each place whether a slice
begins. Its transitions are functions on states; composing functions is associative,
and all functions that arise form a small table, so the states before all places come
from a scan that doubles its reach with one table look-up for each place, until every
composed function is constant.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import tiktoken

LETTER, NUMBER, MARK, QUOTE1, QUOTE2, SPACE, BREAK, BLANK = range(8)
#: States: nothing open, in a run (letters, numbers, marks), after a leading space, in
#: white space, and with one or two letters of a contraction to come.
OPEN, IN_LETTERS, IN_NUMBERS, IN_MARKS, LED, IN_BLANK, ONE_LEFT, TWO_LEFT = range(8)
N_STATES = 8


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The next state, and whether a slice begins at this character."""
    if kind in (LETTER, NUMBER, MARK):
        if kind == LETTER and state in (ONE_LEFT, TWO_LEFT):
            return (OPEN if state == ONE_LEFT else ONE_LEFT), False
        run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, MARK: IN_MARKS}[kind]
        return run, state not in (run, LED)
    if kind in (QUOTE1, QUOTE2):
        if state in (IN_MARKS, LED):
            return IN_MARKS, False
        return (ONE_LEFT if kind == QUOTE1 else TWO_LEFT), True
    if kind == SPACE:
        return LED, True
    if kind == BREAK:
        return OPEN, True
    return IN_BLANK, state != IN_BLANK


@cache
def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Function numbers by class; composition table; whether constant, and its value; slice starts by state and class."""
    functions = [tuple(_step(s, k)[0] for s in range(N_STATES)) for k in range(8)]
    functions += [(s,) * N_STATES for s in range(N_STATES)]
    known = {f: n for n, f in reversed([*enumerate(functions)])}
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in list(known):
            for h in (tuple(g[x] for x in f), tuple(f[x] for x in g)):
                if h not in known:
                    known[h] = len(functions)
                    functions.append(h)
                    todo.append(h)
    number = np.array([known[f] for f in functions], np.int32)
    table = np.array([[known[tuple(g[x] for x in f)] for g in functions] for f in functions], np.int32)
    constant = np.array([len(set(f)) == 1 for f in functions])
    value = np.array([f[0] for f in functions], np.uint8)
    begins = np.array([[_step(s, k)[1] for k in range(8)] for s in range(N_STATES)])
    return number, table, constant, value, begins


@cache
def _classes() -> np.ndarray:
    """LETTER, NUMBER, MARK or BLANK of every code point, as tiktoken's own \\p{L}, \\p{N} and \\s have it."""
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    ranks = {bytes([b]): b for b in range(256)}
    out = np.full(0x110000, MARK, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (BLANK, r"\s")):
        found = bytes(tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(everything)).decode()
        out[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return out


def slice_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where slices begin in UTF-8 texts end to end; each text begins anew at its offset."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    places = np.arange(n) if len(points) == n else np.flatnonzero((data & 0xC0) != 0x80)
    begin = np.unique(offsets[:-1][offsets[:-1] < offsets[1:]])
    first = begin if len(points) == n else np.searchsorted(places, begin)
    kind = _classes()[points]
    last = np.zeros(len(points), bool)
    last[first[1:] - 1] = True
    last[-1] = True
    # white space: the last of a run with something after it stands apart
    blank = kind == BLANK
    followed = np.zeros(len(points), bool)
    followed[:-1] = ~blank[1:]
    followed &= ~last & blank
    kind[followed] = BREAK
    kind[followed & (points == 32)] = SPACE
    # apostrophes with the letters of a contraction after them
    quotes = np.flatnonzero(points == 39)
    if len(quotes):
        padded = np.append(points, [0, 0])
        end = np.append(last, [True, True])
        one, two = padded[quotes + 1], padded[quotes + 2]
        inside = ~end[quotes]
        kind[quotes[inside & np.isin(one, [*map(ord, "stmd")])]] = QUOTE1
        both = inside & ~end[quotes + 1] & np.isin(one * 256 + two, [ord(a) * 256 + ord(b) for a, b in ("re", "ve", "ll")]) & (two < 256)
        kind[quotes[both]] = QUOTE2
    number, table, constant, value, begins = _automaton()
    f = number[kind]
    f[first] = _constant_from_open(kind[first], number)
    reach, size, flat = 1, len(table), table.ravel()
    while not constant[f].all():
        f[reach:] = flat[f[:-reach] * size + f[reach:]]
        reach *= 2
    before = np.empty(len(points), np.uint8)
    before[1:] = value[f[:-1]]
    before[first] = OPEN
    return places[begins.ravel()[before.astype(np.int32) * 8 + kind]]


def _constant_from_open(kinds: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The constant functions that stand for one character read in the state OPEN."""
    after = np.array([_step(OPEN, k)[0] for k in range(8)])
    return number[8 + after[kinds]]
