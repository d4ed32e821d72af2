"""Simple-8b: as many integers as fit go into each 64-bit word.

The four high bits of a word are its selector, which tells how many integers of how many bits
the other sixty hold (two selectors stand for runs of zeros). A word takes the selector that holds the
most of the next integers. Integers are coded in blocks of BLOCK; a block's words come first, then
its escapes: integers of more than sixty bits, and rare ones so wide that they would force
their neighbours into words of their own. An escape has a zero in its place among the words and stands in a
list of places and values. Blocks don't depend on each other, so that a table of their offsets is
all that is needed to decode any of them.

Both directions work on many blocks at a time: a step of the encoder chooses one word of every block, the decoder
unpacks all words of one selector at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Integers of a block; their places fit into sixteen bits.
BLOCK = 4096
#: Integers per word and bits of each, by selector (fixed values of the format).
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
#: A width that all but this share of a block's integers have is tried as the widest that isn't escaped.
RARE = 1 / 64

_PAD = int(COUNTS.max())
_U = np.uint64


@dataclass
class Blocks:
    """Coded blocks: ``words`` and the escapes of all of them, and how many belong to each block."""

    words: np.ndarray
    n_words: np.ndarray
    places: np.ndarray
    values: np.ndarray
    n_escapes: np.ndarray


def _widths(rows: np.ndarray) -> np.ndarray:
    """Bits of integers of sixty bits at most. (Rounding matters beyond 53 bits only, where one selector is left.)"""
    return np.minimum(np.frexp(rows.astype(np.float64))[1], 60).astype(np.uint8)


def _choices(widths: np.ndarray) -> np.ndarray:
    """For each place the selector that holds most of what begins there. ``widths`` has _PAD zeros behind each row.
    The widest of each run of n is the wider one of two shorter runs that cover it."""
    length = widths.shape[1] - _PAD
    widest, have = {1: widths}, 1
    choice = np.full((len(widths), length), len(BITS) - 1, np.uint8)
    for s in range(len(BITS) - 2, -1, -1):
        n = int(COUNTS[s])
        while 2 * have <= n:  # runs of powers of two
            run = widest[have]
            widest[2 * have] = np.maximum(run[:, :run.shape[1] - have], run[:, have:])
            have *= 2
        run, shift = widest[have], n - have
        most = np.maximum(run[:, :length], run[:, shift:shift + length])
        choice[most <= BITS[s]] = s
    return choice


def _words(rows: np.ndarray, widths: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of blocks of integers of at most sixty bits, and their number by block. ``rows`` has a block in each
    row, of which the first ``sizes`` are meant and the others are zero, and so has ``widths``; _PAD zeros follow."""
    n, stride = rows.shape
    choice = _choices(widths)
    at, words = np.zeros(n, np.int64), []
    live = np.flatnonzero(sizes > 0)
    while len(live):
        here = at[live]
        selector = choice[live, here]
        words.append((live, here, selector))
        here = here + COUNTS[selector]
        at[live] = here
        live = live[here < sizes[live]]
    if not words:
        return np.zeros(0, _U), np.zeros(n, np.int64)
    block, place, selector = (np.concatenate(x) for x in zip(*words))
    order = np.argsort(block.astype(np.uint16) if n < 1 << 16 else block, kind="stable")  # steps are ascending places of a block
    block, place, selector = block[order], place[order], selector[order]
    out, flat, first = selector.astype(_U) << _U(60), rows.ravel(), block * stride + place
    for s in np.unique(selector).tolist():
        if BITS[s]:
            here = np.flatnonzero(selector == s)
            start, packed = first[here], np.zeros(len(here), _U)
            for k in range(COUNTS[s]):
                packed |= flat[start + k] << _U(k * BITS[s])
            out[here] |= packed
    return out, np.bincount(block, minlength=n)


def encode(values: np.ndarray) -> Blocks:
    """All integers of ``values`` (unsigned, up to 64 bits), in blocks of BLOCK; the last may be shorter."""
    n = -(-len(values) // BLOCK)
    rows = np.zeros((n, BLOCK + _PAD), _U)
    whole = len(values) // BLOCK
    rows[:whole, :BLOCK] = values[:whole * BLOCK].reshape(whole, BLOCK)
    rows[whole:, :len(values) - whole * BLOCK] = values[whole * BLOCK:]
    sizes = np.minimum(BLOCK, len(values) - np.arange(n) * BLOCK)
    least = rows >= (_U(1) << _U(60))
    escaped, values = least.copy(), rows
    if least.any():
        rows = np.where(least, _U(0), rows)
    widths = _widths(rows)
    words, n_words = _words(rows, widths, sizes)
    limit, most = np.full(n, 60), widths.max(axis=1, initial=0)
    held = lambda width: COUNTS[np.searchsorted(BITS, width)]
    for bits in sorted({int(b) for b in BITS if 0 < b < 60}, reverse=True):  # the narrowest that all but few have
        wide = np.count_nonzero(widths > bits, axis=1)
        # an escape saves at most one word and what its own word holds less: with less than half of it it can't pay
        limit[(wide > 0) & (wide <= RARE * sizes) & (2 * held(most) <= held(bits))] = bits
    narrow = np.flatnonzero(limit < 60)
    if len(narrow):  # both ways; the shorter one stands
        wide = widths[narrow] > limit[narrow][:, None]
        other, n_other = _words(np.where(wide, _U(0), rows[narrow]), np.where(wide, np.uint8(0), widths[narrow]), sizes[narrow])
        gain = 8 * (n_words[narrow] - n_other) - 10 * wide.sum(axis=1)
        parts, others = np.split(words, np.cumsum(n_words)[:-1]), np.split(other, np.cumsum(n_other)[:-1])
        for k in np.flatnonzero(gain > 0).tolist():
            parts[narrow[k]], escaped[narrow[k]] = others[k], wide[k] | escaped[narrow[k]]
        words, n_words = np.concatenate(parts), np.array([len(p) for p in parts])
    block, place = np.nonzero(escaped)
    return Blocks(words, n_words, place.astype(np.uint16), values[block, place], np.bincount(block, minlength=n))


def decode(blocks: Blocks, sizes: np.ndarray) -> np.ndarray:
    """The integers of the blocks, of which each has ``sizes``."""
    n, stride = len(blocks.n_words), BLOCK + _PAD
    block = np.repeat(np.arange(n), blocks.n_words)
    selector = (blocks.words >> _U(60)).astype(np.int64)
    before = np.cumsum(COUNTS[selector]) - COUNTS[selector]
    first = np.cumsum(blocks.n_words) - blocks.n_words
    place = before - np.repeat(before[np.minimum(first, max(0, len(before) - 1))], blocks.n_words) if len(before) else before
    out = np.zeros(n * stride, _U)
    for s in np.unique(selector).tolist():
        if BITS[s]:
            here = np.flatnonzero(selector == s)
            got = (blocks.words[here][:, None] >> (np.arange(COUNTS[s]) * BITS[s]).astype(_U)) & ((_U(1) << _U(BITS[s])) - _U(1))
            out[(block[here] * stride + place[here])[:, None] + np.arange(COUNTS[s])] = got
    out[np.repeat(np.arange(n), blocks.n_escapes) * stride + blocks.places] = blocks.values
    return out.reshape(n, stride)[np.arange(stride) < np.asarray(sizes)[:, None]]
