import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from riverbed.llm import simple8b
from riverbed.llm.simple8b import BITS, BLOCK, COUNTS


def sizes_of(n):
    return np.minimum(BLOCK, n - np.arange(-(-n // BLOCK)) * BLOCK)


def round_trip(values):
    values = np.array(values, np.uint64)
    blocks = simple8b.encode(values)
    assert np.array_equal(simple8b.decode(blocks, sizes_of(len(values))), values)
    return blocks


def plain_words(values):
    """The greedy rule, one integer after another."""
    out, at = [], 0
    while at < len(values):
        for s, (count, bits) in enumerate(zip(COUNTS.tolist(), BITS.tolist())):
            part = values[at:at + count]
            if all(v < (1 << bits) for v in part):
                word = s << 60
                for i, v in enumerate(part):
                    word |= v << (i * bits)
                out.append(word)
                at += count
                break
    return out


@pytest.mark.parametrize("n", [0, 1, 5, 239, 241, BLOCK - 1, BLOCK, BLOCK + 1, 3 * BLOCK + 17])
@pytest.mark.parametrize("top", [1, 2, 200, 49_408, 1 << 20, 1 << 60])
def test_round_trip_and_greedy_words(n, top):
    r = random.Random(n + top)
    values = [r.randrange(top) for _ in range(n)]
    blocks = round_trip(values)
    at = 0
    for k, words in enumerate(blocks.n_words.tolist()):
        if not blocks.n_escapes[k]:
            assert blocks.words[at:at + words].tolist() == plain_words(values[k * BLOCK:(k + 1) * BLOCK])
        at += words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 1 << 16), st.integers(0, (1 << 64) - 1)), max_size=600))
def test_any_integers(values):
    round_trip(values)


def test_escapes():
    wide = [(1 << 64) - 1, 1 << 60, 5, 0, (1 << 60) - 1]
    assert round_trip(wide).n_escapes.tolist() == [2]
    rare = [1] * 2000 + [1 << 50] + [1] * 2000  # one word would hold it alone, and part its neighbours
    blocks = round_trip(rare * 2)
    assert blocks.n_escapes.tolist() == [0, 1] and blocks.places[0] == 1905  # in the first block it would save one word, less than it takes
    assert len(blocks.words) < len(plain_words(rare * 2))
    assert round_trip([1 << 17] * 100).n_escapes.tolist() == [0]


def test_zeros_take_few_words():
    assert len(round_trip([0] * 2400).words) == 10
