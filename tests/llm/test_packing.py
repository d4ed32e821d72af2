import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from riverbed.llm import packing
from tests.llm.fixtures import empty, frame, rows
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_places(got, capacity):
    by = defaultdict(list)
    for g in got:
        by[g.sequence_id].append((g.offset, g.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return by


def test_pieces_and_places(spark):
    t = Tokenizer.from_file(PATH)
    got = packing.pack(frame(spark, extra=True), PATH).collect()
    want = Counter()
    for i, text, *_ in rows():
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            want[i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((g.doc_id, g.piece, g.start, g.length, g.ids_crc32) for g in got) == want
    by = check_places(got, 2048)
    assert len(by) <= -(-sum(g.length for g in got) // 2048) + 1


def test_plan_places_every_piece_once():
    r = random.Random(1)
    for _ in range(30):
        counts = {r.randrange(1, 65): r.randrange(1, 50) for _ in range(r.randrange(1, 40))}
        patterns = packing.plan(counts, 64)
        used = Counter()
        for p in patterns:
            assert sum(p.lengths) <= 64 and p.copies > 0
            for x in p.lengths:
                used[x] += p.copies
        assert dict(used) == counts
        lower = max(-(-sum(x * n for x, n in counts.items()) // 64), sum(n for x, n in counts.items() if x > 32))
        assert sum(p.copies for p in patterns) <= max(lower + 1, 1.23 * lower + 1)  # best-fit decreasing's bound is 11/9


def test_exact_fits_fill_completely():
    counts = {40: 5, 24: 3, 30: 2, 20: 7, 14: 2, 64: 4}
    for p in packing.exact_fits(dict(counts), 64):
        assert sum(p.lengths) == 64


def test_hot_length_is_numbered_in_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 10)
    data = [(i, "one two three", "en", "s", 1) for i in range(500)] + [(1000 + i, "word " * i, "en", "s", 1) for i in range(20)]
    got = packing.pack(frame(spark, data), PATH, capacity=64).collect()
    assert len(check_places(got, 64)) <= -(-sum(g.length for g in got) // 64) + 1
    assert len(got) == 520


def test_empty_table(spark):
    assert packing.pack(empty(spark), PATH).count() == 0
