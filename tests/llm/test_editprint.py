import hashlib
import random
from collections import Counter

import numpy as np
from riverbed.llm import editprint
from tests.llm.fixtures import DOCS, empty, frame, prose, rows


def slow_print(text):
    """The walk, character by character and step by step."""
    states = editprint._states()
    points = [ord(c) for c in text]
    written, j = [], 0
    for c in points:
        k = int(editprint._CLASS[c & 0xFFFF])
        here = states[j % editprint.STATES]
        stay = (here[k][256] - j) % editprint.STATES or editprint.STATES
        written += [c] * stay
        j += stay
    if not written:
        return "0:0:"
    level = 0
    while -(-len(written) // (1 << level)) > editprint.SAMPLES:
        level += 1
    steps = editprint.sampled_steps(level, -(-len(written) // (1 << level)))
    bits = [(int(editprint.mix64(np.array([s], np.uint64) * editprint._STEP + np.uint64(written[s] if s < len(written) else 0))[0]) >> 31) & 1 for s in steps]
    return f"{level}:{len(bits)}:{np.packbits(np.array(bits, np.uint8)).tobytes().hex()}"


def test_walk_equals_the_plain_one():
    for t in ["", "a", "aaaa", "Ünï 😀 x", prose(3, 30), prose(4, 400)]:
        assert editprint.fingerprint(t) == slow_print(t)


def test_prints_of_the_edited_texts(spark):
    data = rows()
    got = editprint.edited_prints(frame(spark, data, extra=True)).collect()
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = Counter()
    for i, r in enumerate(order):
        text, nxt = r[1] or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edit = text[:len(text) - half] + nxt[:half]
        a, b, c = map(editprint.fingerprint, (text, edit, nxt))
        want[r[0], len(text), hashlib.sha256(edit.encode()).hexdigest(), a, b, round(editprint.likeness(a, b), 9), round(editprint.likeness(a, c), 9)] += 1
    assert Counter((g.doc_id, g.n_chars, g.edited_sha256, g.fingerprint, g.edited_fingerprint, round(g.near_edited, 9), round(g.near_next, 9)) for g in got) == want


def test_one_document_and_none(spark):
    (r,) = editprint.edited_prints(spark.createDataFrame([(5, "alone here", "en", "s", 1)], DOCS)).collect()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"alonealone").hexdigest()
    assert editprint.edited_prints(empty(spark)).count() == 0 and editprint.near_classes(empty(spark)).count() == 0


def test_likeness_falls_with_edits():
    r = random.Random(9)
    means = []
    for edits in (0, 1, 4, 16):
        got = []
        for seed in range(40):
            w = prose(seed, 300).split(" ")
            a = " ".join(w)
            for _ in range(edits):
                w[r.randrange(len(w))] = "zq"
            got.append(editprint.likeness(editprint.fingerprint(a), editprint.fingerprint(" ".join(w))))
        means.append(sum(got) / len(got))
    assert means[0] == 1.0 and means[0] > means[1] > means[2] > means[3] and means[1] > 0.85
    # texts of unlike characters agree by chance only; those of one small vocabulary meet now and then
    letters = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz 0123456789") for _ in range(2000))
    strange = [editprint.likeness(editprint.fingerprint(letters()), editprint.fingerprint(letters())) for _ in range(40)]
    other = [editprint.likeness(editprint.fingerprint(prose(i, 300)), editprint.fingerprint(prose(5000 + i, 300))) for i in range(40)]
    assert sum(strange) / 40 < 0.12 and sum(other) / 40 < means[3]


def test_levels_are_nested():
    t = prose(1, 2000)
    fine = editprint.parse(editprint.fingerprint(t))
    steps = editprint.sampled_steps(fine[0], len(fine[1]))
    above = editprint.sampled_steps(fine[0] + 1, len(fine[1]) // 2)
    assert set(above.tolist()) <= set(steps.tolist())
    assert (editprint.coarser(*fine, fine[0] + 1)[:len(above)] == fine[1][np.searchsorted(steps, above)]).all()


def test_every_segment_has_bands():
    """Characters changed in one place of a text leave the bands of the other segments."""
    for where in (0.02, 0.5, 0.95):
        met = 0
        for seed in range(60):
            t = prose(seed, 250)
            at = int(where * len(t))
            met += bool(np.intersect1d(editprint.bands(editprint.fingerprint(t)), editprint.bands(editprint.fingerprint(t[:at] + "QXZ" + t[at + 3:]))).size)
        assert met >= 54, (where, met)
    assert editprint.bands(editprint.fingerprint("")).size == 0 and editprint.bands(editprint.fingerprint("ab")).size
    strange = [set(editprint.bands(editprint.fingerprint(prose(9000 + i, 250))).tolist()) for i in range(40)]
    assert sum(len(a & b) > 0 for i, a in enumerate(strange) for b in strange[:i]) < 80


def test_a_range_is_a_task(spark):
    data = [(i, prose(i, 20), "en", "s", 1) for i in range(400)]
    from pyspark.sql import functions as F
    got = editprint.edited_prints(frame(spark, data)).select("doc_id", F.spark_partition_id().alias("part")).collect()
    ids = {}
    for r in got:
        ids.setdefault(r.part, []).append(r.doc_id)
    assert len(got) == 400 and max(map(len, ids.values())) <= 40
    assert all(max(x) - min(x) + 1 == len(x) for x in ids.values())  # neighbours only


def test_near_classes_find_small_edits(spark):
    data = []
    for i in range(15):
        t = prose(i, 250)
        data += [(10 * i, t, "en", "s", 1), (10 * i + 1, t, "en", "s", 1), (10 * i + 2, t[:-6] + "endend", "en", "s", 1)]
    got = {r.doc_id: r.class_id for r in editprint.near_classes(frame(spark, data)).collect()}
    assert all(got[10 * i + k] == 10 * i for i in range(15) for k in range(3))
