import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F
from riverbed.llm import neardup
from tests.llm.fixtures import DOCS, empty, frame, prose, rows


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = min(5, len(w))
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def brute(data, least=0.8):
    """(doc_id, position) -> the least doc_id of its class, over all pairs."""
    sets = [shingles(r[1]) for r in data]
    parent = list(range(len(data)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = sum((a & b).values())
            total = sum((a | b).values())
            if (both / total if total else (data[i][1] or "") == (data[j][1] or "")) >= least:
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i, r in enumerate(data):
        members[find(i)].append(r[0])
    out = []
    for i, r in enumerate(data):
        ids = [d for d in members[find(i)] if d is not None]
        out.append((r[0], min(ids) if ids else None, len(members[find(i)])))
    return Counter(out)


def edited(text, edits, seed):
    r = random.Random(seed)
    w = text.split(" ")
    for _ in range(edits):
        w[r.randrange(len(w))] = f"x{r.randrange(999)}"
    return " ".join(w)


def planted():
    base = [(i, prose(40 + i, 150 + 10 * i), "en", "s", 1) for i in range(12)]
    near = [(100 + 10 * i + k, edited(base[i][1], k, 7 * i + k), "en", "s", 1) for i in range(12) for k in (0, 1, 2, 4, 7)]
    shared = prose(999, 90)  # a passage that many documents share, which doesn't make them alike
    passages = [(500 + i, shared + " " + prose(2000 + i, 90 + i), "en", "s", 1) for i in range(20)]
    return base + near + passages


def test_classes_equal_brute_force(spark):
    for data in (planted(), rows()):
        got = neardup.find(frame(spark, data, extra=True)).collect()
        assert Counter((r.doc_id, r.class_id, r.class_size) for r in got) == brute(data)


def test_one_of_each_class_stays(spark):
    data = planted() + [planted()[3], planted()[3]]
    df = frame(spark, data, extra=True)
    kept = neardup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _ in brute(data)})
    assert neardup.keep_one(empty(spark)).count() == 0 and neardup.find(empty(spark)).count() == 0


def test_hub_that_is_unlike_both_ends_of_a_link(spark):
    """Several classes share most of their text, so that they meet in the same buckets: no link is lost."""
    trunk = prose(1, 260)
    data = []
    for c in range(8):
        own = trunk + " " + prose(3000 + c, 75)
        data += [(10 * c + k, edited(own, k, 50 * c + k), "en", "s", 1) for k in range(3)]
    got = neardup.find(frame(spark, data)).collect()
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in got) == brute(data)


def test_many_near_copies_are_one_class(spark):
    base = prose(77, 200)
    data = [(i, edited(base, 2, i), "en", "s", 1) for i in range(300)] + [(1000 + i, base, "en", "s", 1) for i in range(300)]
    got = neardup.find(spark.createDataFrame(data, DOCS)).collect()
    assert {(r.class_id, r.class_size) for r in got} == {(0, 600)}


def test_single_pairs_in_a_large_bucket(spark, monkeypatch):
    """A template family of 3,000 texts, unlike each other (0.75), of which over 1,000 meet in a bucket: each planted pair is found."""
    monkeypatch.setattr(neardup, "GROUP_ROWS", 16)
    trunk = " ".join(f"t{i}" for i in range(172))
    own = lambda i: " ".join(f"o{i}x{k}" for k in range(28))
    data = [(i, f"{trunk} {own(i)}", "en", "s", 1) for i in range(3000)]
    data += [(10_000 + i, " ".join(data[i][1].split()[:180] + own(10_000 + i).split()[:20]), "en", "s", 1) for i in range(5, 3000, 75)]
    assert neardup.similarity(*(neardup.regions(data[i][1]) for i in (5, 3000))) >= 0.8
    keys = Counter(b for r in data for b in neardup.band_keys(neardup.regions(r[1])).tolist())
    assert max(keys.values()) > 1000
    assert neardup.similarity(*(neardup.regions(data[i][1]) for i in (0, 1))) < 0.8
    got = neardup.find(frame(spark, data)).collect()
    assert {(r.doc_id, r.class_id, r.class_size) for r in got} == {(i, i % 10_000, 2 if i % 10_000 % 75 == 5 else 1) for i, *_ in data}


def test_large_groups_of_common_regions(spark, monkeypatch):
    """Texts put together of few common passages, so that no region is rare: chunks of a group meet in pairs."""
    r = random.Random(8)
    passages = [prose(7000 + i, 30) for i in range(14)]
    data = [(i, " ".join(passages[k] for k in sorted(r.sample(range(14), 9))) + f" end{i}", "en", "s", 1) for i in range(60)]
    data += [(500 + i, edited(data[0][1], 1, i), "en", "s", 1) for i in range(20)]
    want = brute(data)
    monkeypatch.setattr(neardup, "GROUP_ROWS", 8)
    got = neardup.find(frame(spark, data)).collect()
    assert Counter((g.doc_id, g.class_id, g.class_size) for g in got) == want
    # without the turns before it, too: all links between texts that are classes of their own
    keys = spark.createDataFrame([(i, bytearray(neardup.hashlib.md5(t.encode()).digest()), t) for i, t, *_ in data], "doc_id long, key binary, text string")
    texts = neardup.arrow_pass(keys, neardup._regions, "regions binary", keep=("key",)).cache()
    members = keys.selectExpr("1L AS band", "key")
    labels = spark.createDataFrame([], "key binary, label binary")
    classes = neardup.components(neardup._rare_links(members, texts, labels, 0.8))
    named = keys.join(classes, "key", "left").selectExpr("doc_id", "coalesce(label, key) AS label")
    firsts = named.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n"))
    assert Counter((g.doc_id, g.class_id, g.n) for g in named.join(firsts, "label").collect()) == want


def test_coordinates_agree_as_often_as_texts_are_alike():
    r = random.Random(2)
    for n, m in ((300, 60), (40, 10), (3000, 900)):
        a = neardup.regions(" ".join(f"w{r.randrange(10**6)}" for _ in range(n)))
        b = np.sort(np.concatenate([a[:len(a) - m], neardup.regions(" ".join(f"v{r.randrange(10**6)}" for _ in range(m)))]))
        s = neardup.similarity(a, b)
        k = 1500
        agree = float((neardup.signature(a, k) == neardup.signature(b, k)).mean())
        assert abs(agree - s) < 0.06


def test_weights_count():
    """A shingle that stands there several times has so many regions."""
    a, b = neardup.regions("p q r s t " * 4), neardup.regions("p q r s t " * 8)
    one, two = shingles("p q r s t " * 4), shingles("p q r s t " * 8)
    assert abs(neardup.similarity(a, b) - sum((one & two).values()) / sum((one | two).values())) < 1e-12


def test_long_texts_are_hashed_in_segments(monkeypatch):
    text = prose(5, 4000)
    whole = neardup.word_hashes(text)
    monkeypatch.setattr(neardup, "SEGMENT", 1000)
    assert (neardup.word_hashes(text) == whole).all() and len(whole) == len(text.split())


def test_columns_of_the_names_that_marks_have(spark):
    from pyspark.sql import functions as F
    docs = frame(spark, [(i, prose(i % 3, 60), "en", "s", 1) for i in range(9)])
    odd = docs.withColumn("__key", F.lit("k")).withColumn("__label", F.lit(None).cast("string")).withColumn("__class", F.col("doc_id")).withColumn("___x", F.lit(1))
    got = neardup.keep_one(odd)
    assert got.columns == odd.columns and sorted(r.doc_id for r in got.collect()) == [0, 1, 2]
