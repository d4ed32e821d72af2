import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from riverbed.llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """By the definition, a row at a time; all rows are as float has them."""
    kept = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(np.float32(x)) for x in v):
            continue
        kept.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = Counter()
    for k, (i, v, label) in enumerate(kept):
        if i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, m) for n, (j, w, m) in enumerate(kept) if n != k]
        for p, pid, _ in sorted(s for s in scored if s[2] == label)[:5]:
            window = sorted((s, j) for s, j, m in scored if m != label and 80 * -p <= 100 * -s <= 100 * -p)[:5]
            for rank, (s, j) in enumerate(window, 1):
                out[i, pid, rank, j, -p, -s] += 1
    return out


def found(df):
    return Counter(tuple(r) for r in hardneg.mine(df).collect())


def vectors(seed=1, n=1200, width=16, grain=None):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    out = []
    for i in range(n):
        c = r.choice(centres)
        v = [x + r.gauss(0, 0.6) for x in c]
        out.append((i * 5, [round(x * grain) / grain for x in v] if grain else v, r.randrange(4)))
    return out


@pytest.mark.parametrize("grain", [None, 1])
def test_rows_equal_the_definition(spark, monkeypatch, grain):
    """Blocks and tiles smaller than the table; whole numbers give many ties."""
    monkeypatch.setattr(hardneg, "BLOCK_ROWS", 150)
    monkeypatch.setattr(hardneg, "TILE_ROWS", 7)
    rows = vectors(grain=grain)
    want = plain(rows)
    assert len(want) > 300
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(2, 300, 8, 2)
    rows += [(None, [1.0] * 8, 1), (200_000, None, 1), (200_100, [1.0] * 8, None), (200_200, [1.0, None], 1), (200_300, [nan] * 8, 1), (200_400, [inf] * 8, 2), (200_500, [-inf] * 8, 2)]
    rows += [(300_000, [], 1), (300_100, [2.0, -1.0], 2), (300_200, [0.5] * 11, 3), (-700, [1.5] * 8, 1), (0, rows[0][1], rows[0][2])]
    rows += [(400_000, [3.0] * 8, 1)] * 3 + [(400_001, [3.0] * 8, 1)] * 2 + [(400_002, [2.5] * 8, 2)] * 7  # repeated anchors, positives and negatives
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("row", "block", "tile", "limits", "v", "place", "rank", "score"):
        df = df.withColumn(name, F.lit("clash"))
    assert found(df) == plain(rows)


def test_one_vector_has_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "BLOCK_ROWS", 100)
    rows = [(3 * i, [1.0, 2.0, 1.0], 1 + i % 2) for i in range(400)] + [(50 + 4 * i, [random.Random(i).gauss(0, 2) for _ in range(3)], i % 3) for i in range(400)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_strassen_is_exact():
    rng = np.random.default_rng(1)
    for m, k, n in [(1, 1, 1), (17, 33, 41), (64, 64, 64), (70, 65, 131), (3, 64, 200), (0, 5, 7), (20, 0, 20)]:
        a, b = rng.integers(-(1 << 40), 1 << 40, (m, k)), rng.integers(-200, 200, (k, n))
        assert np.array_equal(hardneg.strassen(a, b, leaf=4), a @ b)


def test_sql_gives_the_same_rows(spark):
    rows = vectors(4, 500, 12) + [(100_000, [float("nan")] * 12, 1), (100_100, None, 2), (100_200, [1.0] * 12, None)]
    db = duckdb.connect()
    db.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    db.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    assert Counter(tuple(r) for r in db.execute(hardneg.MINE_SQL).fetchall()) == plain(rows)


def test_empty_table(spark):
    assert hardneg.mine(spark.createDataFrame([], SCHEMA)).collect() == []
