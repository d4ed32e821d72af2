import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F
from riverbed.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """By the definition, over dictionaries."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in by.items()}
    rebuilt = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    out = set()
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for key in members:
        if key:
            kids[key[:-1]] += 1
    for key, cs in members.items():
        cost = (len(cs) - 1) * len(key[-1][1]) if key else 0
        for d in range(len(key) + 1):
            leaves[key[:d]] += key not in kids
            saved[key[:d]] += cost
    for key, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(rebuilt[c]) == len(key))))
        out.add((min(cs), len(key), min(members[key[:-1]]) if key else None, len(cs), kids[key], leaves[key], saved[key], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def found(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = [tuple(r) for r in prefixtrie.trie(df, **how).collect()]
    assert len(set(got)) == len(got)
    return set(got)


def some(seed=1, convs=400, turns=9, words=3):
    r = random.Random(seed)
    rows = [(c, t, r.choice(["user", "assistant"]), r.choice(["a", "bb", "ccc", "dddd"][:words])) for c in r.sample(range(1500), convs) for t in range(r.randrange(1, turns))]
    copies = [(2000 + k, t, "user", x) for k in range(60) for t, x in enumerate(["hello", "there", "again", "and", "again", "and", "over"])]
    odd = [(None, 1, "user", "nobody's"), (1501, None, "user", "first"), (1501, 0, None, "second"), (1501, 3, "user", None), (1501, 3, "user", "tied"), (1501, 3, "user", "tied"),
           (-7, 1, "user", "below zero"), (-200, 1, "user", "below zero"), (1600, 0, "", ""), (1601, 0, None, None), (1602, 5, "user", "x" * 70_000)]
    return rows + copies + odd


@pytest.mark.parametrize("band", [2, 3, 16])
def test_nodes_equal_the_definition(spark, band):
    rows = some()
    assert found(spark, rows, band=band) == plain(rows)


def test_long_conversations(spark, monkeypatch):
    """More turns than a chunk of the scan and several rounds of bands; one conversation has most rows."""
    monkeypatch.setattr(prefixtrie, "CHUNK", 16)
    r = random.Random(2)
    long = [(r.choice(["user", "assistant"]), r.choice("abc")) for _ in range(700)]
    rows = [(900, t, *x) for t, x in enumerate(long)]
    rows += [(901 + k, t, *x) for k in range(6) for t, x in enumerate(long[:100 * k + 50] + [("user", f"other {k}")] * (k % 3))]
    assert found(spark, rows, band=4) == plain(rows)


def test_many_conversations_end_in_one_node(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "RUN_IDS", 7)
    rows = [(c, 0, "user", "the same") for c in random.Random(3).sample(range(10**6), 900)]
    assert found(spark, rows) == plain(rows)


def test_sql_gives_the_same_rows(spark):
    rows = [x for x in some(5, 150) if x[0] != 1501]  # tied turns have another order there
    spark.createDataFrame(rows, SCHEMA).createOrReplaceTempView("conversations_of_test")
    db = duckdb.connect()
    db.register("given", spark.createDataFrame(rows, SCHEMA).toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    db.execute("CREATE TABLE conversations AS SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, role, text FROM given")
    got = {tuple(r) for r in db.execute(prefixtrie.TRIE_SQL).fetchall()}
    assert got == plain(rows)


def test_other_columns_and_empty_table(spark):
    rows = some(7, 40)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("pos", "depth", "x", "a", "band", "own", "leaf", "chunk", "size", "h"):
        df = df.withColumn(name, F.lit("clash"))
    assert {tuple(r) for r in prefixtrie.trie(df).collect()} == plain(rows)
    assert prefixtrie.trie(spark.createDataFrame([], SCHEMA)).collect() == []
