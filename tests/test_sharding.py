"""Shard assignment (A1-A7), partitions (O3/J8), as-of lookup (J4) against brute force."""

import json

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from riverbed.operators import sharding as S
from riverbed.operators.lookup import asof_lookup, shadow_filter, tables_without_shadow
from riverbed.sources.config import session_from_dict
from tests.fixtures.sessions import depot

SCHEMA = ("table_name string, keys_json string, new_values_json string, mod_type string, commit_ts timestamp, "
          "commit_seconds long, commit_nanos int, server_txn_id string, record_sequence string")


def change(table, keys, new, mod, secs, txn="t", seq="0"):
    import datetime
    ts = datetime.datetime.fromtimestamp(secs, datetime.UTC).replace(tzinfo=None)
    return (table, json.dumps(keys), json.dumps(new), mod, ts, secs, 0, txn, seq)


def test_modulo_shard_keeps_sign(spark):
    df = spark.createDataFrame([change("t", {"UserId": "-7"}, {}, "INSERT", 1),
                                change("t", {"UserId": "12"}, {}, "INSERT", 1)], SCHEMA)
    out = sorted((r["user_id"], r["shard"]) for r in S.shard_by_mod(df, n=5).collect())
    assert out == [(-7, "-2"), (12, "2")]


def stock(sku, new, mod, secs, **more):
    return change("stock", {"depot": "a", "sku": sku, **more}, new, mod, secs, seq=f"{sku}{secs:04d}")


DELETES = [stock("1", {"region": "north", "qty": 1}, "INSERT", 100), stock("1", {"region": "south"}, "UPDATE", 110), stock("1", {}, "DELETE", 111),
           stock("1", {}, "DELETE", 105), stock("1", {}, "DELETE", 300), stock("2", {}, "DELETE", 300), stock("3", {"qty": 5}, "UPDATE", 10),
           stock("4", {}, "DELETE", 20, region="east")]


def test_column_shard_takes_deletes_from_row_versions(spark):
    tm, _ = session_from_dict(spark, depot())
    got = {r["record_sequence"]: (r["shard"], r["drop_reason"]) for r in S.shard_by_column(spark.createDataFrame(DELETES, SCHEMA), tm).collect()}
    # at 111 the version of 110 is a second old and counts; at 105 the one of 100
    assert got == {"10100": ("north", None), "10110": ("south", None), "10111": ("south", None), "10105": ("north", None), "10300": ("south", None),
                   "20300": (None, S.NO_VERSION), "30010": (None, S.NO_SHARD_COLUMN), "40020": ("east", None)}


def test_image_shard_takes_deletes_from_row_versions(spark):
    tm, _ = session_from_dict(spark, depot())
    rows = DELETES + [change("vans", {"id": "1"}, {}, "DELETE", 5, seq="v"), stock("5", {"region": None}, "INSERT", 7), stock("6", {"region": "a/b"}, "INSERT", 7),
                      stock("7", {"region": "new"}, "UPDATE", 7, region="old")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["record_sequence"]: (r["shard"], r["shard_error"]) for r in S.shard_by_image(df, tm).collect()}
    assert got == {"10100": ("north", None), "10110": ("south", None), "10111": ("south", None), "10105": ("north", None), "10300": ("south", None),
                   "20300": (None, S.NO_VERSION), "30010": (None, S.NO_SHARD_COLUMN), "40020": ("east", None), "v": ("skip", None),
                   "50007": (None, "shard id is null"), "60007": ("a/b", "shard id contains '/'"), "70007": ("new", None)}
    # a scan that begins later finds what was stored before
    early, late = df.where("commit_seconds <= 110"), df.where("commit_seconds > 110")
    stored = S.stored_versions(early, tm)
    after = {r["record_sequence"]: r["shard"] for r in S.shard_by_image(late, tm, stored=stored).collect()}
    assert after == {"10111": "south", "10300": "south", "20300": None}


def test_constant_shard(spark):
    df = spark.createDataFrame(DELETES, SCHEMA)
    shards = spark.createDataFrame([("shardB",), ("shardA",)], "logicalShardId string")
    assert {r["shard"] for r in S.shard_constant(df, shards).collect()} == {"shardA"}
    assert S.shard_mode(shards) == "multi"


def test_partition_numbers(spark):
    shards = spark.createDataFrame([("shardB",), ("shardA",)], "logicalShardId string")
    assert sorted((r["logicalShardId"], r["partition"]) for r in S.partition_numbers(shards).collect()) == [
        ("shardA", 0), ("shardB", 1)]


def test_shard_udf(spark):
    df = spark.createDataFrame([change("t", {"id": "1"}, {"region": "eu"}, "INSERT", 1)], SCHEMA)

    def factory(params):
        prefix = params

        def fn(table, record):
            return f"{prefix}-{record['region']}"
        return fn

    out = S.shard_by_udf(df, factory, "p", with_latency=True).collect()[0]
    assert out["shard"] == "p-eu" and out["shard_latency_ms"] >= 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40), st.booleans()), min_size=1, max_size=40))
def test_asof_matches_brute_force(spark, events):
    rows = [(f"k{k}", t, str(i), "v" if is_version else "p") for i, (k, t, is_version) in enumerate(events)]
    df = spark.createDataFrame(rows, "key string, commit_seconds long, server_txn_id string, kind string")
    df = df.withColumn("commit_nanos", F.lit(0)).withColumn("record_sequence", F.lit("0"))
    versions = df.where("kind = 'v'").withColumn("val", F.col("server_txn_id"))
    probes = df.where("kind = 'p'").select("key", "commit_seconds", "commit_nanos", "server_txn_id",
                                           "record_sequence")
    got = {(r["server_txn_id"]): r["val"] for r in
           asof_lookup(probes, versions, ["key"], ["val"], lag_seconds=1, bucket_seconds=7).collect()}
    want = {}
    for i, (k, t, is_v) in enumerate(events):
        if is_v:
            continue
        cands = [(t2, str(j)) for j, (k2, t2, v2) in enumerate(events) if v2 and k2 == k and t2 <= t - 1]
        want[str(i)] = max(cands)[1] if cands else None
    assert got == want


def test_shadow_filter(spark):
    ch = spark.createDataFrame([("a", 1, 10), ("a", 2, 10), ("a", 3, 10)], "t string, k int, c int") \
        .withColumn("commit_ts", F.timestamp_seconds("c"))
    shadow = spark.createDataFrame([("a", 1, 11), ("a", 2, 10)], "t string, k int, s int") \
        .withColumn("processed_commit_ts", F.timestamp_seconds("s"))
    keep, skip = shadow_filter(ch, shadow, ["t", "k"])
    assert sorted(r["k"] for r in keep.collect()) == [2, 3] and [r["k"] for r in skip.collect()] == [1]


def test_tables_without_shadow(spark):
    t = spark.createDataFrame([("a",), ("b",), ("shadow_a",), ("shadow_x",)], "table_name string")
    assert sorted(r["table_name"] for r in tables_without_shadow(t).collect()) == ["b"]
