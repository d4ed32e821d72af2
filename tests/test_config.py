"""Configuration readers (S4-S8), sink option checks (K13), state folds."""

import json
import os

import pytest
from pyspark.sql import functions as F

from riverbed.operators import metrics as M
from riverbed.sinks import state as ST
from riverbed.sinks.messages import check_sink_options
from riverbed.sources import config as C
from tests.fixtures.sessions import depot


def write(tmp, name, obj):
    p = os.path.join(tmp, name)
    with open(p, "w") as f:
        json.dump(obj, f, indent=2)
    return p


def test_read_session_file(spark, tmpdir_path):
    p = write(tmpdir_path, "session.json", depot())
    tm, cm = C.read_session(spark, p)
    t = {r["sp_table"]: r for r in tm.collect()}
    assert {k: (r["src_table"], r["shard_col"], r["src_pk_count"]) for k, r in t.items()} == {
        "stock": ("depot_stock", "region", 2), "couriers": ("drivers", None, 1)}
    cols = {r["sp_col"] or r["src_col"]: r for r in cm.collect()}
    assert cols["region"]["src_col"] is None and cols["audited_by"]["sp_col"] is None
    assert (cols["sku"]["sp_pk_ord"], cols["sku"]["src_pk_ord"], cols["qty"]["src_col_pos"]) == (2, 2, 3)


@pytest.mark.parametrize("text", ["{", '{"SpSchema": 5}', "[]", "{}", ""])
def test_session_file_that_cannot_be_read_is_an_error(spark, tmpdir_path, text):
    p = os.path.join(tmpdir_path, "broken.json")
    with open(p, "w") as f:
        f.write(text)
    with pytest.raises(Exception):
        tm, _ = C.read_session(spark, p)
        assert tm.collect()


def test_read_shards_sorted_and_type_checked(spark, tmpdir_path):
    shards = [{"logicalShardId": s, "host": "h" + s, "user": "u", "password": "p", "port": "3306", "dbName": "d"}
              for s in ("shardB", "shardA")]
    p = write(tmpdir_path, "shards.json", shards)
    assert [r["logicalShardId"] for r in C.read_shards(spark, p).collect()] == ["shardA", "shardB"]
    with pytest.raises(ValueError):
        C.read_shards(spark, p, "oracle")
    bad = os.path.join(tmpdir_path, "bad.json")
    with open(bad, "w") as f:
        f.write("[{not json")
    with pytest.raises(Exception):
        C.read_shards(spark, bad).collect()


def test_cluster_profile_and_contexts(spark, tmpdir_path):
    p = write(tmpdir_path, "kafka.json", {"bootstrapServer": "b", "dataTopic": "d", "errorTopic": "e"})
    prof = C.read_cluster_profile(spark, p)
    assert prof.collect()[0]["dataTopic"] == "d"
    shards = spark.createDataFrame([("shardB", "h", "1", "u", "p", "d"), ("shardA", "h", "1", "u", "p", "d")],
                                   "logicalShardId string, host string, port string, user string, password string, "
                                   "dbName string")
    ctx = C.processing_contexts(shards, prof, "kafka")
    assert sorted((r["logicalShardId"], r["partition_id"]) for r in ctx.collect()) == [("shardA", 0), ("shardB", 1)]
    assert "password" not in ctx.columns
    assert C.processing_contexts(shards, None, "pubsub").collect()[0]["subscription_id"] in ("shardA", "shardB")
    with pytest.raises(ValueError):
        C.processing_contexts(shards, prof, "rabbit")


def test_catalog_and_shadow_schema(spark):
    df = spark.createDataFrame([], "id bigint, name string, ts timestamp")
    cat = C.catalog_from_frames(spark, {"t": (df, ["id"])})
    rows = cat.collect()
    assert [r["pk_ordinal"] for r in rows] == [1, None, None]
    assert [f.dataType.simpleString() for f in ST.shadow_schema(rows, "t").fields] == ["bigint", "timestamp"]
    tm, cm = C.session_from_dict(spark, depot())
    schema = ST.shadow_schema(C.catalog_from_session(cm, tm).collect(), "stock")
    assert [(f.name, f.dataType.simpleString()) for f in schema.fields] == [("depot", "string"), ("sku", "bigint"), ("processed_commit_ts", "timestamp")]
    assert ST.shadow_table_name("stock") == "shadow_stock"


def test_sink_options():
    check_sink_options("pubsub", {"data_topic": "a", "error_topic": "b", "endpoint": "c"})
    with pytest.raises(ValueError):
        check_sink_options("pubsub", {"data_topic": "a"})
    with pytest.raises(ValueError):
        check_sink_options("kafka", {"cluster_profile_path": "x"})


def test_metadata_progress_seen(spark):
    meta = ST.upsert_metadata(spark, None, "r1", "2024-01-01T10:26:02.707Z", "10s")
    meta = ST.upsert_metadata(spark, meta, "r1", "2024-01-01T10:00:00Z", "10s")
    r = ST.read_metadata(meta, "r1").collect()
    assert len(r) == 1 and r[0]["start_ts"].strftime("%H:%M:%S") == "10:00:00"
    assert ST.read_metadata(meta, "nope").count() == 0
    shards = spark.createDataFrame([("a",), ("b",)], "logicalShardId string")
    prog = ST.init_progress(shards, "r1")
    assert {r["created_upto"].strftime("%Y-%m-%d %H:%M") for r in prog.collect()} == {"1970-01-01 12:00"}
    upd = spark.createDataFrame([("r1", "a", "2024-01-01 00:00:00"), ("r1", "a", "1960-01-01 00:00:00")],
                                "run_id string, shard string, created_upto string") \
        .withColumn("created_upto", F.col("created_upto").cast("timestamp"))
    adv = {r["shard"]: r["created_upto"].year for r in M.advance_progress(prog, upd).collect()}
    assert adv == {"a": 2024, "b": 1970}
    files = spark.createDataFrame([("r1", "2024-01-02 00:00:00"), ("r1", "2024-01-01 00:00:00")],
                                  "run_id string, file_start_interval string") \
        .withColumn("file_start_interval", F.col("file_start_interval").cast("timestamp"))
    assert M.min_file_start(files, "r1").collect()[0]["min_start"].day == 1
    assert M.min_file_start(files, "r2").collect()[0]["min_start"] is None
    seen = spark.createDataFrame([(1, "2024-01-02 00:00:00")], "id int, created_at string")
    new = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-03 00:00:00")], "id int, created_at string")
    assert sorted((r["id"], r["created_at"]) for r in ST.record_seen(seen, new).collect()) == [
        (1, "2024-01-01 00:00:00"), (2, "2024-01-03 00:00:00")]


def test_state_tables_are_written(spark):
    for t in ("seen_ids_t", "progress_t"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    ids = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "id int, created_at string")
    ST.append_seen("seen_ids_t", ids.limit(2))
    ST.append_seen("seen_ids_t", ids)
    assert sorted(map(tuple, spark.table("seen_ids_t").collect())) == [(1, "a"), (2, "c")]
    ST.save_version(spark.createDataFrame([("r", 1)], "run string, n int"), "progress_t")
    ST.save_version(spark.table("progress_t").selectExpr("run", "n + 1 AS n"), "progress_t")
    assert [tuple(r) for r in spark.table("progress_t").collect()] == [("r", 2)]
