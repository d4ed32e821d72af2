"""Buffer sources (S2 framing, S3 files), late split (W7), redistribution (W10),
dead letters / skip location (K10, K11), ordered-topic publisher (K2), PK columns (J7),
and plan shapes (pushdown, broadcast, partial aggregation)."""

import json
import os

from pyspark.sql import functions as F

from riverbed import model
from riverbed.operators import transforms as T
from riverbed.operators.latest import latest_per_key
from riverbed.operators.lookup import pk_columns
from riverbed.operators.mapping import map_tables
from riverbed.sinks.files import dead_letters, write_skipped
from riverbed.sinks.messages import ordered_topic_frame, publish_batches
from riverbed.sources.changes import kafka_options, kafka_rows_to_buffer, read_buffer_files, read_changes
from riverbed.sources.config import catalog_from_session, session_from_dict
from riverbed.streaming.ordered import split_late
from tests.fixtures.sessions import depot


def test_kafka_options_and_framing(spark):
    opts = kafka_options({"bootstrapServer": "b:9092", "dataTopic": "t"}, {"shardA": 0, "shardB": 1})
    assert json.loads(opts["assign"]) == {"t": [0, 1]} and opts["startingOffsets"] == "earliest"
    assert "maxOffsetsPerTrigger" not in opts
    capped = kafka_options({"bootstrapServer": "b:9092", "dataTopic": "t"}, {"shardA": 0, "shardB": 1}, max_per_shard=2000)
    assert capped["maxOffsetsPerTrigger"] == "4000"
    rows = spark.createDataFrame([(bytearray(b"shardA"), bytearray(b'{"x":1}'), 0, 5)],
                                 "key binary, value binary, partition int, offset long")
    r = kafka_rows_to_buffer(rows).collect()[0]
    assert (r["shard"], r["value"], r["offset"]) == ("shardA", '{"x":1}', 5)


def test_buffer_files_stream_with_shard_filter(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "buf")
    os.makedirs(p)
    with open(os.path.join(p, "a.json"), "w") as f:
        for s in ("s1", "s2", "s1"):
            f.write(json.dumps({"shard": s, "value": "{}"}) + "\n")
    assert read_buffer_files(spark, p, shard="s1", streaming=False).count() == 2
    q = (read_buffer_files(spark, p, shard="s2").writeStream.format("memory").queryName("buf_s2")
         .option("checkpointLocation", os.path.join(tmpdir_path, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert spark.sql("select count(*) c from buf_s2").collect()[0]["c"] == 1


def test_split_late(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-01 01:00:00",)], "t string") \
        .select(F.col("t").cast("timestamp").alias("commit_ts"))
    on_time, late = split_late(df, "2024-01-01 00:30:00")
    assert on_time.count() == 1 and late.count() == 1
    assert split_late(df, None)[1].count() == 0


def test_redistribute_keeps_keys_together(spark):
    df = spark.createDataFrame([("t", f"k{i % 3}", i) for i in range(30)], "table_name string, keys_json string, i int")
    parts = T.redistribute(df, 4).withColumn("p", F.spark_partition_id())
    assert parts.groupBy("keys_json").agg(F.countDistinct("p").alias("n")).where("n > 1").count() == 0


def test_dead_letters_and_skip(spark, tmpdir_path):
    df = spark.createDataFrame([("skip", "x", "bad"), ("s1", "y", None)], "shard string, v string, error string")
    dl = dead_letters(df.where("error is not null"), "stage1").collect()[0]
    assert dl["stage"] == "stage1" and json.loads(dl["record"]) == {"shard": "skip", "v": "x"}
    write_skipped(df.drop("error"), os.path.join(tmpdir_path, "skip"))
    assert spark.read.json(os.path.join(tmpdir_path, "skip")).count() == 1


def test_publish_batches(spark):
    df = spark.createDataFrame([(f"s{i % 2}", i) for i in range(7)], "shard string, i int")
    df = (df.withColumn("server_txn_id", F.lpad(F.col("i").cast("string"), 4, "0"))
          .withColumn("record_sequence", F.lit("0")).withColumn("commit_seconds", F.lit(1).cast("long"))
          .withColumn("commit_nanos", F.lit(0)).withColumn("table_name", F.lit("t"))
          .withColumn("keys_json", F.lit("{}")).withColumn("old_values_json", F.lit("{}"))
          .withColumn("new_values_json", F.lit("{}")).withColumn("mod_type", F.lit("INSERT"))
          .withColumn("num_records_in_txn", F.lit(1).cast("long")).withColumn("txn_tag", F.lit("")))
    acc = spark.sparkContext.accumulator(0)

    def publish(batch):
        assert len(batch) <= 2 and len({b[0] for b in batch}) == 1 and batch[0][1]["shardId"] == batch[0][0]
        acc.add(len(batch))

    publish_batches(ordered_topic_frame(df), publish, max_messages=2)
    assert acc.value == 7


def test_pk_columns(spark):
    tm, cm = session_from_dict(spark, depot())
    rows = pk_columns(catalog_from_session(cm, tm), "stock").orderBy("pk_ordinal").collect()
    assert [(r["column_name"], r["stream_type"]) for r in rows] == [("depot", "STRING"), ("sku", "INT64")]


def test_scan_pushdown_and_pruning(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "changes")
    spark.createDataFrame([], model.CHANGE_RECORD).write.parquet(p)
    df = read_changes(spark, p, "2024-01-01 00:00:00", "2024-01-02 00:00:00").select("server_txn_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(commit_ts), GreaterThanOrEqual(commit_ts" in plan
    assert "ReadSchema: struct<commit_ts:timestamp,server_txn_id:string>" in plan


def test_mapping_is_broadcast_and_latest_is_partial(spark):
    tm, _ = session_from_dict(spark, depot())
    ch = spark.createDataFrame([("stock", "{}", 1, 0, "a", "0")],
                               "table_name string, keys_json string, commit_seconds long, commit_nanos int, "
                               "server_txn_id string, record_sequence string")
    assert "BroadcastHashJoin" in map_tables(ch, tm)._jdf.queryExecution().executedPlan().toString()
    plan = latest_per_key(ch)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_default_start_is_one_instant(spark):
    """What is committed after the scan was set up belongs to it, however much later it is read."""
    import time

    from riverbed.sources.changes import bound_changes
    df = bound_changes(spark.range(1).select(F.current_timestamp().alias("commit_ts")))
    time.sleep(0.2)
    assert df.count() == 1
    assert bound_changes(spark.range(1).select((F.current_timestamp() - F.expr("INTERVAL 1 hour")).alias("commit_ts"))).count() == 0


def test_ordered_output_follows_the_commit_time(spark, tmpdir_path):
    """Transaction ids that run against the commit times: the commit time decides."""
    df = spark.createDataFrame([(f"s{i % 2}", i, f"{99 - i:04d}") for i in range(30)], "shard string, i int, server_txn_id string")
    df = (df.withColumn("commit_seconds", F.lit(1_700_000_000).cast("long") + F.col("i")).withColumn("commit_ts", F.timestamp_seconds("commit_seconds")).withColumn("commit_nanos", F.lit(0))
          .withColumn("record_sequence", F.lit("0")).withColumn("table_name", F.lit("t")).withColumn("keys_json", F.lit("{}")).withColumn("old_values_json", F.lit("{}"))
          .withColumn("new_values_json", F.concat(F.lit('{"i":'), "i", F.lit("}"))).withColumn("mod_type", F.lit("INSERT")).withColumn("num_records_in_txn", F.lit(1).cast("long")).withColumn("txn_tag", F.lit("")))
    out = os.path.join(tmpdir_path, "sent")
    os.makedirs(out)

    def publish(batch):
        for key, _, data in batch:
            with open(os.path.join(out, key), "a") as f:
                f.write(json.loads(data)["mods"][0]["newValuesJson"] + "\n")

    publish_batches(ordered_topic_frame(df.orderBy(F.rand(1))), publish, max_messages=4)
    for s in (0, 1):
        with open(os.path.join(out, f"s{s}")) as f:
            assert [json.loads(x)["i"] for x in f] == list(range(s, 30, 2))
    from riverbed.sinks.files import write_windowed
    files = os.path.join(tmpdir_path, "windows")
    write_windowed(df.orderBy(F.rand(2)), files, "1h")
    for base, _, names in os.walk(files):
        lines = [json.loads(json.loads(x)["record"])["commitTimestamp"]["seconds"] for n in sorted(names) if n.endswith(".json") for x in open(os.path.join(base, n))]
        assert lines == sorted(lines)
