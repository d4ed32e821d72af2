"""Ordered topic: commit and abort (K2), capped pull with acknowledgement (S3)."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from riverbed.sinks.messages import flushes
from riverbed.sinks.topic import Topic, buffer_rows, read_topic, subscribe, write_topic


def frame(spark, rows):
    """Rows key, number: a message each, in the order of the numbers."""
    df = spark.createDataFrame(rows, "ordering_key string, n long")
    return df.select("ordering_key", F.create_map(F.lit("shardId"), F.col("ordering_key")).alias("attributes"), F.concat(F.lit("m"), "n").alias("data"),
                     F.col("n").alias("commit_seconds"), F.lit(0).alias("commit_nanos"), F.lit("t").alias("server_txn_id"), F.lit("0").alias("record_sequence"))


def by_key(df):
    out = {}
    for r in df.orderBy("position").collect():
        out.setdefault(r["ordering_key"], []).append((r["position"], r["data"]))
    return out


def numbered(*numbers):
    return [(i + 1, f"m{n}") for i, n in enumerate(numbers)]


def test_flushes_by_number_size_and_time():
    assert [len(x) for x in flushes(range(250), lambda m: 1)] == [100, 100, 50]
    assert [len(x) for x in flushes(range(10), lambda m: 40_000)] == [3, 3, 3, 1]
    ticks = iter([0, 0.05, 0.1, 0.11, 0.3, 0.31])
    assert list(flushes("abcdef", lambda m: 1, clock=lambda: next(ticks))) == [["a", "b"], ["c", "d"], ["e", "f"]]
    assert list(flushes([], len)) == []


def test_order_and_positions_over_batches(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "topic")
    assert read_topic(spark, path).count() == 0
    hot = [("hot", n) for n in range(1500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small tasks, as large data has
    try:
        write_topic(frame(spark, [*reversed(hot), ("b", 7), ("b", 3), (None, 5)]), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    write_topic(frame(spark, [("b", 9), ("hot", 1500), ("c", 1)]), path)
    write_topic(frame(spark, []), path)
    got = by_key(read_topic(spark, path))
    assert got == {"hot": numbered(*range(1501)), "b": numbered(3, 7, 9), None: numbered(5), "c": numbered(1)}
    first = by_key(read_topic(spark, path, max_messages=2))
    assert first == {k: v[:2] for k, v in got.items()}
    files = [f for f in Topic(path).listing(0)["files"] if any(k == "hot" for k, _ in f["runs"])]
    assert len(files) > 1  # a hot key is several tasks' work
    assert Topic(path).listing(2)["files"] == []


def test_a_failed_write_leaves_nothing_visible(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "topic")
    write_topic(frame(spark, [("a", 1)]), path)
    bad = frame(spark, [("a", n) for n in range(2, 200)]).withColumn("data", F.when(F.col("commit_seconds") == 150, F.raise_error(F.lit("lost"))).otherwise(F.col("data")))
    with pytest.raises(Exception, match="lost"):
        write_topic(bad, path)
    assert by_key(read_topic(spark, path)) == {"a": numbered(1)}
    write_topic(frame(spark, [("a", 2)]), path)
    assert by_key(read_topic(spark, path)) == {"a": numbered(1, 2)}


def test_a_batch_counts_once(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "topic")
    for batch in (0, 0, 1, 1):
        write_topic(frame(spark, [("a", 10 * batch + n) for n in range(3)]), path, batch)
    assert by_key(read_topic(spark, path)) == {"a": numbered(0, 1, 2, 10, 11, 12)}
    listed = {f["name"] for b in (0, 1) for f in Topic(path).listing(b)["files"]}
    assert {"messages/" + os.path.basename(f) for f in glob.glob(path + "/messages/*.arrow")} == listed
    with pytest.raises(Exception, match="behind"):
        Topic(path).commit(0, [])


def pull(spark, path, folder, most, seen, until=None, fail_at=None):
    """One run of a subscription; ``seen`` gets (key, positions) of every micro-batch that was handled."""
    def handle(batch, batch_id):
        got = {}
        for r in batch.collect():
            got.setdefault(r["ordering_key"], []).append(r["position"])
        if fail_at is not None and len(seen) == fail_at:
            raise RuntimeError("stopped before the write")
        seen.append((batch_id, {k: sorted(v) for k, v in got.items()}))

    q = (subscribe(spark, path, "shards", most).writeStream.option("checkpointLocation", os.path.join(folder, "ck"))
         .trigger(processingTime="0 seconds").foreachBatch(handle).start())
    try:
        for _ in range(600):
            if not q.isActive or (until is not None and sum(len(v) for _, b in seen for v in b.values()) >= until):
                break
            q.awaitTermination(0.2)
    except Exception as e:
        if fail_at is None or "stopped before" not in str(e):
            raise
    finally:
        q.stop()


def test_capped_pull_over_restarts(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "topic")
    write_topic(frame(spark, [("hot", n) for n in range(95)] + [("b", n) for n in range(12)]), path)
    seen = []
    pull(spark, path, tmpdir_path, 20, seen, fail_at=2)  # ends before its third batch is written
    assert [b for _, b in seen] == [{"hot": [*range(1, 21)], "b": [*range(1, 13)]}, {"hot": [*range(21, 41)]}]
    write_topic(frame(spark, [("b", n) for n in range(12, 40)]), path)
    pull(spark, path, tmpdir_path, 20, seen, until=95 + 12)
    pull(spark, path, tmpdir_path, 20, seen, until=95 + 40)
    write_topic(frame(spark, [("c", 1)]), path)
    pull(spark, path, tmpdir_path, 20, seen, until=95 + 40 + 1)
    assert all(len(v) <= 20 for _, b in seen for v in b.values())
    last = {i: b for i, b in seen}  # a batch that runs again has the same messages
    assert all(last[i] == b for i, b in seen)
    got = {}
    for i in sorted(last):
        for k, v in last[i].items():
            got.setdefault(k, []).extend(v)
    assert got == {"hot": [*range(1, 96)], "b": [*range(1, 41)], "c": [1]}
    with open(path + "/subscriptions/shards/acknowledged.json") as f:
        acked = json.load(f)
    assert all(acked[json.dumps(k)] <= len(v) for k, v in got.items() if json.dumps(k) in acked)


def test_topic_as_stream_sink(spark, tmpdir_path):
    source, path = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "topic")
    for n in range(3):
        frame(spark, [("a", 10 * n + i) for i in range(4)]).coalesce(1).write.mode("append").parquet(source)
    from riverbed.sinks.topic import register
    register(spark)
    df = spark.readStream.schema("ordering_key string, attributes map<string,string>, data string").option("maxFilesPerTrigger", 1).parquet(source)
    for _ in range(2):  # the second run finds nothing new
        q = df.writeStream.format("ordered_topic").option("path", path).option("checkpointLocation", os.path.join(tmpdir_path, "ck")).trigger(availableNow=True).start()
        q.awaitTermination(120)
    got = by_key(read_topic(spark, path))
    assert len(Topic(path).batches()) == 3 and sorted(d for _, d in got["a"]) == sorted(f"m{10 * n + i}" for n in range(3) for i in range(4))
    assert buffer_rows(read_topic(spark, path)).columns == ["shard", "value"]
