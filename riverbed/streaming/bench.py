"""Streaming throughput for the bench: Q1 (release latest -> statements) and Q3 (release
all -> buffer messages) over the events change stream landed as files in commit order,
run with ``availableNow``; records per second of input."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from riverbed.operators import dml as D
from riverbed.operators import sharding as S
from riverbed.operators import transforms as T
from riverbed.sinks.messages import buffer_messages
from riverbed.sources import tables as TB
from riverbed.sources.changes import read_changes
from riverbed.sources.config import cached_session
from riverbed.session import ensure_checkpoint_dir
from riverbed.streaming.jobs import start
from riverbed.streaming.ordered import ReleaseBuffer, in_order


def land(spark: SparkSession, sf_dir: str, folder: str, chunks: int = 8) -> int:
    recs = TB.event_changes(TB.load(spark, sf_dir, "events"))
    recs = recs.withColumn("_c", F.ntile(chunks).over(Window.orderBy("commit_ts", "server_txn_id", "record_sequence")))
    recs = recs.cache()
    n = recs.count()
    for i in range(1, chunks + 1):
        recs.where(F.col("_c") == i).drop("_c").coalesce(1).write.mode("append").parquet(folder)
    marker = (recs.limit(1).drop("_c").withColumn("commit_ts", F.lit("2031-01-01").cast("timestamp"))
              .withColumn("commit_seconds", F.unix_seconds("commit_ts")).withColumn("txn_tag", F.lit(""))
              .withColumn("table_name", F.lit("__marker__")))
    marker.write.mode("append").parquet(folder)
    recs.unpersist()
    return n


def _run(spark, src_dir, ckpt, emit, prepare, write):
    src = prepare(read_changes(spark, src_dir, start="2000-01-01 00:00:00", streaming=True, max_files_per_trigger=1))
    buffer = ReleaseBuffer(spark, ckpt + "-buffer", "1 hour", emit)
    t0 = time.perf_counter()
    q = start(src, lambda batch, batch_id: write(buffer.step(batch, batch_id)), "bench", available_now=True, checkpoint=ckpt)
    q.awaitTermination()
    return time.perf_counter() - t0


def stream_rates(spark: SparkSession, sf_dir: str) -> dict:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-bench-{uuid.uuid4().hex[:8]}"
    n = land(spark, sf_dir, folder + "/in")
    tm, cm = cached_session(spark, TB.EVENTS_SESSION)

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    t1 = _run(spark, folder + "/in", folder + "/ck1", "latest", lambda src: S.shard_by_mod(T.explode_mods(T.filter_changes(src)), "UserId", 500),
              lambda out: noop(D.render_dml(out.drop("released_at_ms"), tm, cm, "mysql").select("shard", "dml")))
    t3 = _run(spark, folder + "/in", folder + "/ck3", "all", lambda src: S.shard_by_image(T.explode_mods(T.filter_changes(src)), tm, lookup_deletes=False).where(F.col("shard_error").isNull()).drop("shard_error"),
              lambda out: noop(in_order(buffer_messages(out, pretty=False)).select("shard", "value")))
    return {"q1_direct_replication_stream": round(n / t1, 1), "q3_stream_to_buffer_stream": round(n / t3, 1),
            "records": n, "seconds": {"q1": round(t1, 2), "q3": round(t3, 2)}}
