"""Event clock (W6): how far every partition of the change stream has come.

The low watermark is the least of the latest commits of the stream's partitions (``partition_token``): all that was committed
before it is in. Every row moves the clock, also one that a later step filters, skips or sends to the dead
letters. A partition that hasn't delivered anything for ``idle`` of processing time is left out until it delivers again, so that
one without changes doesn't hold the others; with no time given only the partitions of the batch at hand count.
Boundaries never go back."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.streaming.versions import VersionedTable
from riverbed.streaming.windows import size_micros


def commit_ms() -> Column:
    return F.col("commit_seconds") * 1000 + F.floor(F.col("commit_nanos") / 1_000_000)


def span_ms(text: str) -> int:
    return size_micros(text) // 1000


class EventClock:
    """``step(records, batch_id)`` gives (boundary before the batch, boundary after it): the last multiple of
    ``interval``, counted from the epoch, that the low watermark less ``delay`` has passed. A batch that runs again gets
    the boundary that its first run wrote, whatever the time is by then."""

    def __init__(self, spark: SparkSession, path: str, interval: str = "1 second", delay: str = "0 seconds",
                 idle: str = "0 seconds", now_ms=lambda: time.time_ns() // 1_000_000):
        self.interval, self.delay, self.idle = max(1, span_ms(interval)), span_ms(delay), span_ms(idle)
        self.now_ms = now_ms
        # a row per partition that isn't idle (as many as the stream has), and one for the boundary
        self.table = VersionedTable(spark, path, "token string, high_ms bigint, seen_ms bigint, boundary_ms bigint")

    def _boundary(self, version: DataFrame | None) -> int:
        return 0 if version is None else version.where("boundary_ms IS NOT NULL").first()["boundary_ms"]

    def step(self, records: DataFrame, batch_id: int) -> tuple[int, int]:
        before = self.table.before(batch_id)
        past = self._boundary(before)
        if self.table.exists(batch_id):
            return past, self._boundary(self.table.read(batch_id))
        now = self.now_ms()
        token = F.coalesce("partition_token", F.lit("")) if "partition_token" in records.columns else F.lit("")
        seen = records.groupBy(token.alias("token")).agg(F.max(commit_ms()).alias("high_ms")).where("high_ms IS NOT NULL").withColumn("seen_ms", F.lit(now))
        if before is not None:
            seen = seen.unionByName(before.where("boundary_ms IS NULL").drop("boundary_ms"))
        known = seen.groupBy("token").agg(F.max("high_ms").alias("high_ms"), F.max("seen_ms").alias("seen_ms"))
        rows = known.where(F.col("seen_ms") >= now - self.idle).collect()  # the stream's partitions, a few numbers each
        low = min((r["high_ms"] for r in rows), default=None)
        boundary = past if low is None else max(past, (low - self.delay) // self.interval * self.interval)
        state = [(r["token"], r["high_ms"], r["seen_ms"], None) for r in rows] + [(None, None, None, boundary)]
        self.table.write(records.sparkSession.createDataFrame(state, self.table.schema), batch_id)
        return past, boundary
