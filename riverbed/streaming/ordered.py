"""Ordered release buffer (W1-W4, W6, W7) for ``foreachBatch``.

A micro-batch moves the event clock (``clock``); what was committed before the clock's boundary is
released in change order: everything (``emit="all"``) or, per interval, the latest change of each
key (``emit="latest"``). The rest is held.

A row that comes late, behind a boundary that has been released, goes out with the batch that brings it: no
row is ever dropped. The clock is one for the whole stream; a shard without new changes is released
with the others.

Held rows are a log in folders by the interval that releases them: a row is written once, when it comes, and read
once, when its interval is due; a batch reads the folders between two boundaries and no others. "latest" is a partial
aggregation, and a hot shard is split by ranges of its order. The layout depends on nothing but the data: no
salts, no session settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed import model
from riverbed.operators.latest import latest_per_key
from riverbed.streaming.clock import EventClock, commit_ms, span_ms
from riverbed.streaming.versions import PartitionedLog

BUFFER_COLUMNS = ["shard", "commit_ts", "commit_seconds", "commit_nanos", "server_txn_id", "record_sequence",
                  "mod_position", "table_name", "keys_json", "old_values_json", "new_values_json", "mod_type",
                  "num_records_in_txn", "txn_tag"]
BUFFER_SCHEMA = (
    "shard string, commit_ts timestamp, commit_seconds bigint, commit_nanos int, server_txn_id string, "
    "record_sequence string, mod_position int, table_name string, keys_json string, old_values_json string, "
    "new_values_json string, mod_type string, num_records_in_txn bigint, txn_tag string")


def buffered(changes: DataFrame) -> DataFrame:
    """The columns of the buffer; a change without a place in its record is its only one."""
    if model.MOD_POSITION not in changes.columns:
        changes = changes.withColumn(model.MOD_POSITION, F.lit(0))
    return changes.select(*BUFFER_COLUMNS)


def interval_ms(text: str) -> int:
    return span_ms(text)


def interval_end(interval: int):
    return (F.floor(commit_ms() / interval) + 1) * interval


class ReleaseBuffer:
    """``step(batch, batch_id)`` returns what the batch releases, with ``released_at_ms`` (the end of
    the interval that a change belongs to)."""

    def __init__(self, spark: SparkSession, path: str, interval: str = "1 second", emit: str = "all",
                 delay: str = "0 seconds", idle: str = "0 seconds", **clock):
        if emit not in ("all", "latest"):
            raise ValueError("emit must be 'all' or 'latest'")
        self.interval, self.emit = max(1, interval_ms(interval)), emit
        self.clock = EventClock(spark, f"{path}/clock", interval, delay, idle, **clock)
        self.held = PartitionedLog(spark, f"{path}/held", BUFFER_SCHEMA, "due_ms")

    def step(self, batch: DataFrame, batch_id: int, records: DataFrame | None = None) -> DataFrame:
        """``records``: all rows that came with the batch, from before any filter; they move the clock. Without them
        the batch's own rows do."""
        past, boundary = self.clock.step(batch if records is None else records, batch_id)
        self.held.drop([v for v in self.held.values() if v <= past])  # released by batches that are committed
        rows = buffered(batch).withColumn("due_ms", interval_end(self.interval))
        self.held.append(rows.where(F.col("due_ms") > boundary), batch_id)
        out = rows.where(F.col("due_ms") <= boundary).drop("due_ms")
        before = self.held.read([v for v in self.held.values() if past < v <= boundary], batch_id)
        if before is not None:
            out = out.unionByName(before)
        out = out.withColumn("released_at_ms", interval_end(self.interval))
        if self.emit == "latest":
            out = latest_per_key(out, ["shard", "released_at_ms", "table_name", "keys_json"])
        return out

    def rest(self, batch_id: int) -> DataFrame:
        """What is held after a batch."""
        boundary = self.clock._boundary(self.clock.table.read(batch_id))
        held = self.held.read([v for v in self.held.values() if v > boundary], batch_id + 1)
        return self.held.spark.createDataFrame([], BUFFER_SCHEMA) if held is None else held


def in_order(released: DataFrame) -> DataFrame:
    """Ranges of (shard, change order), sorted: the form for writers that keep a shard's order."""
    order = ["shard", *model.order_columns(released)]
    return released.repartitionByRange(*order).sortWithinPartitions(*order)


def release_batch(changes: DataFrame, emit: str = "all", interval: str | None = None) -> DataFrame:
    """Batch twin of W1/W2 for a complete (closed) input: everything is released; with
    ``emit="latest"`` the latest change per key, of each interval if one is given."""
    rows = buffered(changes)
    if emit == "all":
        return rows
    if interval is None:
        return latest_per_key(rows, ["shard", "table_name", "keys_json"])
    rows = rows.withColumn("released_at_ms", interval_end(interval_ms(interval)))
    return latest_per_key(rows, ["shard", "released_at_ms", "table_name", "keys_json"])


def split_late(df: DataFrame, high_water: str | None, delay: str = "0 seconds") -> tuple[DataFrame, DataFrame]:
    """Split a micro-batch into (on time, late) against a high-water commit time (the
    max commit seen so far, kept by the caller between batches)."""
    if high_water is None:
        return df, df.limit(0)
    limit = F.lit(high_water).cast("timestamp") - F.expr(f"INTERVAL {delay}")
    return df.where(F.col("commit_ts") >= limit), df.where(F.col("commit_ts") < limit)
