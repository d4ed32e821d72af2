"""Streaming jobs (Q1-Q5) on Structured Streaming: readStream -> operators -> foreachBatch.

Each micro-batch is written, then the checkpoint commits the source offsets (the reference
acknowledges messages after the write). All that a job remembers lies under one folder: ``checkpoint``, or
the job's name under the cluster's shared checkpoint folder. A job started again with the same folder goes on
where it stopped: offsets, held changes, shadow rows, row versions, failed shards and the default start instant.

``source`` is a stream of change records, or a ``ChangeSource`` that the job opens itself: without a start of its own it
begins at the instant of the job's first start, also after a restart.

Every change that enters a job is written, superseded by a later change of its key, held, skipped by
rule (loop-back tag, skip shard) or in the dead letters. A job without ``dead_letter_path`` fails the batch
instead of losing what should go there."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed import model
from riverbed.operators import dml as D
from riverbed.operators import lookup as L
from riverbed.operators import sharding as S
from riverbed.operators import transforms as T
from riverbed.operators.latest import latest_per_key
from riverbed.operators.mapping import table_specs
from riverbed.session import stream_checkpoint
from riverbed.sinks.database import write_and_report
from riverbed.sinks.files import DeadLetters, read_dead_letters
from riverbed.sources.changes import launch_instant, read_changes
from riverbed.streaming.meters import Meter
from riverbed.streaming.ordered import ReleaseBuffer, in_order
from riverbed.streaming.versions import KeyedLog, PartitionedLog, VersionedTable
from riverbed.streaming.windows import size_micros


def start(df: DataFrame, handler, name: str, trigger: str | None = "1 second", available_now: bool = False,
          checkpoint: str | None = None):
    """Run ``handler(batch_df, batch_id)`` per micro-batch (polling interval = trigger)."""
    w = df.writeStream.queryName(name).option("checkpointLocation", stream_checkpoint(df.sparkSession, name, checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.foreachBatch(handler).start()


def start_instant(spark: SparkSession, name: str, checkpoint: str | None = None) -> str:
    """The instant of a job's first start, for scans without a start of their own (S1): kept beside the
    checkpoint, so that a restart begins where the first start did and its offsets lead on from there."""
    path = stream_checkpoint(spark, name, checkpoint).rstrip("/") + "-start"
    kept = VersionedTable(spark, path, "start string")
    if not kept.exists(0):
        kept.write(spark.createDataFrame([(launch_instant(),)], "start string"), 0)
    return kept.read(0).first()["start"]


@dataclass(frozen=True)
class ChangeSource:
    """Change records as files, opened by the job that reads them."""

    path: str
    fmt: str = "parquet"
    start: str | None = None
    end: str | None = None
    max_files_per_trigger: int | None = None

    def open(self, spark: SparkSession, name: str, checkpoint: str | None) -> DataFrame:
        begin = self.start or start_instant(spark, name, checkpoint)
        return read_changes(spark, self.path, begin, self.end, True, self.fmt, self.max_files_per_trigger)


def _opened(source: DataFrame | ChangeSource, spark: SparkSession, name: str, checkpoint: str | None) -> DataFrame:
    return source.open(spark, name, checkpoint) if isinstance(source, ChangeSource) else source


def _idle(idle: str | None, available_now: bool) -> str:
    """A run over what is there doesn't wait for partitions that have nothing more to give."""
    return idle or ("0 seconds" if available_now else "10 seconds")


class FailedShards:
    """W4 fail-stop memory: shards whose writes failed, a table with a version per batch (a row per stopped shard)."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = VersionedTable(spark, path, "shard string, error string, batch_id bigint")
        self.none = spark.createDataFrame([], self.table.schema)

    def before(self, batch_id: int) -> DataFrame:
        known = self.table.before(batch_id)
        return self.none if known is None else known

    def record(self, failed: DataFrame, batch_id: int, resumed: list[str] = ()) -> None:
        """``failed`` stop from this batch on, ``resumed`` don't any more. A shard that is stopped already keeps its batch."""
        still = self.before(batch_id).where(~F.col("shard").isin(list(resumed)))
        new = failed.select("shard", "error", F.lit(batch_id).cast("bigint").alias("batch_id"))
        first = F.struct("batch_id", "error")
        self.table.write(still.unionByName(new).groupBy("shard").agg(F.min(first).alias("f")).select("shard", "f.error", "f.batch_id"), batch_id)


class RowVersions:
    """The shard that each row had after each of its changes (A6): what a delete's shard is looked up in, besides
    its own batch. A log in folders by time bucket; a batch adds its own changes and a lookup reads the buckets up
    to the delete's commit.

    ``retain`` (None: all): buckets that end so long before the newest change are folded into one base, the last version of each
    row; of older times only that one is known. A delete that comes so late that it would need another one finds none and is a
    dead letter: never a wrong shard. ``stored`` adds versions that are older than the job."""

    KEY = ["table_name", "keys_json"]

    def __init__(self, spark: SparkSession, path: str, stored: DataFrame | None, bucket: str = "1 day", retain: str | None = None):
        schema = "table_name string, keys_json string, commit_seconds bigint, commit_nanos int, server_txn_id string, record_sequence string, mod_position int, shard_version string"
        self.log = PartitionedLog(spark, path, schema, "bucket")
        self.base = PartitionedLog(spark, path + "-base", schema, "upto")
        self.columns = [c.split()[0] for c in schema.split(", ")]
        self.stored, self.bucket = stored, size_micros(bucket) // 1_000_000
        self.retain = None if retain is None else size_micros(retain) // 1_000_000

    def upto(self, seconds: int, batch_id: int) -> DataFrame | None:
        """The versions of earlier batches that a delete with commit at most ``seconds`` can need."""
        folded = max(self.base.values(), default=None)
        values = [v for v in self.log.values() if v <= seconds // self.bucket and (folded is None or v > folded)]
        parts = [self.log.read(values, batch_id), None if folded is None else self.base.read([folded], batch_id)]
        if folded is None and self.stored is not None:
            stored = self.stored if "mod_position" in self.stored.columns else self.stored.withColumn("mod_position", F.lit(0))
            parts.append(stored.select(*self.columns))
        parts = [p for p in parts if p is not None]
        return None if not parts else parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def add(self, sharded: DataFrame, batch_id: int) -> None:
        new = sharded.where((F.col("mod_type") != "DELETE") & F.col("shard").isNotNull()).withColumnRenamed("shard", "shard_version").select(*self.columns)
        self.log.append(new.withColumn("bucket", F.floor(F.col("commit_seconds") / self.bucket)), batch_id)
        if self.retain is not None:
            self._fold(batch_id)

    def _fold(self, batch_id: int) -> None:
        """Buckets that have left the time that is kept go into the base, once each; what earlier batches folded is removed."""
        folded = max(self.base.values(), default=None)
        self.log.drop([v for v in self.log.values() if folded is not None and v <= folded])
        self.base.drop([v for v in self.base.values() if folded is not None and v < folded])
        open_ = self.log.values()
        old = [v for v in open_ if (v + 1) * self.bucket + self.retain <= open_[-1] * self.bucket]
        if old:
            rows = self.log.read(old, batch_id)
            before = self.upto(-1 << 60, batch_id)  # the base, or what the job began with
            rows = rows if before is None else rows.unionByName(before)
            self.base.append(latest_per_key(rows, self.KEY).withColumn("upto", F.lit(old[-1])), batch_id - 1)


def _fill_images(ch: DataFrame, versions: RowVersions, batch_id: int, skip: str) -> DataFrame:
    """A6 for a micro-batch after ``shard_by_image``; versions are read only if a delete needs one."""
    last = ch.where((F.col("mod_type") == "DELETE") & F.col("shard_error").eqNullSafe(S.NO_SHARD_COLUMN)).agg(F.max("commit_seconds").alias("s")).first()["s"]
    return ch if last is None else S.fill_delete_shards(ch, stored=versions.upto(last - 1, batch_id), skip=skip)


def _fill_columns(ch: DataFrame, table_map: DataFrame, versions: RowVersions, batch_id: int) -> DataFrame:
    """A2 and A6 for a micro-batch."""
    plain = S.shard_by_column(ch, table_map, lookup_deletes=False)
    last = plain.where(F.col("drop_reason").eqNullSafe(S.NO_VERSION)).agg(F.max("commit_seconds").alias("s")).first()["s"]
    return plain if last is None else S.shard_by_column(ch, table_map, stored=versions.upto(last - 1, batch_id))


_ROW_IDS = ["table_name", "keys_json", *model.ORDER_COLUMNS, model.MOD_POSITION]


def _write(rendered: DataFrame, connect, dead: DeadLetters, mark: tuple[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Write statements; what has none (P9) and what failed goes to the dead letters. Returns (failed
    shards with their error, failed statements)."""
    dead.put(rendered.where(F.col("drop_reason").isNotNull()).withColumn("error", F.col("drop_reason")).drop("drop_reason", "dml", "pk_text", "src_table"), "render")
    report = write_and_report(rendered, connect, mark=mark)
    status, unwritten = report.where("kind = 'status'"), report.where("kind = 'unwritten'")
    dead.put(unwritten.drop("kind", "statements", "retries", "ok"), "write")
    return status.where("NOT ok").groupBy("shard").agg(F.max("error").alias("error")), unwritten


class ShardWriter:
    """Statements of a batch to their shards; a shard whose write has failed is stopped, and its statements go to the
    dead letters instead of being written out of order.

    ``resume`` names stopped shards that have been repaired: with the first batch after the start, the statements that they missed
    are read back from the dead letters and written in order before their new ones. If that fails they stay stopped."""

    STOPPED = "shard stopped after a failed write"

    def __init__(self, spark: SparkSession, folder: str, name: str, connect, dead: DeadLetters, resume=()):
        self.failed = FailedShards(spark, folder + "-failed-shards")
        self.spark, self.name, self.connect, self.dead, self.resume = spark, name, connect, dead, list(resume)

    def _replay(self, batch_id: int) -> tuple[list[str], DataFrame | None]:
        """(shards that are up again, those that failed anew)."""
        wanted, self.resume = self.resume, []
        since = {r["shard"]: r["batch_id"] for r in self.failed.before(batch_id).where(F.col("shard").isin(wanted)).collect()} if wanted else {}
        if not since:
            return [], None
        if self.dead.path is None:
            raise RuntimeError("a stopped shard can be resumed only with its dead letters")
        letters = read_dead_letters(self.spark, self.dead.path, "write", range(min(since.values()), batch_id))
        if letters is None:
            return list(since), None
        fields = "shard string, table_name string, keys_json string, commit_seconds bigint, commit_nanos int, server_txn_id string, record_sequence string, mod_position int, dml string"
        missed = letters.select("batch", F.from_json("record", fields).alias("r")).select("batch", "r.*")
        mine = F.lit(False)
        for shard, first in since.items():
            mine = mine | ((F.col("shard") == shard) & (F.col("batch") >= first))
        # a batch of its own for the marks: it runs before the batch that it comes with
        report = write_and_report(missed.where(mine), self.connect, mark=(self.name + "/resume", batch_id))
        down = report.where("kind = 'status' AND NOT ok").groupBy("shard").agg(F.max("error").alias("error"))
        broken = {r["shard"] for r in down.collect()}
        return [x for x in since if x not in broken], down

    def write(self, rendered: DataFrame, batch_id: int) -> None:
        up, down = self._replay(batch_id)
        stopped = self.failed.before(batch_id).where(~F.col("shard").isin(up)).select("shard").distinct()
        missed = rendered.join(stopped, "shard", "left_semi").withColumn("error", F.coalesce("drop_reason", F.lit(self.STOPPED)))
        self.dead.put(missed.where("drop_reason IS NULL").drop("drop_reason"), "write")
        self.dead.put(missed.where("drop_reason IS NOT NULL").drop("drop_reason"), "render")
        now, _ = _write(rendered.join(stopped, "shard", "left_anti"), self.connect, self.dead, (self.name, batch_id))
        self.failed.record(now if down is None else now.unionByName(down), batch_id, up)


def direct_replication_stream(spark: SparkSession, source: DataFrame | ChangeSource, table_map: DataFrame, column_map: DataFrame,
                              connect, interval: str = "1 second", watermark_delay: str = "0 seconds",
                              shard_count: int = S.DEFAULT_SHARD_COUNT, dialect: str = "mysql",
                              tz_offset: str = "+00:00", dead_letter_path: str | None = None,
                              name: str = "direct-replication", available_now: bool = False,
                              checkpoint: str | None = None, filtration: str = "forward_migration",
                              idle: str | None = None, resume=(), meter: Meter | None = None):
    """Q1: filter -> explode -> modulo shard -> ordered release (latest per key) -> DML ->
    per-shard writes, with fail-stop per shard (``ShardWriter``). ``meter`` gets the lags of the changes of a batch that
    have a statement, also of those that a stopped shard didn't take."""
    specs = table_specs(table_map, column_map).cache()   # read once, not by every batch
    folder = stream_checkpoint(spark, name, checkpoint)
    buffer = ReleaseBuffer(spark, folder + "-buffer", interval, "latest", watermark_delay, _idle(idle, available_now))
    dead = DeadLetters(dead_letter_path)
    writer = ShardWriter(spark, folder, name, connect, dead, resume)

    def handle(records: DataFrame, batch_id: int) -> None:
        ch = S.shard_by_mod(T.explode_mods(T.filter_changes(records, filtration)), "UserId", shard_count)
        released = buffer.step(ch, batch_id, records)
        r = D.render_dml(released.drop("released_at_ms"), table_map, column_map, dialect, tz_offset, specs=specs, insert_if_absent=True).persist()
        try:
            writer.write(r, batch_id)
            if meter is not None:
                meter.put_lag(r.where(F.col("drop_reason").isNull()), batch_id)
            dead.flush(batch_id)
        finally:
            r.unpersist()

    return start(_opened(source, spark, name, folder), handle, name, interval, available_now, folder)


def shadow_replication_stream(spark: SparkSession, source: DataFrame | ChangeSource, table_map: DataFrame, column_map: DataFrame,
                              connect, dialect: str = "mysql", tz_offset: str = "+00:00",
                              skip: str = S.DEFAULT_SKIP_SHARD, dead_letter_path: str | None = None,
                              interval: str = "1 second", name: str = "shadow-replication",
                              available_now: bool = False, checkpoint: str | None = None,
                              shadow: DataFrame | None = None, stored: DataFrame | None = None,
                              filtration: str = "forward_migration", retain: str | None = None, meter: Meter | None = None):
    """Q2: filter -> explode -> image shard (skip shard for unknown tables; deletes from row versions; dead
    letters for records without a shard) -> shadow test -> DML -> per-shard writes -> the written keys' shadow rows.

    Changes of a micro-batch are written in commit order per key; across batches, what is older than the
    last applied commit of its key goes to the dead letters. Only what was written advances the shadow, which is a
    ``KeyedLog``: a batch reads the buckets of its own keys and writes a row for each of them. ``meter`` gets the lags of what
    was written."""
    specs = table_specs(table_map, column_map).cache()   # read once, not by every batch
    folder = stream_checkpoint(spark, name, checkpoint)
    last = KeyedLog(spark, folder + "-shadow", "table_name string, pk_value string", "processed_commit_ts timestamp")
    versions = RowVersions(spark, folder + "-versions", stored, retain=retain)
    dead = DeadLetters(dead_letter_path)
    key = ["table_name", "pk_value"]

    def handle(records: DataFrame, batch_id: int) -> None:
        ch = S.shard_by_image(T.explode_mods(T.filter_changes(records, filtration)), table_map, skip, lookup_deletes=False).persist()
        batch = _fill_images(ch, versions, batch_id, skip).persist()
        held = [ch, batch]
        try:
            versions.add(batch.where(F.col("shard_error").isNull() & (F.col("shard") != skip)), batch_id)
            if shadow is not None:
                last.start(shadow, batch_id)
            dead.put(batch.where(F.col("shard_error").isNotNull()), "assign_shard", "shard_error")
            good = batch.where(F.col("shard_error").isNull() & (F.col("shard") != skip)).drop("shard_error")
            r = D.render_dml(good, table_map, column_map, dialect, tz_offset, specs=specs, insert_if_absent=True).withColumn("pk_value", F.col("pk_text")).persist()
            held.append(r)
            to_apply, older = L.shadow_filter(r, last.lookup(r.where("pk_value IS NOT NULL"), batch_id), key)
            dead.put(older.withColumn("error", F.lit("older than the last applied commit of its key")), "shadow_check")
            to_apply = to_apply.drop("_shadow_ts").persist()
            held.append(to_apply)
            _, unwritten = _write(to_apply, connect, dead, (name, batch_id))
            same = [F.col(f"w.{c}").eqNullSafe(F.col(f"u.{c}")) for c in _ROW_IDS]
            written = to_apply.where(F.col("drop_reason").isNull()).alias("w").join(unwritten.select(*_ROW_IDS).distinct().alias("u"), same, "left_anti")
            last.append(written.select(*key, F.col("commit_ts").alias("processed_commit_ts")), batch_id)
            if meter is not None:
                meter.put_lag(written, batch_id)
            dead.flush(batch_id)
        finally:
            for frame in held:
                frame.unpersist()

    return start(_opened(source, spark, name, folder), handle, name, interval, available_now, folder)


def with_progress_metrics(df: DataFrame, name: str = "changes", shard_col: str | None = None) -> DataFrame:
    """G4/G5 live: counts and commit-time range observed per micro-batch; they appear in
    ``query.lastProgress["observedMetrics"][name]`` and in ``StreamingQueryListener``
    events. With ``shard_col`` also the shards, approximately: an observation can't count distinct values
    exactly. (Per-shard totals come from ``metrics.record_counts`` on the written data.)"""
    aggs = [F.count(F.lit(1)).alias("records"), F.min("commit_ts").alias("earliest_commit_ts"),
            F.max("commit_ts").alias("latest_commit_ts")]
    if shard_col:
        aggs.append(F.approx_count_distinct(F.col(shard_col)).alias("shards"))
    return df.observe(name, *aggs)


def buffer_to_database_stream(spark: SparkSession, buffer: DataFrame, table_map: DataFrame, column_map: DataFrame,
                              connect, dialect: str = "mysql", tz_offset: str = "+00:00",
                              dead_letter_path: str | None = None, interval: str = "1 second",
                              name: str = "buffer-to-database", available_now: bool = False,
                              checkpoint: str | None = None, resume=(), meter: Meter | None = None):
    """Q4: ordered buffer (S2/S3 rows with ``shard`` + ``value``) -> parse (dead letters for
    malformed messages) -> DML -> per-shard ordered writes, with fail-stop per shard and ``meter`` as in Q1."""
    specs = table_specs(table_map, column_map).cache()   # read once, not by every batch
    folder = stream_checkpoint(spark, name, checkpoint)
    dead = DeadLetters(dead_letter_path)
    writer = ShardWriter(spark, folder, name, connect, dead, resume)

    def handle(batch: DataFrame, batch_id: int) -> None:
        good, bad = T.parse_buffer(batch, on_error="dlq")
        dead.put(bad.drop("stage", "failed_at"), "parse_buffer")
        r = D.render_dml(good, table_map, column_map, dialect, tz_offset, specs=specs, insert_if_absent=True).persist()
        try:
            writer.write(r, batch_id)
            if meter is not None:
                meter.put_lag(r.where(F.col("drop_reason").isNull()), batch_id)
            dead.flush(batch_id)
        finally:
            r.unpersist()

    return start(buffer, handle, name, interval, available_now, folder)


def stream_to_buffer_stream(spark: SparkSession, source: DataFrame | ChangeSource, table_map: DataFrame, out_path: str,
                            interval: str = "1 second", watermark_delay: str = "0 seconds",
                            name: str = "stream-to-buffer", available_now: bool = False,
                            dead_letter_path: str | None = None, checkpoint: str | None = None,
                            stored: DataFrame | None = None, filtration: str = "forward_migration", write=None,
                            idle: str | None = None, retain: str | None = None, topic: bool = False):
    """Q3: filter -> explode -> column shard -> ordered release (all) -> buffer messages. ``write(frame,
    batch_id)`` gets the ordered messages (e.g. ``messages.kafka_frame`` or ``publish_batches``); with ``topic`` they go
    to the ordered topic at ``out_path`` (K2), a batch once; by default they
    are written as JSON lines, a folder per shard and batch, in change order."""
    from riverbed.sinks.messages import buffer_messages
    from riverbed.sinks.topic import topic_rows, write_topic
    folder = stream_checkpoint(spark, name, checkpoint)
    buffer = ReleaseBuffer(spark, folder + "-buffer", interval, "all", watermark_delay, _idle(idle, available_now))
    dead = DeadLetters(dead_letter_path)
    versions = RowVersions(spark, folder + "-versions", stored, retain=retain)

    def handle(records: DataFrame, batch_id: int) -> None:
        ch = T.explode_mods(T.filter_changes(records, filtration))
        filled = _fill_columns(ch, table_map, versions, batch_id).persist()
        try:
            good, lost = S.split_dropped(filled)
            versions.add(good, batch_id)
            dead.put(lost, "assign_shard", "drop_reason")
            bad_id = T.shard_error(F.col("shard"))
            dead.put(good.where(bad_id.isNotNull()).withColumn("error", bad_id), "assign_shard")
            msgs = in_order(buffer_messages(buffer.step(good.where(bad_id.isNull()), batch_id, records), pretty=False))
            if write is not None:
                write(msgs, batch_id)
            elif topic:
                write_topic(topic_rows(msgs), out_path, batch_id)
            else:  # a folder per batch: a batch that runs again overwrites what it wrote
                (msgs.select("shard", "value").write.mode("overwrite").partitionBy("shard").json(f"{out_path}/batch={batch_id:012d}"))
            dead.flush(batch_id)
        finally:
            filled.unpersist()

    return start(_opened(source, spark, name, folder), handle, name, interval, available_now, folder)


def windowed_export_stream(spark: SparkSession, source: DataFrame | ChangeSource, table_map: DataFrame, out_path: str,
                           size: str = "10s", interval: str = "1 second", name: str = "windowed-export",
                           available_now: bool = False, dead_letter_path: str | None = None,
                           checkpoint: str | None = None, stored: DataFrame | None = None,
                           filtration: str = "forward_migration", retain: str | None = None):
    """Q5: filter -> explode -> image shard -> files per shard and window."""
    from riverbed.sinks.files import write_windowed
    folder = stream_checkpoint(spark, name, checkpoint)
    versions = RowVersions(spark, folder + "-versions", stored, retain=retain)
    dead = DeadLetters(dead_letter_path)

    def handle(records: DataFrame, batch_id: int) -> None:
        ch = S.shard_by_image(T.explode_mods(T.filter_changes(records, filtration)), table_map, lookup_deletes=False).persist()
        filled = _fill_images(ch, versions, batch_id, S.DEFAULT_SKIP_SHARD).persist()
        try:
            versions.add(filled.where(F.col("shard_error").isNull() & (F.col("shard") != S.DEFAULT_SKIP_SHARD)), batch_id)
            dead.put(filled.where(F.col("shard_error").isNotNull()), "assign_shard", "shard_error")
            write_windowed(filled.where(F.col("shard_error").isNull()).drop("shard_error"), f"{out_path}/batch={batch_id:012d}", size, mode="overwrite")
            dead.flush(batch_id)
        finally:
            filled.unpersist()
            ch.unpersist()

    return start(_opened(source, spark, name, folder), handle, name, interval, available_now, folder)


def table_apply_stream(spark: SparkSession, source: DataFrame | ChangeSource, table_map: DataFrame, column_map: DataFrame,
                       targets: dict[str, DataFrame], path: str, buckets: int = 64, fold: str = "column", interval: str = "1 second",
                       name: str = "table-apply", available_now: bool = False, dead_letter_path: str | None = None,
                       checkpoint: str | None = None, filtration: str = "forward_migration"):
    """Q6: filter -> explode -> apply to stored tables (F18), one below ``path`` per source table; ``targets`` are their rows before
    the job's first batch. A batch rewrites the buckets that its keys fall into. Changes of other tables, without a key or of an
    unknown kind are dead letters. ``stored_targets`` reads the tables."""
    from riverbed.plans.jobs import mapped_tables, typed_changes
    folder = stream_checkpoint(spark, name, checkpoint)
    tables = {t: mapped_tables(table_map, column_map)[t] for t in targets}
    stored = stored_targets(spark, targets, table_map, column_map, path, buckets, fold)
    for t, rows in targets.items():
        stored[t].start(rows)
    dead = DeadLetters(dead_letter_path)

    def handle(records: DataFrame, batch_id: int) -> None:
        ch = T.with_payloads(T.explode_mods(T.filter_changes(records, filtration))).persist()
        try:
            known = F.coalesce(F.col("table_name").isin([sp for sp, _, _ in tables.values()]), F.lit(False))
            dead.put(ch.where(~known).drop("_k", "_n").withColumn("error", F.lit(D.DROP_TABLE_NOT_MAPPED)), "table_apply")
            for t, (sp, keys, rest) in tables.items():
                mine = ch.where(F.col("table_name") == sp)
                typed = typed_changes(mine, keys, rest, dict(targets[t].dtypes))
                bad = (F.when(~F.coalesce(F.col("mod_type").isin("INSERT", "UPDATE", "DELETE"), F.lit(False)), F.lit(D.DROP_UNSUPPORTED_MOD))
                       .when(F.coalesce(*[F.when(F.col(c["src_col"]).isNull(), F.lit(1)) for c in keys]).isNotNull(), F.lit(D.DROP_PK_ABSENT)))
                lost = typed.withColumn("error", bad).where(F.col("error").isNotNull())
                dead.put(lost.withColumn("table_name", F.lit(sp)), f"table_apply_{t}")
                stored[t].apply(typed.where(bad.isNull()), batch_id)
            dead.flush(batch_id)
        finally:
            ch.unpersist()

    return start(_opened(source, spark, name, folder), handle, name, interval, available_now, folder)


def stored_targets(spark: SparkSession, targets: dict[str, DataFrame], table_map: DataFrame, column_map: DataFrame, path: str,
                   buckets: int = 64, fold: str = "column") -> dict:
    """The stored tables of ``table_apply_stream``, by source table."""
    from riverbed.plans.jobs import mapped_tables
    from riverbed.streaming.target import StoredTarget
    tables = mapped_tables(table_map, column_map)
    schema = lambda rows: ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes)
    return {t: StoredTarget(spark, f"{path.rstrip('/')}/{t}", schema(rows), [c["src_col"] for c in tables[t][1]], buckets, fold) for t, rows in targets.items()}
