"""Message framing for the stream-to-buffer job (K1 Kafka, K2 ordered topics, K13 checks)."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbed import model
from riverbed.session import broadcast_checked

PUBLISH_MAX_MESSAGES = 100          # fixed values: flush thresholds of the ordered publisher
PUBLISH_MAX_BYTES = 100_000
PUBLISH_MAX_DELAY_MS = 100


def buffer_record(df: DataFrame) -> Column:
    """The buffer message struct (camelCase, as the buffer-to-database job reads it)."""
    return F.struct(
        F.struct(F.col("commit_seconds").alias("seconds"), F.col("commit_nanos").alias("nanos")).alias("commitTimestamp"),
        F.col("server_txn_id").alias("serverTransactionId"),
        F.col("record_sequence").alias("recordSequence"),
        F.col("table_name").alias("tableName"),
        F.array(F.struct(F.col("keys_json").alias("keysJson"),
                         F.col("old_values_json").alias("oldValuesJson"),
                         F.col("new_values_json").alias("newValuesJson"))).alias("mods"),
        F.col("mod_type").alias("modType"),
        F.col("num_records_in_txn").alias("numberOfRecordsInTransaction"),
        F.col("txn_tag").alias("transactionTag"))


def buffer_messages(df: DataFrame, pretty: bool = True) -> DataFrame:
    """Message text per change (null fields kept)."""
    opts = {"ignoreNullFields": "false"}
    if pretty:
        opts["pretty"] = "true"
    return df.select("*", F.to_json(buffer_record(df), opts).alias("value"))


def kafka_frame(df: DataFrame, shards: DataFrame, topic: str, pretty: bool = True, extra_cols=()) -> DataFrame:
    """K1: ``(topic, partition, key, value)`` rows for ``write.format("kafka")``: partition is
    the shard's position in shard-id order, key the shard id, value the message JSON."""
    from riverbed.operators.sharding import partition_numbers
    parts = broadcast_checked(partition_numbers(shards).withColumnRenamed("logicalShardId", "_sid"))
    m = buffer_messages(df, pretty)
    return (m.join(parts, m["shard"] == parts["_sid"], "left")
            .select(F.lit(topic).alias("topic"), F.col("partition").cast("int").alias("partition"),
                    F.col("shard").alias("key"), F.col("value"), *model.order_columns(df), *extra_cols))


def ordered_topic_frame(df: DataFrame, pretty: bool = False) -> DataFrame:
    """K2: ``(ordering_key, attributes, data)``: ordering key and ``shardId`` attribute are
    the shard, data is the message JSON."""
    m = buffer_messages(df, pretty)
    return m.select(F.col("shard").alias("ordering_key"),
                    F.create_map(F.lit("shardId"), F.col("shard")).alias("attributes"),
                    F.col("value").alias("data"), *model.order_columns(df))


def check_sink_options(sink_type: str, options: dict) -> None:
    """Pubsub needs data topic, error topic and endpoint; kafka needs the cluster
    profile file and the shard file."""
    need = {"pubsub": ("data_topic", "error_topic", "endpoint"),
            "kafka": ("cluster_profile_path", "shard_file_path")}.get(sink_type)
    if need is None:
        raise ValueError(f"unsupported sink type: {sink_type}")
    missing = [k for k in need if not options.get(k)]
    if missing:
        raise ValueError(f"{sink_type} sink needs: {', '.join(missing)}")


def flushes(messages: Iterable, size: Callable, max_messages: int = PUBLISH_MAX_MESSAGES, max_bytes: int = PUBLISH_MAX_BYTES,
            max_delay_ms: float = PUBLISH_MAX_DELAY_MS, clock: Callable = time.monotonic) -> Iterator[list]:
    """Runs of messages as the publisher flushes them: full by number or by size (with the message that fills it), or when the
    first one has waited ``max_delay_ms`` as the next one comes."""
    buf, held, since = [], 0, 0.0
    for m in messages:
        now = clock()
        if buf and (now - since) * 1000 >= max_delay_ms:
            yield buf
            buf, held = [], 0
        if not buf:
            since = now
        buf.append(m)
        held += size(m)
        if len(buf) >= max_messages or held >= max_bytes:
            yield buf
            buf, held = [], 0
    if buf:
        yield buf


def publish_batches(frame: DataFrame, publish, max_messages: int = PUBLISH_MAX_MESSAGES,
                    max_bytes: int = PUBLISH_MAX_BYTES) -> None:
    """K2 writer: per partition (ordered by shard, then change order), hand messages to the
    caller's ``publish(list_of_(ordering_key, attributes, data))`` in flushes of at most
    ``max_messages`` / ``max_bytes``. Any error fails the task (Spark retries it; publishes
    must be idempotent by message id on the receiving side)."""
    def part(rows):
        messages = ((r["ordering_key"], dict(r["attributes"]), r["data"]) for r in rows)
        for flush in flushes(messages, lambda m: len(m[2] or ""), max_messages, max_bytes):
            publish(flush)

    (frame.repartition("ordering_key")
     .sortWithinPartitions("ordering_key", *model.order_columns(frame))
     .foreachPartition(part))
