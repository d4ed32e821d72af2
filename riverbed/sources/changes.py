"""Change scans (S1) and ordered-buffer reads (S2 Kafka, S3 files)."""

from __future__ import annotations

import json

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed import model
from riverbed.session import ensure_utc

MAX_PER_PULL = 2000        # fixed value: messages per pull of one shard's buffer reader


def bound_changes(df: DataFrame, start: str | None = None, end: str | None = None,
                  ts_col: str = "commit_ts") -> DataFrame:
    """S1 bounds: ``start <= commit_ts <= end``, both inclusive; no start means the instant of
    this call, no end means unbounded. The default start is fixed here, once: an expression for
    "now" would move on with every micro-batch and leave behind what was committed meanwhile.
    Plain comparisons, so that they push down to the parquet scan."""
    if not start:
        start = launch_instant()
    out = df.where(F.col(ts_col) >= F.lit(start).cast("timestamp"))
    if end:
        out = out.where(F.col(ts_col) <= F.lit(end).cast("timestamp"))
    return out


def launch_instant() -> str:
    """Now, as text with its zone. A job that is to go on after a restart stores it with its
    checkpoint (``jobs.start_instant``)."""
    return datetime.datetime.now(datetime.timezone.utc).isoformat(sep=" ")


def read_changes(spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
                 streaming: bool = False, fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Change records landed as files (parquet or JSON lines) in batch or as a stream."""
    ensure_utc(spark)
    if streaming:
        r = spark.readStream.format(fmt).schema(model.CHANGE_RECORD)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        df = r.load(path)
    else:
        df = spark.read.format(fmt).schema(model.CHANGE_RECORD).load(path)
    return bound_changes(df, start, end)


def kafka_options(profile: dict, shard_partitions: dict[str, int], topic: str | None = None,
                  max_per_shard: int | None = None) -> dict:
    """Options for ``readStream.format("kafka")``: one fixed partition per shard,
    earliest offsets, no consumer-group commits (the checkpoint tracks offsets and is
    committed only after the sink wrote the batch). ``max_per_shard`` (e.g. MAX_PER_PULL) bounds
    a micro-batch to so many messages times the shards; without it a batch takes what is there."""
    t = topic or profile["dataTopic"]
    cap = {} if max_per_shard is None else {"maxOffsetsPerTrigger": str(max_per_shard * max(1, len(shard_partitions)))}
    return {
        "kafka.bootstrap.servers": profile["bootstrapServer"],
        "assign": json.dumps({t: sorted(shard_partitions.values())}),
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        **cap,
    }


def kafka_rows_to_buffer(df: DataFrame) -> DataFrame:
    """S2 framing: Kafka source rows (key, value binary, partition, offset, ...) -> buffer
    message text plus the shard (message key) and position, ready for ``parse_buffer``."""
    return df.select(F.col("key").cast("string").alias("shard"), F.col("value").cast("string").alias("value"),
                     F.col("partition"), F.col("offset"))


def read_buffer_kafka(spark: SparkSession, profile: dict, shard_partitions: dict[str, int],
                      max_per_shard: int | None = None) -> DataFrame:
    """Streaming read of the ordered buffer from Kafka (needs the Kafka connector jar)."""
    r = spark.readStream.format("kafka")
    for k, v in kafka_options(profile, shard_partitions, max_per_shard=max_per_shard).items():
        r = r.option(k, v)
    return kafka_rows_to_buffer(r.load())


def read_buffer_files(spark: SparkSession, path: str, max_files_per_batch: int | None = None,
                      shard: str | None = None, streaming: bool = True) -> DataFrame:
    """S3: ordered-buffer messages landed as JSON-lines files with a ``shard`` attribute
    (``{"shard": ..., "value": "<message json>"}``); a micro-batch takes at most
    ``max_files_per_batch`` files (all there are, without it) and a shard filter plays the role of
    the per-shard subscription."""
    schema = "shard string, value string"
    if streaming:
        r = spark.readStream.schema(schema)
        df = (r.option("maxFilesPerTrigger", max_files_per_batch) if max_files_per_batch else r).json(path)
    else:
        df = spark.read.schema(schema).json(path)
    if shard is not None:
        df = df.where(F.col("shard") == shard)
    return df
