"""File sinks: skip location (K10), dead letters (K11), sharded windowed export."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed import model
from riverbed.sinks.messages import buffer_record
from riverbed.streaming.windows import duration


def write_skipped(df: DataFrame, path: str, skip: str = "skip", shard_col: str = "shard") -> None:
    """Changes routed to the skip shard, written under ``shard=skip``."""
    (df.where(F.col(shard_col) == skip).write.mode("append").partitionBy(shard_col).json(path))


def dead_letters(df: DataFrame, stage: str, error_col: str = "error") -> DataFrame:
    """Uniform dead-letter rows ``(stage, error, record json, failed_at)``."""
    rest = [c for c in df.columns if c != error_col and not c.startswith("_")]
    return df.select(F.lit(stage).alias("stage"), F.col(error_col).cast("string").alias("error"),
                     F.to_json(F.struct(*rest)).alias("record"), F.current_timestamp().alias("failed_at"))


def write_dead_letters(dlq: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Dead letters below ``stage=``. With a batch they have a folder of their own, which the batch replaces if it runs
    again; without one they are appended."""
    if batch_id is None:
        dlq.write.mode("append").partitionBy("stage").json(path)
    else:
        folder = f"{path.rstrip('/')}/batch={batch_id:012d}"
        dlq.write.mode("overwrite").partitionBy("stage").json(folder)
        sc = dlq.sparkSession.sparkContext
        at = sc._jvm.org.apache.hadoop.fs.Path(folder)
        fs = at.getFileSystem(sc._jsc.hadoopConfiguration())
        if not any(x.isDirectory() for x in fs.listStatus(at)):  # a batch without dead letters leaves no folder
            fs.delete(at, True)


def read_dead_letters(spark: SparkSession, path: str, stage: str, batches: range) -> DataFrame | None:
    """The letters of a stage that these batches wrote, with ``batch``; None if there are none."""
    sc = spark.sparkContext
    folders = []
    for b in batches:
        at = sc._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/batch={b:012d}/stage={stage}")
        if at.getFileSystem(sc._jsc.hadoopConfiguration()).exists(at):
            folders.append(at.toString())
    if not folders:
        return None
    rows = spark.read.schema("error string, record string, failed_at timestamp, batch bigint, stage string").option("basePath", path).json(folders)
    return rows


class DeadLetters:
    """What a streaming job can't write, collected over a batch and written at its end (``flush``). Without a path a row
    is an error of the batch."""

    def __init__(self, path: str | None):
        self.path = path
        self.rows: list[DataFrame] = []

    def put(self, rows: DataFrame, stage: str, error_col: str = "error") -> None:
        if self.path:
            self.rows.append(dead_letters(rows, stage, error_col))
        elif not rows.isEmpty():
            first = rows.select(error_col).first()[0]
            raise RuntimeError(f"{stage}: changes can't be written and there is no dead-letter path; first error: {first}")

    def flush(self, batch_id: int) -> None:
        rows, self.rows = self.rows, []
        if rows:
            write_dead_letters(reduce(DataFrame.unionByName, rows), self.path, batch_id)


def windowed_content(df: DataFrame, size: str, ts_col: str = "commit_ts") -> DataFrame:
    """K12 content: (shard, window_start, ids, record json) — one file set per shard and window."""
    return df.select("shard", F.window(F.col(ts_col), duration(size)).start.alias("window_start"),
                     *model.order_columns(df),
                     F.to_json(buffer_record(df), {"ignoreNullFields": "false"}).alias("record"))


def write_windowed(df: DataFrame, path: str, size: str, ts_col: str = "commit_ts", mode: str = "append") -> None:
    """JSON files partitioned by shard and window start, in change order. Rows are dealt out by
    ranges of (shard, window, change order): a hot shard or window gets several files, the
    names of which are in that order, and small ones share a task."""
    c = windowed_content(df, size, ts_col)
    order = ["shard", "window_start", *model.order_columns(c)]
    (c.repartitionByRange(*order)
     .sortWithinPartitions(*order)
     .write.mode(mode).partitionBy("shard", "window_start").json(path))
