"""Out-of-order guard (W9): apply a change only if no later commit of the same key was
applied before it. Streaming form keeps the last applied commit per key in state; the
batch twin uses the skew-safe prefix maximum over arrival order."""

from __future__ import annotations

from typing import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from riverbed.operators.ordering import prefix_max


def commit_key(df: DataFrame) -> DataFrame:
    """Commit instant as one comparable long: seconds * 1e9 + nanos."""
    return df.withColumn("_commit_ns", F.col("commit_seconds") * F.lit(1_000_000_000) + F.col("commit_nanos"))


def guard_batch(df: DataFrame, key_cols, arrival_col: str) -> tuple[DataFrame, DataFrame]:
    """W9 batch twin: keep a change iff its commit >= every earlier-arrived commit of its key
    (equal commits are re-applied). Returns (kept, skipped)."""
    d = prefix_max(commit_key(df), "_commit_ns", [arrival_col], list(key_cols), out_col="_prior")
    keep = F.col("_prior").isNull() | (F.col("_commit_ns") >= F.col("_prior"))
    return d.where(keep).drop("_commit_ns", "_prior"), d.where(~keep).drop("_commit_ns", "_prior")


class GuardProcessor(StatefulProcessor):
    """Per key: value state = last applied commit (ns). Rows of a micro-batch are checked in
    arrival order; rows behind the stored commit are emitted with ``applied = false`` so the
    sink can send them to the dead letters instead of losing them."""

    def __init__(self, arrival_col: str):
        self.arrival_col = arrival_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        from pyspark.sql.types import LongType, StructField, StructType
        self.last = handle.getValueState("last_commit_ns", StructType([StructField("v", LongType(), True)]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd
        batch = pd.concat(list(rows), ignore_index=True)
        batch = batch.sort_values(self.arrival_col, kind="stable")
        last = self.last.get()[0] if self.last.exists() else None
        applied = []
        for c in (batch["commit_seconds"] * 1_000_000_000 + batch["commit_nanos"]).tolist():
            ok = last is None or c >= last
            applied.append(ok)
            if ok:
                last = c
        if last is not None:
            self.last.update((int(last),))
        batch["applied"] = applied
        yield batch

    def close(self) -> None:
        pass


def guard_stream(df: DataFrame, key_cols, arrival_col: str, output_schema=None) -> DataFrame:
    """W9 streaming form (``transformWithStateInPandas`` keyed by table + primary key).
    Output: the input columns plus ``applied``. The per-key state is the shadow table of
    the stream: it is committed with the micro-batch, after the sink wrote it."""
    if output_schema is None:
        from pyspark.sql.types import BooleanType, StructField, StructType
        output_schema = StructType(list(df.schema.fields) + [StructField("applied", BooleanType(), True)])
    from riverbed.session import ensure_rocksdb_state, ship_package
    ship_package(df.sparkSession)
    ensure_rocksdb_state(df.sparkSession)
    return df.groupBy(*key_cols).transformWithStateInPandas(
        GuardProcessor(arrival_col), output_schema, "append", "None")
