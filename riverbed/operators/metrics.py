"""Replication metrics as aggregations (G2-G5) and progress/metadata folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbed import model
from riverbed.operators.latest import order_struct


def _ts(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x).cast("timestamp")


def release_lag_ms(df: DataFrame, processing_ts, group_cols=("shard",)) -> DataFrame:
    """Earliest commit of a released batch and the replication lag in milliseconds."""
    p = _ts(processing_ts)
    return (df.groupBy(*group_cols)
            .agg(F.min("commit_ts").alias("earliest_commit_ts"))
            .withColumn("lag_ms", (F.unix_micros(p) - F.unix_micros(F.col("earliest_commit_ts"))) / 1000))


def batch_lag_seconds(df: DataFrame, processing_ts, group_cols=("shard",), order_cols=model.ORDER_COLUMNS) -> DataFrame:
    """Lag in whole seconds from the first record of the batch (by change order)."""
    p = _ts(processing_ts)
    return (df.groupBy(*group_cols)
            .agg(F.min_by("commit_ts", order_struct(order_cols)).alias("first_commit_ts"))
            .withColumn("lag_seconds", F.timestamp_diff("SECOND", F.col("first_commit_ts"), p)))


def record_counts(df: DataFrame, shard_col: str = "shard") -> DataFrame:
    """Records per shard plus the global total (``shard`` NULL) in one pass."""
    return (df.rollup(shard_col)
            .agg(F.count(F.lit(1)).alias("records"), F.grouping_id().alias("_g"))
            .withColumn("scope", F.when(F.col("_g") == 1, F.lit("all")).otherwise(F.lit("shard")))
            .drop("_g"))


def lag_distribution(df: DataFrame, lag_col: str = "lag_ms", shard_col: str = "shard") -> DataFrame:
    """Count / sum / min / max of a lag, per shard and overall (rollup, one pass)."""
    return (df.rollup(shard_col)
            .agg(F.count(lag_col).alias("n"), F.sum(lag_col).alias("sum"),
                 F.min(lag_col).alias("min"), F.max(lag_col).alias("max"), F.grouping_id().alias("_g"))
            .withColumn("scope", F.when(F.col("_g") == 1, F.lit("all")).otherwise(F.lit("shard"))).drop("_g"))


def min_file_start(progress: DataFrame, run_id: str) -> DataFrame:
    """Earliest ``file_start_interval`` of a run (NULL when the run has no rows)."""
    return progress.where(F.col("run_id") == run_id).agg(F.min("file_start_interval").alias("min_start"))


def advance_progress(current: DataFrame, updates: DataFrame, ts_col: str = "created_upto") -> DataFrame:
    """Per (run_id, shard) keep the later of the stored and the new ``created_upto``;
    progress never moves backwards."""
    u = updates.groupBy("run_id", "shard").agg(F.max(ts_col).alias("_new"))
    c = current.select("run_id", "shard", F.col(ts_col).alias("_old"))
    return (c.join(u, ["run_id", "shard"], "full")
            .select("run_id", "shard",
                    F.greatest(F.col("_old"), F.col("_new")).alias(ts_col)))
