"""State tables as keyed DataFrame folds: shadow (K5, K6), run metadata (K7), progress
(K8, G7/G8 in operators.metrics), seen ids (K9).

Each fold returns the table's next version; the caller writes it (overwrite of a new
version directory or a table) after the data write, so replays are idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from riverbed.functions.values import SPARK_TYPE
from riverbed.streaming.windows import duration

PROGRESS_START = "1970-01-01 12:00:00"   # fixed value: initial created_upto of every shard


def shadow_upsert(shadow: DataFrame, applied: DataFrame, key_cols, commit_col: str = "commit_ts",
                  ts_col: str = "processed_commit_ts") -> DataFrame:
    """K5: next shadow version — per key the latest of stored and newly applied commits
    (a partial aggregation: one row per key per task before the shuffle)."""
    key_cols = list(key_cols)
    new = applied.select(*key_cols, F.col(commit_col).alias(ts_col))
    return shadow.select(*key_cols, ts_col).unionByName(new).groupBy(*key_cols).agg(F.max(ts_col).alias(ts_col))


def spark_type(name: str) -> str:
    """The Spark type of a catalog's type name: a stream type, or a Spark type as
    ``catalog_from_frames`` writes it."""
    if name in SPARK_TYPE:
        return SPARK_TYPE[name]
    try:
        return Ty._parse_datatype_string(name).simpleString()
    except Exception:  # noqa: BLE001  (a source database's own type name)
        return "string"


def shadow_schema(catalog_rows, table: str) -> Ty.StructType:
    """K6: shadow table schema: the table's PK columns in PK order + nullable
    ``processed_commit_ts``. ``catalog_rows`` are rows of the (small) catalog frame."""
    pks = sorted((r for r in catalog_rows if r["table_name"] == table and r["pk_ordinal"] is not None),
                 key=lambda r: r["pk_ordinal"])
    fields = [Ty.StructField(r["column_name"], Ty._parse_datatype_string(spark_type(r["stream_type"])),
                             False) for r in pks]
    fields.append(Ty.StructField("processed_commit_ts", Ty.TimestampType(), True))
    return Ty.StructType(fields)


def shadow_table_name(table: str, prefix: str = "shadow_") -> str:
    return f"{prefix}{table}"


def aligned_start(start_ts: str, size: str):
    """Start of the epoch-aligned window of ``size`` holding ``start_ts``."""
    return F.window(F.lit(start_ts).cast("timestamp"), duration(size)).start


def upsert_metadata(spark: SparkSession, existing: DataFrame | None, run_id: str, start_ts: str,
                    window_size: str) -> DataFrame:
    """K7: (run_id, aligned start, window duration) keyed by run id; the new row replaces
    the old one for the same run."""
    new = spark.range(1).select(F.lit(run_id).alias("run_id"),
                                aligned_start(start_ts, window_size).alias("start_ts"),
                                F.lit(window_size).alias("window_duration"))
    if existing is None:
        return new
    return existing.join(new.select("run_id"), "run_id", "left_anti").unionByName(new)


def read_metadata(meta: DataFrame, run_id: str) -> DataFrame:
    """K7 read: the run's row (empty when the run is unknown)."""
    return meta.where(F.col("run_id") == run_id)


def init_progress(shards: DataFrame, run_id: str, shard_col: str = "logicalShardId") -> DataFrame:
    """K8: every shard's progress set to the initial instant (insert-or-update resets it)."""
    return shards.select(F.lit(run_id).alias("run_id"), F.col(shard_col).alias("shard"),
                         F.lit(PROGRESS_START).cast("timestamp").alias("created_upto"))


def record_seen(seen: DataFrame, new_ids: DataFrame, id_col: str = "id", ts_col: str = "created_at") -> DataFrame:
    """K9: the table after recording ids; an id recorded twice keeps its first time."""
    return (seen.select(id_col, ts_col).unionByName(new_ids.select(id_col, ts_col))
            .groupBy(id_col).agg(F.min(ts_col).alias(ts_col)))


def append_seen(path: str, new_ids: DataFrame, id_col: str = "id", ts_col: str = "created_at") -> None:
    """K9 writer: append only. The stored ids are read for the anti join, never regrouped or written again."""
    from riverbed.operators.lookup import unseen
    new = new_ids.groupBy(id_col).agg(F.min(ts_col).alias(ts_col))
    spark = new_ids.sparkSession
    if spark.catalog.tableExists(path):
        new = unseen(new, spark.table(path), id_col)
    new.write.mode("append").saveAsTable(path)


def save_version(df: DataFrame, table: str) -> None:
    """Writer of a state table's next version (K5, K7, K8, G8): written under a new name first, so that the
    version it was made from can still be read, then put in place of the old one."""
    spark = df.sparkSession
    df.write.mode("overwrite").saveAsTable(f"{table}__next")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {table}__next RENAME TO {table}")
