"""Shard assignment (A1-A7) and shard -> message partition numbering."""

from __future__ import annotations

import time
from typing import Iterator, Tuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed import model
from riverbed.functions import values as V
from riverbed.operators.lookup import asof_probes
from riverbed.operators.ordering import positions
from riverbed.operators.transforms import shard_error, with_payloads
from riverbed.session import broadcast_checked

DEFAULT_SHARD_COUNT = 500          # fixed value: default number of key groups
DEFAULT_SKIP_SHARD = "skip"        # fixed value: shard name of changes to skip


def shard_by_mod(df: DataFrame, key: str = "UserId", n: int = DEFAULT_SHARD_COUNT) -> DataFrame:
    """A1: ``shard = key % n`` (sign kept, as in Java) with the key read from the keys JSON
    as a long; a missing key is an error. Adds ``user_id`` (the key) and ``shard``."""
    d = with_payloads(df)
    uid = V.to_long(F.col("_k"), key, required=True)
    return (d.withColumn("user_id", uid)
            .withColumn("shard", (F.col("user_id") % F.lit(n)).cast("string"))
            .drop("_k", "_n"))


def _shard_table_map(table_map: DataFrame) -> DataFrame:
    return broadcast_checked(table_map.select(F.col("sp_table").alias("_t"), F.col("table_id").alias("_tid"),
                                              F.col("shard_col_id").alias("_scid"),
                                              F.col("shard_col").alias("_scol")))


NO_SHARD_COLUMN = "shard column not in record"
NO_VERSION = "no row version before delete"


def shard_by_column(df: DataFrame, table_map: DataFrame, lookup_deletes: bool = True,
                    lag_seconds: int = 1, stored: DataFrame | None = None) -> DataFrame:
    """A2 (+A6): shard = value of the table's shard column, looked up in the keys JSON, then
    in the new values. A DELETE without the column takes it from the row version in force
    ``lag_seconds`` before its commit: the latest earlier change of the same table and key
    that carried the column, in the frame or in ``stored`` (see ``stored_versions``).
    Non-DELETE changes without it are dropped.

    Returns the changes with ``shard`` and ``drop_reason`` (NULL when sharded); use
    ``split_dropped`` for two frames."""
    d = with_payloads(df).join(_shard_table_map(table_map), F.col("table_name") == F.col("_t"), "left")
    col = F.col("_scol")
    found = F.coalesce(V.has(F.col("_k"), col) | V.has(F.col("_n"), col), F.lit(False))
    d = d.select(*df.columns, found.alias("_found"),
                 F.when(found, V.keys_first_text(F.col("_k"), F.col("_n"), col)).alias("_direct"),
                 V.row_image_text(F.col("_k"), F.col("_n"), col).alias("_version"),
                 F.col("_tid"))
    is_del = F.col("mod_type") == "DELETE"
    if lookup_deletes:
        d = asof_probes(d, ["table_name", "keys_json"], "_version", F.col("_tid").isNotNull() & F.col("_version").isNotNull(),
                        ~F.col("_found") & is_del, "_prior", lag_seconds, _renamed_versions(stored))
    else:
        d = d.withColumn("_prior", F.lit(None).cast("string"))
    shard = F.when(F.col("_found"), F.col("_direct")).otherwise(F.col("_prior"))
    reason = (F.when(F.col("_found"), F.lit(None).cast("string"))
              .when(~is_del, F.lit(NO_SHARD_COLUMN))
              .when(F.col("_prior").isNull(), F.lit(NO_VERSION)))
    return d.select(*df.columns, shard.alias("shard"), reason.alias("drop_reason"))


def stored_versions(changes: DataFrame, table_map: DataFrame) -> DataFrame:
    """Row versions for delete lookups: table, key, change order and the shard that the row had. Keep
    it as a table beside the job (one row per change, or ``latest_per_key`` of it) and pass it as ``stored``."""
    d = shard_by_image(changes, table_map, lookup_deletes=False)
    d = d.where((F.col("mod_type") != "DELETE") & F.col("shard").isNotNull() & F.col("shard_error").isNull())
    return d.select("table_name", "keys_json", *model.order_columns(d), F.col("shard").alias("shard_version"))


def _renamed_versions(stored: DataFrame | None) -> DataFrame | None:
    return None if stored is None else stored.withColumnRenamed("shard_version", "_version")


def split_dropped(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a shard, dropped rows with their reason)."""
    return (df.where(F.col("drop_reason").isNull()).drop("drop_reason"),
            df.where(F.col("drop_reason").isNotNull()).drop("shard"))


def shard_by_image(df: DataFrame, table_map: DataFrame, skip: str = DEFAULT_SKIP_SHARD, lookup_deletes: bool = True,
                   lag_seconds: int = 1, stored: DataFrame | None = None) -> DataFrame:
    """A3 + A5 (+A6): shard from the row image (new values win over keys). Tables the session
    does not know get the skip shard; a mapped table whose shard column id is unknown, a
    record without the shard column, or a shard id that is no valid one (P8: null, empty, with a
    slash) gets ``shard_error`` (route it to the dead letters or fail with ``transforms.validate_shard``).

    A DELETE whose image lacks the column takes the shard of the row version in force
    ``lag_seconds`` before its commit, from the frame or from ``stored`` (``stored_versions``).
    ``lookup_deletes=False`` looks at the record alone; a streaming frame needs that form and
    ``fill_delete_shards`` per micro-batch."""
    d = with_payloads(df).join(_shard_table_map(table_map), F.col("table_name") == F.col("_t"), "left")
    col = F.col("_scol")
    shard = (F.when(F.col("_tid").isNull(), F.lit(skip))
             .when(F.col("_scol").isNull(), F.lit(None).cast("string"))
             .otherwise(V.row_image_text(F.col("_k"), F.col("_n"), col)))
    d = d.select(*df.columns, F.col("_tid"), F.col("_scol"), shard.alias("shard"),
                 V.row_image_has(F.col("_k"), F.col("_n"), col).alias("_has"))
    err = (F.when(F.col("_tid").isNull(), F.lit(None).cast("string"))
           .when(F.col("_scol").isNull(), F.lit("shard column id unknown for table"))
           .when(~F.col("_has"), F.lit(NO_SHARD_COLUMN))
           .otherwise(shard_error(F.col("shard"))))
    out = d.select(*df.columns, "shard", err.alias("shard_error"))
    return fill_delete_shards(out, lag_seconds, stored, skip) if lookup_deletes else out


def fill_delete_shards(df: DataFrame, lag_seconds: int = 1, stored: DataFrame | None = None,
                       skip: str = DEFAULT_SKIP_SHARD) -> DataFrame:
    """A6 after ``shard_by_image``: the shard of deletes that don't carry it, from row versions."""
    probe = (F.col("mod_type") == "DELETE") & F.col("shard_error").eqNullSafe(NO_SHARD_COLUMN)
    version = F.col("shard_error").isNull() & (F.col("shard") != skip) & (F.col("mod_type") != "DELETE")
    d = asof_probes(df.withColumn("_version", F.col("shard")), ["table_name", "keys_json"], "_version", version, probe, "_prior",
                    lag_seconds, _renamed_versions(stored))
    shard = F.when(probe, F.col("_prior")).otherwise(F.col("shard"))
    err = F.when(probe, F.when(F.col("_prior").isNull(), F.lit(NO_VERSION))).otherwise(F.col("shard_error"))
    cols = [c for c in df.columns if c not in ("shard", "shard_error")]
    return d.select(*cols, shard.alias("shard"), err.alias("shard_error"))


def shard_constant(df: DataFrame, shards: DataFrame) -> DataFrame:
    """A4: single-shard mode — every change goes to the first shard in id order."""
    first = shards.select(F.min("logicalShardId").alias("s")).collect()[0]["s"]
    return df.withColumn("shard", F.lit(first))


def shard_mode(shards: DataFrame) -> str:
    """A4 mode choice: more than one shard means multi-shard."""
    return "multi" if shards.limit(2).count() > 1 else "single"


def shard_by_udf(df: DataFrame, factory, params: str = "", with_latency: bool = False) -> DataFrame:
    """User shard function ``fn(table_name, record: dict) -> shard id``.

    ``factory(params)`` builds the function once per task (the ``init`` hook); records are
    passed as the row image (new values over keys). Arrow batches, not rows, cross into
    Python. With ``with_latency`` the per-call latency in ms is returned (G6)."""
    import json as _json

    from riverbed.session import ship_package
    ship_package(df.sparkSession)
    out_type = "struct<shard:string,latency_ms:double>"

    @F.pandas_udf(out_type)
    def _call(it: Iterator[Tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        fn = factory(params)
        for tables, keys, news in it:
            shard, lat = [], []
            for t, k, nv in zip(tables, keys, news):
                rec = _json.loads(k or "{}")
                rec.update(_json.loads(nv or "{}"))
                t0 = time.perf_counter()
                shard.append(fn(t, rec))
                lat.append((time.perf_counter() - t0) * 1000.0)
            yield pd.DataFrame({"shard": shard, "latency_ms": lat})

    r = _call(F.col("table_name"), F.col("keys_json"), F.col("new_values_json"))
    out = df.withColumn("_r", r).withColumn("shard", F.col("_r.shard"))
    if with_latency:
        out = out.withColumn("shard_latency_ms", F.col("_r.latency_ms"))
    return out.drop("_r")


def partition_numbers(shards: DataFrame, shard_col: str = "logicalShardId") -> DataFrame:
    """O3: dense 0-based partition number in shard-id order. The shard list is a configuration
    file: one row per database, numbered by a plain window."""
    return positions(shards.select(shard_col).distinct(), [shard_col], position_col="partition", start=0, method="window")


def attach_partition(df: DataFrame, shards: DataFrame, shard_col: str = "shard") -> DataFrame:
    """Shard id -> message partition number (broadcast lookup of the shard list)."""
    parts = broadcast_checked(partition_numbers(shards).withColumnRenamed("logicalShardId", "_sid"))
    return df.join(parts, df[shard_col] == parts["_sid"], "left").drop("_sid")
