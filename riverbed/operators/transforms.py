"""Filters, explode, parse and validity rules on the change stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbed import model
from riverbed.functions import pinned
from riverbed.functions import values as V

LOOP_TAG_PREFIX = "txBy="          # fixed value: transaction-tag prefix of loop-back writes
FILTER_MODES = ("none", "forward_migration")


def filter_changes(df: DataFrame, mode: str = "forward_migration") -> DataFrame:
    """P1 loop filter. ``none`` keeps every record; any other mode drops records whose
    transaction tag starts with ``txBy=``. Untagged (NULL or empty) records are kept."""
    if mode == "none":
        return df
    return df.where(~F.coalesce(F.col("txn_tag"), F.lit("")).startswith(LOOP_TAG_PREFIX))


def explode_mods(df: DataFrame) -> DataFrame:
    """One row per mod, the envelope repeated; ``num_records_in_txn`` unchanged.
    ``mod_position`` is the mod's place in its record (from 0), the last part of the change order.
    A record with no mods yields no row."""
    env = [c for c in model.ENVELOPE if c in df.columns]
    extra = [c for c in df.columns if c not in env and c not in ("mods", "row_type", "partition_token",
                                                                  "is_last_in_txn", "value_capture_type",
                                                                  "num_partitions_in_txn", "is_system_txn")]
    out = df.select(*env, *extra, F.posexplode("mods").alias(model.MOD_POSITION, "_m"))
    return out.select(*env, *extra, model.MOD_POSITION, "_m.keys_json", "_m.old_values_json", "_m.new_values_json")


def parse_buffer(df: DataFrame, value_col: str = "value", on_error: str = "fail") -> tuple[DataFrame, DataFrame | None]:
    """Buffer message (JSON text) -> change row: table, first mod's keys and new values,
    mod type and commit time from seconds+nanos. A message missing any part is an error
    ("Input record is not as expected"); with ``on_error="dlq"`` such messages go to the
    returned dead-letter frame instead."""
    if on_error not in ("fail", "dlq"):
        raise ValueError("on_error must be 'fail' or 'dlq'")
    m = F.from_json(F.col(value_col), model.BUFFER_MESSAGE)
    parsed = df.select(F.col(value_col).alias("_raw"), m.alias("_b"), *[c for c in df.columns if c != value_col])
    first = F.try_element_at(F.col("_b.mods"), F.lit(1))
    secs = F.col("_b.commitTimestamp.seconds")
    nanos = F.col("_b.commitTimestamp.nanos")
    ok = (F.col("_b.tableName").isNotNull() & first.isNotNull() & first["keysJson"].isNotNull()
          & first["newValuesJson"].isNotNull() & F.col("_b.modType").isNotNull()
          & secs.isNotNull() & nanos.isNotNull())
    ok = F.coalesce(ok, F.lit(False))
    good_cols = [
        F.timestamp_micros(secs * 1_000_000 + F.floor(nanos / 1000)).alias("commit_ts"),
        secs.alias("commit_seconds"), nanos.alias("commit_nanos"),
        F.col("_b.serverTransactionId").alias("server_txn_id"),
        F.col("_b.recordSequence").alias("record_sequence"),
        F.col("_b.tableName").alias("table_name"),
        first["keysJson"].alias("keys_json"),
        first["oldValuesJson"].alias("old_values_json"),
        first["newValuesJson"].alias("new_values_json"),
        F.col("_b.modType").alias("mod_type"),
        F.col("_b.numberOfRecordsInTransaction").alias("num_records_in_txn"),
        F.col("_b.transactionTag").alias("txn_tag"),
    ]
    rest = [c for c in df.columns if c != value_col]
    if on_error == "fail":
        # the check rides on a kept column, so column pruning cannot drop it
        err = F.raise_error(F.concat(F.lit("Input record is not as expected: "), F.col("_raw")))
        cols = [F.when(~ok, err).otherwise(F.col("_b.tableName")).alias("table_name") if i == 5 else c
                for i, c in enumerate(good_cols)]
        return parsed.select(*cols, *rest), None
    good = parsed.where(ok).select(*good_cols, *rest)
    bad = parsed.where(~ok).select(F.lit("parse_buffer").alias("stage"),
                                   F.lit("Input record is not as expected").alias("error"),
                                   F.col("_raw").alias("record"), F.current_timestamp().alias("failed_at"))
    return good, bad


def with_payloads(df: DataFrame) -> DataFrame:
    """Parse keys/new-values JSON once into maps ``_k`` / ``_n`` (reused by later steps)."""
    out = df
    if "_k" not in df.columns:
        out = out.withColumn("_k", pinned(V.parse("keys_json")))
    if "_n" not in df.columns:
        out = out.withColumn("_n", pinned(V.parse("new_values_json")))
    return out


def row_image(df: DataFrame, col: str = "row_image") -> DataFrame:
    """P5: all fields of the keys JSON, then of the new-values JSON; new values win."""
    d = with_payloads(df)
    return d.withColumn(col, V.row_image(F.col("_k"), F.col("_n"))).drop("_k", "_n")


def primary_key(df: DataFrame, pk_columns: list[tuple[str, str]], col: str = "pk",
                required: bool = True) -> DataFrame:
    """Typed primary-key struct in PK order from the keys JSON (new values as fallback).
    ``pk_columns`` is [(stream column, stream type)] in PK order; a missing or null part is
    an error when ``required``."""
    d = with_payloads(df)
    parts = []
    for name, typ in pk_columns:
        m = F.when(V.has(F.col("_k"), name), F.col("_k")).otherwise(F.col("_n"))
        parts.append(V.extract(m, name, typ, required=required).alias(name))
    return d.withColumn(col, F.struct(*parts)).drop("_k", "_n")


def change_key(df: DataFrame, col: str = "change_key") -> DataFrame:
    """Display key ``table_keysJson_shard``."""
    return df.withColumn(col, F.concat_ws("_", F.col("table_name"), F.col("keys_json"), F.col("shard")))


def shard_error(shard: Column) -> Column:
    """P8 rule: NULL, empty, or containing ``/`` is not a valid shard id."""
    return (F.when(shard.isNull(), F.lit("shard id is null"))
            .when(shard == "", F.lit("shard id is empty"))
            .when(F.instr(shard, "/") > 0, F.lit("shard id contains '/'")))


def validate_shard(df: DataFrame, shard_col: str = "shard", on_error: str = "fail") -> tuple[DataFrame, DataFrame | None]:
    """Fail (default) or split invalid shard ids into a dead-letter frame."""
    err = shard_error(F.col(shard_col))
    if on_error == "fail":
        return df.withColumn(shard_col, F.when(err.isNotNull(), F.raise_error(err)).otherwise(F.col(shard_col))), None
    tagged = df.withColumn("_err", err)
    bad = tagged.where(F.col("_err").isNotNull()).select(
        F.lit("validate_shard").alias("stage"), F.col("_err").alias("error"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("record"),
        F.current_timestamp().alias("failed_at"))
    return tagged.where(F.col("_err").isNull()).drop("_err"), bad


def redistribute(df: DataFrame, num_partitions: int | None = None, key_cols=("table_name", "keys_json")) -> DataFrame:
    """Spread changes over tasks between stages. The reference reshuffles at random,
    which lets two changes of one key race; here the spread is by (table, key), so all
    changes of a key stay in one task and keep their order, while a hot shard is still
    spread over many tasks. ``key_cols=None`` gives the plain round-robin form."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not key_cols:
        return df.repartition(n)
    return df.repartition(n, *key_cols)
