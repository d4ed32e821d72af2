"""Lookups against stored state: shadow test (J3), as-of row version (J4), tables without a
shadow (J5), seen ids (J6), primary-key columns of a table (J7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverbed.session import cut_lineage

SHADOW_PREFIX = "shadow_"          # fixed value: name prefix of shadow tables


def shadow_filter(changes: DataFrame, shadow: DataFrame, key_cols, ts_col: str = "processed_commit_ts",
                  commit_col: str = "commit_ts") -> tuple[DataFrame, DataFrame]:
    """A change is skipped only when its key's stored ``processed_commit_ts`` is later
    than its commit; equal timestamps are re-applied, keys without a shadow row applied.

    Equi-join on the key (shuffle on both sides; AQE splits a hot key's partitions).
    Returns (to_apply, skipped)."""
    key_cols = list(key_cols)
    s = shadow.select(*key_cols, F.col(ts_col).alias("_shadow_ts"))
    j = changes.join(s, key_cols, "left")
    keep = F.col("_shadow_ts").isNull() | (F.col("_shadow_ts") <= F.col(commit_col))
    return j.where(keep), j.where(~keep)


def asof_lookup(probes: DataFrame, versions: DataFrame, key_cols, value_cols, lag_seconds: int = 1,
                bucket_seconds: int = 86400,
                order_cols=("commit_seconds", "commit_nanos", "server_txn_id", "record_sequence")) -> DataFrame:
    """For every probe row, the values of the latest version of the same key whose commit
    is at or before (probe commit - ``lag_seconds``); NULLs when there is none.

    No pairs are formed. Versions and probes are unioned and scanned in time order inside
    (key, time bucket) partitions, so a hot key is split by time; the carry-in from earlier
    buckets comes from a per-(key, bucket) summary (one row per bucket with versions).
    """
    key_cols = list(key_cols)
    value_cols = list(value_cols)
    s, n, txn, seq = order_cols
    place = F.col("mod_position") if "mod_position" in versions.columns else F.lit(0)
    pcols = probes.columns
    v = versions.select(*key_cols, F.col(s).alias("_es"), F.col(n).alias("_en"), F.lit(0).alias("_kind"),
                        F.col(txn).alias("_txn"), F.struct(F.col(seq).alias("s"), place.cast("int").alias("p")).alias("_seq"),
                        F.struct(*value_cols).alias("_val"),
                        F.lit(None).cast(probes.select(F.struct(*pcols)).schema[0].dataType).alias("_probe"))
    p = probes.select(*key_cols, (F.col(s) - F.lit(lag_seconds)).alias("_es"), F.col(n).alias("_en"),
                      F.lit(1).alias("_kind"), F.lit(None).cast("string").alias("_txn"),
                      F.lit(None).cast("struct<s:string,p:int>").alias("_seq"),
                      F.lit(None).cast(versions.select(F.struct(*value_cols)).schema[0].dataType).alias("_val"),
                      F.struct(*pcols).alias("_probe"))
    u = v.unionByName(p).withColumn("_bucket", F.floor(F.col("_es") / F.lit(bucket_seconds)))

    w_in = (Window.partitionBy(*key_cols, "_bucket")
            .orderBy("_es", "_en", "_kind", "_txn", "_seq")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    probed = (u.withColumn("_inb", F.last("_val", ignorenulls=True).over(w_in))
              .where(F.col("_kind") == 1)
              .select(*key_cols, "_bucket", "_probe", "_inb"))

    summary = (u.where(F.col("_kind") == 0)
               .groupBy(*key_cols, "_bucket")
               .agg(F.max_by("_val", F.struct("_es", "_en", "_txn", "_seq")).alias("_val"))
               .withColumn("_m", F.lit(1)))
    markers = (u.where(F.col("_kind") == 1).select(*key_cols, "_bucket").distinct()
               .withColumn("_val", F.lit(None).cast(summary.schema["_val"].dataType))
               .withColumn("_m", F.lit(0)))
    w_carry = (Window.partitionBy(*key_cols).orderBy("_bucket", "_m")
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = (summary.unionByName(markers)
             .withColumn("_carry", F.last("_val", ignorenulls=True).over(w_carry))
             .where(F.col("_m") == 0)
             .select(*key_cols, "_bucket", "_carry"))

    cond = [probed[k].eqNullSafe(carry[k]) for k in key_cols] + [probed["_bucket"] == carry["_bucket"]]
    joined = probed.join(carry, cond, "left")
    best = F.coalesce(probed["_inb"], carry["_carry"])
    return joined.select(*[probed["_probe"][c].alias(c) for c in pcols],
                         *[best[c].alias(c) for c in value_cols])


def asof_probes(df: DataFrame, key_cols, value_col: str, is_version, is_probe, out_col: str, lag_seconds: int = 1,
                stored: DataFrame | None = None) -> DataFrame:
    """J4 on one frame: the rows for which ``is_probe`` holds get, in ``out_col``, the value of the latest
    version of their key with commit <= (their commit - ``lag_seconds``). Versions are the rows for which
    ``is_version`` holds and the rows of ``stored`` (key columns, order columns and ``value_col``), e.g.
    row versions written before the frame begins.

    What the lookup needs (keys, order and value of probes and versions) is written once; the versions of the probes' keys
    (a semi join) are scanned with the probes, and only the probes are joined with what was found: all other rows pass by."""
    key_cols = list(key_cols)
    order = [c for c in ("commit_seconds", "commit_nanos", "server_txn_id", "record_sequence", "mod_position") if c in df.columns]
    ids = [*key_cols, *order]
    probe, version = (F.coalesce(c, F.lit(False)) for c in (is_probe, is_version))
    kind = df.schema[value_col].dataType
    rest = df.where(~probe).withColumn(out_col, F.lit(None).cast(kind))
    narrow = cut_lineage(df.where(probe | version).select(*ids, F.col(value_col).alias("_found_value"), probe.alias("_p"), version.alias("_v")), "probes")
    probes = narrow.where("_p").select(*ids).distinct()
    if probes.isEmpty():
        return rest
    versions = narrow.where("_v").select(*ids, "_found_value")
    if stored is not None:
        extra = [F.lit(-1).alias(c) if c == "mod_position" and c not in stored.columns else F.col(c) for c in order]
        versions = versions.unionByName(stored.select(*key_cols, *extra, F.col(value_col).alias("_found_value")))
    versions = versions.join(probes.select(*key_cols).distinct(), key_cols, "left_semi")
    found = asof_lookup(probes, versions, key_cols, ["_found_value"], lag_seconds).select(*[F.col(c).alias(f"_f_{c}") for c in ids], F.col("_found_value").alias(out_col))
    same = [F.col(c).eqNullSafe(F.col(f"_f_{c}")) for c in ids]
    return rest.unionByName(df.where(probe).join(found, same, "left").select(*rest.columns))


def tables_without_shadow(tables: DataFrame, name_col: str = "table_name", prefix: str = SHADOW_PREFIX) -> DataFrame:
    """Data tables (not shadow tables themselves) that have no ``shadow_<name>`` yet."""
    data = tables.where(~F.col(name_col).startswith(prefix)).select(name_col)
    shadows = tables.where(F.col(name_col).startswith(prefix)).select(
        F.substring(F.col(name_col), len(prefix) + 1, 1 << 20).alias("_base"))
    return data.join(shadows, data[name_col] == shadows["_base"], "left_anti")


def seen(df: DataFrame, seen_ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose id is already recorded (semi join)."""
    return df.join(seen_ids.select(id_col), id_col, "left_semi")


def unseen(df: DataFrame, seen_ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose id is not recorded yet (anti join)."""
    return df.join(seen_ids.select(id_col), id_col, "left_anti")


def pk_columns(catalog: DataFrame, table: str | None = None) -> DataFrame:
    """Primary-key columns in PK order with direction (the shadow table's key)."""
    c = catalog.where(F.col("pk_ordinal").isNotNull())
    if table is not None:
        c = c.where(F.col("table_name") == table)
    return c.select("table_name", "column_name", "stream_type", "pk_ordinal", "pk_desc")
