"""Latest change per key (G1) and applying changes to a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbed import model


def order_struct(order_cols=model.ORDER_COLUMNS) -> Column:
    return F.struct(*[F.col(c) for c in order_cols])


def latest_per_key(df: DataFrame, keys=("table_name", "keys_json"), order_cols=None) -> DataFrame:
    """G1: the last change per key in (commit time, txn id, record sequence, mod position) order.

    ``max_by`` is a partial aggregate: every map task keeps only its latest row per key
    before the shuffle, so a hot key costs one row per task, not a third of the data.
    Reference mode (latest per ``user_id`` inside a shard) is ``keys=("shard", "user_id")``."""
    keys = list(keys)
    order_cols = order_cols or model.order_columns(df)
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order_struct(order_cols)).alias("_r"))
    return agg.select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def apply_changes(target: DataFrame, changes: DataFrame, key_cols, value_cols, fold: str = "row",
                  order_cols=None, mod_col: str = "mod_type") -> DataFrame:
    """the table after executing the changes' upserts and deletes.

    ``changes`` holds typed key columns, ``mod_type``, the order columns and, for every
    target column ``c`` in ``value_cols``, ``c`` (value) and ``c__present`` (was it in the
    record). Upserts set the given columns and keep absent ones; deletes remove the row.

    fold="row": only the latest change per key is executed (the reference's batch
    behaviour; right when records carry the whole row). fold="column": every column takes its latest written value since the last
    delete (right for partial rows). Both are one partial aggregation per key followed by
    a full outer join with the target on the key.
    """
    key_cols = list(key_cols)
    value_cols = list(value_cols)
    o = order_struct(order_cols or model.order_columns(changes))
    is_del = F.col(mod_col) == "DELETE"
    if fold == "row":
        folded = changes.groupBy(*key_cols).agg(
            F.max_by(F.struct(F.col(mod_col).alias("_mod"),
                              *[F.col(c).alias(c) for c in value_cols],
                              *[F.col(f"{c}__present").alias(f"{c}__present") for c in value_cols]), o).alias("_r"),
            F.max(is_del.cast("int")).alias("_any_del"))
        cols = {c: (F.col("_r")[f"{c}__present"], F.col("_r")[c]) for c in value_cols}
        last_mod = F.col("_r._mod")
    elif fold == "column":
        aggs = [F.max_by(F.col(mod_col), o).alias("_mod"), F.max(is_del.cast("int")).alias("_any_del")]
        for c in value_cols:
            touched = F.col(f"{c}__present") | is_del
            aggs.append(F.max_by(F.struct(is_del.alias("d"), F.col(c).alias("v")),
                                 F.when(touched, o)).alias(f"_c_{c}"))
        folded = changes.groupBy(*key_cols).agg(*aggs)
        cols = {c: (F.col(f"_c_{c}").isNotNull() & ~F.coalesce(F.col(f"_c_{c}.d"), F.lit(False)),
                    F.col(f"_c_{c}.v")) for c in value_cols}
        last_mod = F.col("_mod")
    else:
        raise ValueError("fold must be 'row' or 'column'")

    t = target.select(*key_cols, *[F.col(c).alias(f"_t_{c}") for c in value_cols]).withColumn("_in_t", F.lit(True))
    # A target stored bucketed by the key (``save_bucketed``) is read already partitioned,
    # so only the (much smaller) folded changes are shuffled into its layout.
    j = t.join(folded, key_cols, "full")
    had_change = F.col("_any_del").isNotNull()
    keep = ~had_change | (last_mod != "DELETE")
    out = []
    for c in value_cols:
        present, val = cols[c]
        # row fold executes only the latest statement, so the stored row is the base;
        # column fold replays every statement, so a delete clears the base.
        base = (F.col(f"_t_{c}") if fold == "row"
                else F.when(F.col("_any_del") == 1, F.lit(None)).otherwise(F.col(f"_t_{c}")))
        out.append(F.when(~had_change, F.col(f"_t_{c}"))
                   .when(F.coalesce(present, F.lit(False)), val)
                   .otherwise(base).alias(c))
    return j.where(keep).select(*key_cols, *out)


def save_bucketed(df: DataFrame, table: str, key_cols, buckets: int, mode: str = "overwrite") -> None:
    """Store a target table bucketed and sorted by its key, so that applying changes
    (F18) reads it without a shuffle; the next version is written the same way."""
    (df.write.mode(mode).bucketBy(buckets, *key_cols).sortBy(*key_cols).saveAsTable(table))
