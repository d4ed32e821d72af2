"""Positions in a total order (O1 per-shard order, O3 dense numbering).

``row_number() over (partition by shard order by ...)`` would put a whole shard into one
task; one hot shard can hold a third of all rows. ``positions`` instead range-partitions on
(group, order) so a hot group is split over many tasks, numbers rows inside each sorted
partition, and adds per-(partition, group) offsets computed from a small count frame.
The tagged frame is checkpointed to the shared checkpoint folder so that ids stay stable
if a task is re-run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverbed.session import broadcast_checked, cut_lineage


def _null_safe_eq(left: DataFrame, right: DataFrame, cols) -> Column:
    """Null-safe equality on ``cols``; the right side carries them renamed ``_r_<col>``."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_r_{c}"]) for c in cols])


def _renamed(df: DataFrame, cols) -> DataFrame:
    out = df
    for c in cols:
        out = out.withColumnRenamed(c, f"_r_{c}")
    return out


def positions(df: DataFrame, order_cols, group_cols=(), position_col: str = "position",
              start: int = 1, method: str = "range", num_partitions: int | None = None,
              materialize_input: bool = False) -> DataFrame:
    """Add ``position_col``: 0/1-based rank of each row inside its group by ``order_cols``
    (ties broken arbitrarily but consistently). ``method="window"`` is the plain
    ``row_number`` form for callers that know their groups are small."""
    order_cols = list(order_cols)
    group_cols = list(group_cols)
    if method == "window":
        w = Window.partitionBy(*group_cols).orderBy(*order_cols)
        return df.withColumn(position_col, F.row_number().over(w) + F.lit(start - 1))
    keys = group_cols + order_cols
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if materialize_input:
        # the range partitioner samples its input in a separate pass; for an expensive
        # input (e.g. rendered statements) write it once and let both passes read it
        df = cut_lineage(df, "positions-input")
    tagged = (df.repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = cut_lineage(tagged)
    counts = tagged.groupBy("_pid", *group_cols).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", *group_cols, "_m0",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    offsets = broadcast_checked(_renamed(offsets, ["_pid"] + group_cols))
    cond = _null_safe_eq(tagged, offsets, ["_pid"] + group_cols)
    out = tagged.join(offsets, cond, "inner").select(
        *[tagged[c] for c in tagged.columns if c not in ("_pid", "_mid")],
        (offsets["_off"] + tagged["_mid"] - offsets["_m0"] + F.lit(start)).alias(position_col))
    return out


def prefix_max(df: DataFrame, value_col: str, order_cols, group_cols=(), out_col: str = "prior_max",
               num_partitions: int | None = None) -> DataFrame:
    """Maximum of ``value_col`` over the earlier rows of the same group (exclusive), in
    ``order_cols`` order; NULL for a group's first row.

    Same skew-safe plan as ``positions``: range partitioning on (group, order) splits a hot
    group, a window inside (partition, group) gives the local running max, and a small
    per-(partition, group) summary gives the carry-in from earlier partitions."""
    order_cols = list(order_cols)
    group_cols = list(group_cols)
    keys = group_cols + order_cols
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id()))
    tagged = cut_lineage(tagged)
    w_local = (Window.partitionBy("_pid", *group_cols).orderBy(*order_cols)
               .rowsBetween(Window.unboundedPreceding, -1))
    local = tagged.withColumn("_local", F.max(value_col).over(w_local))
    summ = tagged.groupBy("_pid", *group_cols).agg(F.max(value_col).alias("_pmax"))
    w_carry = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select("_pid", *group_cols, F.max("_pmax").over(w_carry).alias("_carry"))
    carry = broadcast_checked(_renamed(carry, ["_pid"] + group_cols))
    cond = _null_safe_eq(local, carry, ["_pid"] + group_cols)
    out = local.join(carry, cond, "inner")
    return out.select(*[local[c] for c in df.columns],
                      F.greatest(local["_local"], carry["_carry"]).alias(out_col))
