"""Job compositions (Q1-Q6), batch forms. Streaming forms live in ``riverbed.streaming.jobs``.

Q1 direct replication   : filter -> explode -> modulo shard -> latest per (shard, user) -> DML
Q2 shadow replication   : filter -> explode -> image shard / skip -> shadow test -> DML -> next shadow
Q3 stream to buffer     : filter -> explode -> column shard (as-of for deletes) -> order -> messages
Q4 buffer to database   : parse buffer -> DML per shard
Q5 windowed file export : filter -> explode -> image shard -> window -> files
Q6 table apply          : filter -> explode -> latest per key -> apply to the target table
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed import model
from riverbed.operators import dml as D
from riverbed.operators import lookup as L
from riverbed.operators import sharding as S
from riverbed.operators import transforms as T
from riverbed.operators.latest import latest_per_key
from riverbed.operators.ordering import positions
from riverbed.sinks import messages as MSG
from riverbed.sinks import state as ST
from riverbed.sinks.files import windowed_content


def direct_replication_batch(records: DataFrame, table_map: DataFrame, column_map: DataFrame,
                             shard_count: int = S.DEFAULT_SHARD_COUNT, dialect: str = "mysql",
                             tz_offset: str = "+00:00", filtration: str = "forward_migration",
                             latest_by=("shard", "table_name", "keys_json")) -> tuple[DataFrame, DataFrame]:
    """Q1 (batch): (statements to execute, changes without a statement and why). One change per row of a
    table, its latest. ``latest_by=("shard", "user_id")`` is the reference's mode, in which the changes of
    a user's rows in different tables supersede each other."""
    ch = T.explode_mods(T.filter_changes(records, filtration))
    ch = S.shard_by_mod(ch, "UserId", shard_count)
    lat = latest_per_key(ch, list(latest_by))
    return D.replicable(D.render_dml(lat, table_map, column_map, dialect, tz_offset))


def shadow_replication_batch(records: DataFrame, table_map: DataFrame, column_map: DataFrame,
                             shadow: DataFrame, dialect: str = "mysql", tz_offset: str = "+00:00",
                             skip: str = S.DEFAULT_SKIP_SHARD, filtration: str = "forward_migration",
                             stored: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Q2 (batch): (statements to apply, next shadow version, dead letters as (change columns, error)).

    ``shadow`` is (table_name, pk_value, processed_commit_ts) with ``pk_value`` the
    rendered PK values joined by commas. Changes of unknown tables go to the skip shard
    and are not applied; equal commit timestamps are re-applied; deletes take their shard from row
    versions (``stored`` adds those from before the scan)."""
    ch = T.explode_mods(T.filter_changes(records, filtration))
    ch = S.shard_by_image(ch, table_map, skip, stored=stored)
    dead = ch.where(F.col("shard_error").isNotNull()).drop("shard").withColumnRenamed("shard_error", "error")
    ch = ch.where(F.col("shard_error").isNull() & (F.col("shard") != skip)).drop("shard_error")
    r, unrendered = D.replicable(D.render_dml(ch, table_map, column_map, dialect, tz_offset))
    dead = dead.unionByName(unrendered.withColumn("error", F.col("drop_reason")).select(*dead.columns))
    r = r.withColumn("pk_value", F.col("pk_text"))
    to_apply, older = L.shadow_filter(r, shadow, ["table_name", "pk_value"])
    dead = dead.unionByName(older.withColumn("error", F.lit("older than the last applied commit of its key")).select(*dead.columns))
    nxt = ST.shadow_upsert(shadow, to_apply, ["table_name", "pk_value"])
    return to_apply, nxt, dead


def stream_to_buffer_batch(records: DataFrame, table_map: DataFrame, topic: str, shards: DataFrame,
                           filtration: str = "forward_migration", pretty: bool = False,
                           stored: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Q3 (batch): (Kafka rows per change in per-shard order (``position``), dead letters). Partition numbers
    come from the shard file ``shards``, so that a shard keeps its partition from run to run."""
    ch = T.explode_mods(T.filter_changes(records, filtration))
    sharded, dead = S.split_dropped(S.shard_by_column(ch, table_map, stored=stored))
    bad = T.shard_error(F.col("shard"))
    dead = dead.withColumnRenamed("drop_reason", "error").unionByName(sharded.where(bad.isNotNull()).withColumn("error", bad).drop("shard"))
    ordered = positions(sharded.where(bad.isNull()), model.order_columns(sharded), ["shard"], materialize_input=True)
    return MSG.kafka_frame(ordered, shards, topic, pretty=pretty, extra_cols=["position"]), dead


def buffer_to_database_batch(messages: DataFrame, table_map: DataFrame, column_map: DataFrame, dialect: str = "mysql",
                             tz_offset: str = "+00:00") -> tuple[DataFrame, DataFrame]:
    """Q4 (batch): (statements in (shard, change order), dead letters as (shard, error, record)) of ordered-buffer
    messages (``shard``, ``value``)."""
    good, bad = T.parse_buffer(messages, on_error="dlq")
    r, unrendered = D.replicable(D.render_dml(good, table_map, column_map, dialect, tz_offset))
    dead = bad.select("error", "record").unionByName(unrendered.select(F.col("drop_reason").alias("error"), F.to_json(F.struct("table_name", "keys_json")).alias("record")))
    return r, dead


def windowed_export_batch(records: DataFrame, table_map: DataFrame, size: str,
                          filtration: str = "forward_migration", stored: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Q5 (batch): (content of the sharded, windowed files, dead letters as (change columns, error))."""
    ch = T.explode_mods(T.filter_changes(records, filtration))
    ch = S.shard_by_image(ch, table_map, stored=stored)
    dead = ch.where(F.col("shard_error").isNotNull()).drop("shard").withColumnRenamed("shard_error", "error")
    return windowed_content(ch.where(F.col("shard_error").isNull()).drop("shard_error"), size), dead


def mapped_tables(table_map: DataFrame, column_map: DataFrame) -> dict[str, tuple]:
    """Source table -> (stream table, key columns, other columns) of the mapping, a configuration frame."""
    columns: dict[str, list] = {}
    for c in column_map.where("src_col IS NOT NULL").collect():
        columns.setdefault(c["table_id"], []).append(c)
    out = {}
    for t in table_map.collect():
        cols = sorted(columns.get(t["table_id"], []), key=lambda c: (c["src_pk_ord"] is None, c["src_pk_ord"], c["src_col_pos"]))
        out[t["src_table"]] = (t["sp_table"], [c for c in cols if c["src_pk_ord"] is not None], [c for c in cols if c["src_pk_ord"] is None])
    return out


def typed_changes(ch: DataFrame, keys, rest, types: dict) -> DataFrame:
    """A table's changes (with payloads parsed) as ``apply_changes`` takes them: the target's columns by ``types``, and ``__present``."""
    from riverbed.functions import values as V
    k, n = F.col("_k"), F.col("_n")

    def value(c):
        kind = types[c["src_col"]]
        if c["sp_col"] is None:
            return F.lit(None).cast(kind)
        m = F.when(V.has(k, c["sp_col"]), k).otherwise(n)
        return V.extract(m, c["sp_col"], c["sp_type"]).cast(kind)

    return ch.select("mod_type", *model.order_columns(ch), *[value(c).alias(c["src_col"]) for c in (*keys, *rest)],
                     *[(V.row_image_has(k, n, c["sp_col"]) if c["sp_col"] else F.lit(False)).alias(f"{c['src_col']}__present") for c in rest])


def table_apply_batch(records: DataFrame, table_map: DataFrame, column_map: DataFrame, targets: dict[str, DataFrame],
                      fold: str = "row", filtration: str = "forward_migration") -> dict[str, DataFrame]:
    """Q6 (batch): every source table of the session after the changes of the stream tables that map to it.
    ``targets``: source table -> its present rows. The mapping (a configuration frame) decides the columns and
    their types; a table's changes are one filter on the stream."""
    from riverbed.operators.latest import apply_changes
    ch = T.with_payloads(T.explode_mods(T.filter_changes(records, filtration)))
    tables = mapped_tables(table_map, column_map)
    out = {}
    for name, target in targets.items():
        stream_table, keys, rest = tables[name]
        typed = typed_changes(ch.where(F.col("table_name") == stream_table), keys, rest, dict(target.dtypes))
        out[name] = apply_changes(target, typed, [c["src_col"] for c in keys], [c["src_col"] for c in rest], fold=fold)
    return out
