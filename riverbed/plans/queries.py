"""Registry of queries over the driver tables, one or more per operator of the inventory.

Each entry takes (spark, sf_dir) and returns a DataFrame whose columns carry the same
names as the DuckDB text in ``riverbed.plans.oracle``. Timestamps are shown as
``yyyy-MM-dd HH:mm:ss.SSSSSS`` text (UTC) so both engines print them alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riverbed import model
from riverbed.functions import pinned
from riverbed.functions import values as V
from riverbed.operators import dml as D
from riverbed.operators import lookup as L
from riverbed.operators import metrics as M
from riverbed.operators import sharding as S
from riverbed.operators import transforms as T
from riverbed.operators.latest import apply_changes, latest_per_key
from riverbed.operators.ordering import positions
from riverbed.sources import tables as TB
from riverbed.sources.changes import bound_changes
from riverbed.sources.config import cached_session
from riverbed.sinks import messages as MSG
from riverbed.sinks import state as ST
from riverbed.sinks.topic import buffer_rows, read_topic, write_topic
from riverbed.session import broadcast_checked, cut_lineage, scratch_path, spread, tasks_for
from riverbed.streaming.windows import dedup_ids, window_start

PROCESSING_TS = "2024-02-01 00:00:00"   # fixed "now" for lag metrics, so results are stable
SHADOW_RUN = "run-1"


def ts_text(c) -> Column:
    c = c if isinstance(c, Column) else F.col(c)
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _records(spark, sf):
    return TB.event_changes(TB.load(spark, sf, "events"))


def _spread_records(spark, sf):
    """For queries whose work is in the rows, not in the scan."""
    return TB.event_changes(spread(TB.load(spark, sf, "events")))


def _changes(spark, sf, mode="forward_migration"):
    return T.explode_mods(T.filter_changes(_spread_records(spark, sf), mode))


def _session(spark):
    return cached_session(spark, TB.EVENTS_SESSION)


def _typed(spark, sf):
    return TB.typed_changes(spread(TB.load(spark, sf, "events")))


def _ids(df):
    return [F.col("server_txn_id"), F.col("record_sequence")]


# ----------------------------------------------------------------------------- scans / P*
def s1_scan_range(spark, sf):
    recs = bound_changes(_records(spark, sf), "2024-01-05 00:00:00", "2024-01-20 00:00:00")
    return recs.select(*_ids(recs), "table_name", ts_text("commit_ts").alias("commit_ts"))


def p1_filter_forward(spark, sf):
    r = T.filter_changes(_records(spark, sf), "forward_migration")
    return r.select(*_ids(r), "txn_tag")


def p1_filter_none(spark, sf):
    r = T.filter_changes(_records(spark, sf), "none")
    return r.select(*_ids(r), "txn_tag")


def p2_explode_mods(spark, sf):
    recs = TB.order_records(TB.load(spark, sf, "orders"), TB.load(spark, sf, "lineitem"))
    ch = T.explode_mods(recs)
    return ch.select("server_txn_id", "keys_json", "new_values_json", "mod_type", "num_records_in_txn")


def p3_parse_buffer(spark, sf):
    ch = _changes(spark, sf, "none")
    msgs = MSG.buffer_messages(ch.withColumn("shard", F.lit("s")), pretty=True).select("value")
    parsed, _ = T.parse_buffer(msgs)
    return parsed.select("table_name", "keys_json", "new_values_json", "mod_type",
                         ts_text("commit_ts").alias("commit_ts"), "commit_nanos", *_ids(parsed))


def p5_row_image(spark, sf):
    img = T.row_image(_changes(spark, sf))
    m = F.col("row_image")
    return img.select(*_ids(img), V.text(m, "UserId").alias("user_key"), V.text(m, "value").alias("value_text"),
                      V.text(m, "shard_id").alias("shard_id"), F.size(m).alias("n_fields"))


def p6_primary_key(spark, sf):
    ch = T.primary_key(_changes(spark, sf), [("UserId", "INT64")])
    return ch.select(*_ids(ch), F.col("pk.UserId").alias("pk_user_id"))


def p7_change_key(spark, sf):
    ch = S.shard_by_image(_changes(spark, sf), _session(spark)[0], lookup_deletes=False)
    ch = T.change_key(ch)
    return ch.select(*_ids(ch), "change_key")


def p8_validate_shard(spark, sf):
    ch = _changes(spark, sf)
    ch = ch.withColumn("shard", V.text(V.parse("new_values_json"), "shard_id"))
    good, bad = T.validate_shard(ch.withColumn("shard", F.when(F.col("table_name") == "activity",
                                                              F.concat(F.col("shard"), F.lit("/a")))
                                               .otherwise(F.col("shard"))), on_error="dlq")
    g = good.select(*_ids(good), F.col("shard"), F.lit(None).cast("string").alias("shard_error"))
    b = bad.select(F.get_json_object("record", "$.server_txn_id").alias("server_txn_id"),
                   F.get_json_object("record", "$.record_sequence").alias("record_sequence"),
                   F.get_json_object("record", "$.shard").alias("shard"), F.col("error").alias("shard_error"))
    return g.unionByName(b)


def p9_replicable(spark, sf):
    tm, cm = _session(spark)
    r = D.render_dml(_changes(spark, sf), tm, cm, "mysql")
    return r.select(*_ids(r), "table_name", "drop_reason")


# ----------------------------------------------------------------------------- typed X*
def _typed_payload(spark, sf):
    t = _typed(spark, sf)
    return t.select("server_txn_id", V.parse("new_values_json").alias("m"))


def x1_to_boolean(spark, sf):
    t = _typed_payload(spark, sf)
    return t.select("server_txn_id", V.to_boolean(F.col("m"), "b").alias("b"),
                    V.to_boolean(F.col("m"), "s").alias("s_as_bool"), V.to_boolean(F.col("m"), "nul").alias("nul"))


def x2_to_long(spark, sf):
    t = _typed(spark, sf).select("server_txn_id", V.parse("keys_json").alias("k"), V.parse("new_values_json").alias("m"))
    return t.select("server_txn_id", V.to_long(F.col("k"), "id").alias("id"),
                    V.to_long(F.col("m"), "f").alias("f_as_long"), V.to_long(F.col("m"), "s").alias("s_as_long"))


def x3_to_double(spark, sf):
    t = _typed_payload(spark, sf)
    return t.select("server_txn_id", V.to_double(F.col("m"), "f").alias("f"), V.to_double(F.col("m"), "n").alias("n"),
                    V.to_double(F.col("m"), "s").alias("s_as_double"))


def x4_to_string(spark, sf):
    t = _typed_payload(spark, sf)
    return t.select("server_txn_id", V.to_string(F.col("m"), "s").alias("s"), V.to_string(F.col("m"), "f").alias("f"),
                    V.to_string(F.col("m"), "b").alias("b"), V.to_string(F.col("m"), "q").alias("q"))


def x5_to_bytes(spark, sf):
    t = _typed_payload(spark, sf)
    return t.select("server_txn_id", F.hex(V.to_bytes(F.col("m"), "by")).alias("by_hex"))


def x6_to_timestamp(spark, sf):
    t = _typed_payload(spark, sf)
    return t.select("server_txn_id", ts_text(V.to_timestamp(F.col("m"), "t")).alias("t"),
                    V.timestamp_nanos(F.col("m"), "t").alias("t_nanos"),
                    ts_text(V.to_timestamp(F.col("m"), "d")).alias("d_as_ts"))


def x7_to_date(spark, sf):
    t = _typed_payload(spark, sf)
    return t.select("server_txn_id", F.date_format(V.to_date(F.col("m"), "d"), "yyyy-MM-dd").alias("d"),
                    F.date_format(V.to_date(F.col("m"), "f"), "yyyy-MM-dd").alias("f_as_date"))


def x8_to_numeric(spark, sf):
    t = _typed_payload(spark, sf)
    return t.select("server_txn_id", V.to_numeric(F.col("m"), "n").cast("string").alias("n"),
                    V.to_numeric(F.col("m"), "f").cast("string").alias("f"))


def x8_wide_numeric(spark, sf):
    t = TB.wide_numbers(TB.load(spark, sf, "events")).select("event_id", pinned(V.parse("j")).alias("m"), pinned(V.exact("j")).alias("x"))
    return t.select("event_id", V.to_numeric_text(F.col("m"), "n", exact_m=F.col("x")).alias("n"), V.to_numeric_text(F.col("m"), "s").alias("s"))


def x9_presence(spark, sf):
    t = _typed_payload(spark, sf)
    m = F.col("m")
    return t.select("server_txn_id", V.has(m, "nul").alias("has_nul"), V.is_json_null(m, "nul").alias("nul_is_null"),
                    V.has(m, "zz").alias("has_zz"), V.is_json_null(m, "s").alias("s_is_null"))


# ----------------------------------------------------------------------------- sharding A*
def a1_shard_mod(spark, sf):
    ch = S.shard_by_mod(_changes(spark, sf), "UserId", 7)
    return ch.select(*_ids(ch), "user_id", "shard")


def a2_shard_column(spark, sf):
    tm, _ = _session(spark)
    out = S.shard_by_column(_changes(spark, sf), tm)
    return out.select(*_ids(out), "shard", "drop_reason")


def a3_shard_image(spark, sf):
    ch = S.shard_by_image(_changes(spark, sf), _session(spark)[0], lookup_deletes=False)
    return ch.select(*_ids(ch), "shard", "shard_error")


def a6_image_deletes(spark, sf):
    """Image sharding, deletes by the row version in force a second before their commit."""
    ch = S.shard_by_image(_changes(spark, sf), _session(spark)[0])
    return ch.select(*_ids(ch), "shard", "shard_error")


VERSIONS_UNTIL = "2024-01-15 00:00:00"


def a6_stored_versions(spark, sf):
    """A6 from stored row versions: a scan that begins at VERSIONS_UNTIL finds the shards of rows that were
    written before it in the versions kept from then."""
    tm, _ = _session(spark)
    ch = _changes(spark, sf)
    begin = F.lit(VERSIONS_UNTIL).cast("timestamp")
    stored = S.stored_versions(ch.where(F.col("commit_ts") < begin), tm)
    out = S.shard_by_image(ch.where(F.col("commit_ts") >= begin), tm, stored=stored)
    return out.select(*_ids(out), "shard", "shard_error")


def a4_shard_constant(spark, sf):
    shards = TB.supplier_shards(TB.load(spark, sf, "supplier"))
    ch = S.shard_constant(_changes(spark, sf), shards)
    return ch.select(*_ids(ch), "shard")


class TableBucketShard:
    """Example user shard function (A7): ``<table>-<UserId mod n>``; ``n`` from the params."""

    def __init__(self, params: str):
        self.n = int(params or "3")

    def __call__(self, table, record):
        return f"{table}-{int(record.get('UserId', 0)) % self.n}"


def a7_shard_udf(spark, sf):
    ch = S.shard_by_udf(_changes(spark, sf), TableBucketShard, "3", with_latency=True)
    return ch.select(*_ids(ch), "shard", (F.col("shard_latency_ms") >= 0).alias("timed"))


# ----------------------------------------------------------------------------- joins J*
def j1_map_tables(spark, sf):
    from riverbed.operators.mapping import map_tables
    tm, _ = _session(spark)
    ch = map_tables(_changes(spark, sf), tm)
    return ch.select(*_ids(ch), "table_id", "src_table")


def _account_shadow(spark, sf):
    return TB.account_shadow(TB.load(spark, sf, "customer"))


def j3_shadow_filter(spark, sf):
    ch = T.primary_key(_changes(spark, sf).where(F.col("table_name") == "account"), [("UserId", "INT64")])
    ch = ch.withColumn("UserId", F.col("pk.UserId"))
    apply_, skip = L.shadow_filter(ch, _account_shadow(spark, sf), ["table_name", "UserId"])
    return (apply_.select(*_ids(apply_), F.lit(True).alias("applied"))
            .unionByName(skip.select(*_ids(skip), F.lit(False).alias("applied"))))


def j4_asof_lookup(spark, sf):
    ch = T.with_payloads(_changes(spark, sf))
    ch = ch.withColumn("value_text", V.text(F.col("_n"), "value")).drop("_k", "_n")
    versions = ch.where(F.col("value_text").isNotNull())
    probes = ch.select("table_name", "keys_json", *model.ORDER_COLUMNS)
    out = L.asof_lookup(probes, versions, ["table_name", "keys_json"], ["value_text"], lag_seconds=1)
    return out.select(*_ids(out), F.col("value_text").alias("prior_value"))


def _table_names(spark, sf):
    names = _records(spark, sf).select("table_name").distinct()
    shadows = names.where(F.col("table_name") == "account").select(
        F.concat(F.lit("shadow_"), F.col("table_name")).alias("table_name"))
    return names.unionByName(shadows)


def j5_tables_without_shadow(spark, sf):
    return L.tables_without_shadow(_table_names(spark, sf))


def _seen_ids(spark, sf):
    ev = TB.load(spark, sf, "events")
    return ev.where(F.col("event_type") == "signup").select(F.col("user_id").alias("id"),
                                                            F.col("ts").cast("timestamp").alias("created_at"))


def j6_seen_ids(spark, sf):
    ev = TB.load(spark, sf, "events").select("event_id", F.col("user_id").alias("id"))
    seen_ids = _seen_ids(spark, sf)
    return (L.seen(ev, seen_ids).select("event_id", F.lit(True).alias("seen"))
            .unionByName(L.unseen(ev, seen_ids).select("event_id", F.lit(False).alias("seen"))))


def _supplier_shard_of(user_id: Column) -> Column:
    return F.concat(F.lit("shard"), F.lpad((user_id % 100 + 1).cast("string"), 5, "0"))


def j8_kafka_partition(spark, sf):
    shards = TB.supplier_shards(TB.load(spark, sf, "supplier"))
    ch = S.shard_by_mod(_changes(spark, sf), "UserId", 1 << 30)
    ch = ch.withColumn("shard", _supplier_shard_of(F.col("user_id")))
    out = S.attach_partition(ch, shards)
    return out.select(*_ids(out), "shard", "partition")


# ----------------------------------------------------------------------------- G* / O*
def g1_latest_per_key(spark, sf):
    lat = latest_per_key(_changes(spark, sf), ["table_name", "keys_json"])
    return lat.select("table_name", "keys_json", *_ids(lat), "mod_type")


def _dealt_mods(spark, sf):
    lines = TB.load(spark, sf, "lineitem")
    recs = TB.order_records(TB.load(spark, sf, "orders"), lines)
    ch = T.explode_mods(recs).withColumn("keys_json", F.concat(F.lit('{"l_orderkey":"'), F.get_json_object("keys_json", "$.l_orderkey"), F.lit('"}')))
    return T.redistribute(ch, tasks_for(lines, least=7), ("server_txn_id", model.MOD_POSITION))


def g1_repeated_keys(spark, sf):
    """G1 where a record changes a row several times: the last of its mods counts. A record's mods are
    dealt over tasks first, as many as the line items need: each task sorts its share."""
    lat = latest_per_key(_dealt_mods(spark, sf))
    return lat.select("keys_json", "server_txn_id", "mod_position", "new_values_json")


def g1_latest_reference_mode(spark, sf):
    ch = S.shard_by_mod(_changes(spark, sf), "UserId", 5)
    lat = latest_per_key(ch, ["shard", "user_id"])
    return lat.select("shard", "user_id", *_ids(lat), "table_name")


def _image_sharded(spark, sf):
    ch = S.shard_by_image(_changes(spark, sf), _session(spark)[0], lookup_deletes=False)
    return ch.withColumn("shard", F.coalesce(F.col("shard"), F.lit("unknown")))


def g2_release_lag(spark, sf):
    out = M.release_lag_ms(_image_sharded(spark, sf), PROCESSING_TS)
    return out.select("shard", ts_text("earliest_commit_ts").alias("earliest_commit_ts"),
                      F.col("lag_ms").cast("bigint").alias("lag_ms"))


def g3_batch_lag(spark, sf):
    out = M.batch_lag_seconds(_image_sharded(spark, sf), PROCESSING_TS)
    return out.select("shard", ts_text("first_commit_ts").alias("first_commit_ts"), "lag_seconds")


def g4_record_counts(spark, sf):
    return M.record_counts(_image_sharded(spark, sf)).select("shard", "records", "scope")


def g5_lag_distribution(spark, sf):
    ch = _image_sharded(spark, sf).withColumn(
        "lag_ms", F.floor((F.unix_micros(F.lit(PROCESSING_TS).cast("timestamp")) - F.unix_micros("commit_ts")) / 1000))
    return M.lag_distribution(ch).select("shard", "n", F.col("sum").alias("sum_ms"), F.col("min").alias("min_ms"),
                                         F.col("max").alias("max_ms"), "scope")


def g5_lag_meter(spark, sf):
    """G5 live: the lags go into the meter in four batches by the day of the commit; its report over all of them, and whether the quantiles'
    ranks among the rows themselves are where they should be."""
    from riverbed.streaming.meters import Meter
    ch = cut_lineage(_image_sharded(spark, sf).select("shard", "commit_ts", "commit_seconds"), "lags")
    meter = Meter(spark, scratch_path(spark, "meter"))
    for i in range(4):
        meter.put_lag(ch.where(F.pmod(F.floor(F.col("commit_seconds") / 86400), F.lit(4)) == i), i, PROCESSING_TS)
    rep = meter.report((0.5, 0.99))
    lags = ch.withColumn("lag", F.floor((F.unix_micros(F.lit(PROCESSING_TS).cast("timestamp")) - F.unix_micros("commit_ts")) / 1000))
    ranks = (lags.join(broadcast_checked(rep.where("scope = 'shard'").select("shard", "p50", "p99")), "shard").groupBy("shard")
             .agg(*[F.avg((F.col("lag") < F.col(p)).cast("double")).alias(f"{p}_below") for p in ("p50", "p99")],
                  *[F.avg((F.col("lag") <= F.col(p)).cast("double")).alias(f"{p}_upto") for p in ("p50", "p99")]))
    within = lambda p, q: F.coalesce((F.col(f"{p}_below") <= q + 2 * Meter.error) & (F.col(f"{p}_upto") >= q - 2 * Meter.error), F.col("scope") == "all")
    return (rep.join(ranks, "shard", "left")
            .select("shard", "n", F.col("sum").cast("bigint").alias("sum_ms"), F.col("min").cast("bigint").alias("min_ms"), F.col("max").cast("bigint").alias("max_ms"),
                    "scope", within("p50", 0.5).alias("p50_holds"), within("p99", 0.99).alias("p99_holds")))


def g6_latency_meter(spark, sf):
    """The user shard function's latency per shard; times differ from run to run, so only their order is told."""
    from riverbed.streaming.meters import Meter
    meter = Meter(spark, scratch_path(spark, "meter"))
    meter.put(S.shard_by_udf(_changes(spark, sf), TableBucketShard, "3", with_latency=True), 0, latency_ms=F.col("shard_latency_ms"))
    r = meter.report((0.5, 0.99))
    inside = (F.col("min") >= 0) & (F.col("min") <= F.col("p50")) & (F.col("p50") <= F.col("p99")) & (F.col("p99") <= F.col("max")) & (F.col("sum") >= F.col("max") - 0.001)
    return r.select("measure", "shard", "scope", "n", inside.alias("in_order"))


def _file_progress(spark, sf):
    ch = _image_sharded(spark, sf)
    return ch.select(F.lit(SHADOW_RUN).alias("run_id"), "shard",
                     window_start(F.col("commit_ts"), "6h").alias("file_start_interval"))


def g7_min_file_start(spark, sf):
    out = M.min_file_start(_file_progress(spark, sf), SHADOW_RUN)
    return out.select(ts_text("min_start").alias("min_start"))


def g8_advance_progress(spark, sf):
    p = _file_progress(spark, sf)
    current = p.groupBy("run_id", "shard").agg(F.min("file_start_interval").alias("created_upto"))
    updates = p.where(F.col("shard") != "shard0").select("run_id", "shard",
                                                        F.col("file_start_interval").alias("created_upto"))
    out = M.advance_progress(current, updates)
    return out.select("run_id", "shard", ts_text("created_upto").alias("created_upto"))


def g9_statement_batches(spark, sf):
    tm, cm = _session(spark)
    r = D.render_dml(_image_sharded(spark, sf), tm, cm, "mysql")
    b = D.statement_batches(r, model.ORDER_COLUMNS, "shard", batch_size=50)
    return b.select("shard", "batch_no", "first_position", "n_statements",
                    F.array_join("statements", "\n").alias("batch_text"))


def o1_shard_order(spark, sf):
    ch = _image_sharded(spark, sf)
    out = positions(ch, model.ORDER_COLUMNS, ["shard"])
    return out.select("shard", *_ids(out), "position")


PULL_CAP = 100   # messages per pull here (a top-k per shard: small enough to leave most of them out)


def o4_first_pull(spark, sf):
    """The first pull of every shard — its first PULL_CAP changes in change order. A filter on
    row_number lets every task keep the first PULL_CAP of a shard only, before the shuffle."""
    out = positions(_image_sharded(spark, sf), model.ORDER_COLUMNS, ["shard"], method="window")
    out = out.where(F.col("position") <= PULL_CAP)
    return out.select("shard", *_ids(out), "position")


def o3_partition_numbers(spark, sf):
    shards = TB.supplier_shards(TB.load(spark, sf, "supplier"))
    return S.partition_numbers(shards)


# ----------------------------------------------------------------------------- DML F*
TZ_OFFSET = "+05:30"


def _typed_session(spark, only_pk=False):
    sess = TB.TYPED_SESSION
    if only_pk:
        src = dict(sess["SrcSchema"]["t9"])
        src["ColDefs"] = {"c20": src["ColDefs"]["c20"]}
        src["ColIds"] = ["c20"]
        src["Name"] = "typed_keys"
        sess = {"SpSchema": sess["SpSchema"], "SrcSchema": {"t9": src}}
    return cached_session(spark, sess)


def f_dml_mysql_typed(spark, sf):
    tm, cm = _typed_session(spark)
    r = D.render_dml(_typed(spark, sf), tm, cm, "mysql", TZ_OFFSET)
    return r.select("server_txn_id", "dml")


def f_dml_postgres_typed(spark, sf):
    tm, cm = _typed_session(spark)
    r = D.render_dml(_typed(spark, sf), tm, cm, "postgresql", TZ_OFFSET)
    return r.select("server_txn_id", "dml")


def f7_escape_backslash(spark, sf):
    tm, cm = _typed_session(spark)
    ch = _typed(spark, sf).withColumn("new_values_json", F.replace(F.col("new_values_json"), F.lit("it's"),
                                                                   F.lit("it\\\\'s")))
    r = D.render_dml(ch, tm, cm, "mysql", TZ_OFFSET, escape_backslash=True)
    return r.select("server_txn_id", "dml")


def f12_mysql_events(spark, sf):
    tm, cm = _session(spark)
    r = D.render_dml(_changes(spark, sf), tm, cm, "mysql")
    return r.select(*_ids(r), "dml")


def f13_postgres_events(spark, sf):
    tm, cm = _session(spark)
    r = D.render_dml(_changes(spark, sf), tm, cm, "postgresql")
    return r.select(*_ids(r), "dml")


def f14_pk_only(spark, sf):
    tm, cm = _typed_session(spark, only_pk=True)
    out = []
    for d in ("mysql", "postgresql"):
        r = D.render_dml(_typed(spark, sf), tm, cm, d)
        out.append(r.select("server_txn_id", F.lit(d).alias("dialect"), "dml"))
    return out[0].unionByName(out[1])


def f17_connection_urls(spark, sf):
    shards = TB.supplier_shards(TB.load(spark, sf, "supplier"))
    my = D.connection_urls(shards, "mysql").withColumn("source_type", F.lit("mysql"))
    pg = D.connection_urls(shards, "postgresql", tls=True).withColumn("source_type", F.lit("postgresql"))
    return my.unionByName(pg)


def _account_typed(spark, sf):
    ch = T.with_payloads(_changes(spark, sf).where(F.col("table_name") == "account"))
    k, n = F.col("_k"), F.col("_n")
    return ch.select(V.to_long(k, "UserId").alias("user_id"), "mod_type", *model.ORDER_COLUMNS,
                     V.to_double(n, "value").alias("balance"), V.has(n, "value").alias("balance__present"),
                     V.text(n, "props").alias("attrs"), V.has(n, "props").alias("attrs__present"),
                     F.lit(None).cast("string").alias("note"), F.lit(False).alias("note__present"))


def _apply(spark, sf, fold):
    target = TB.accounts_target(TB.load(spark, sf, "customer"))
    return apply_changes(target, _account_typed(spark, sf), ["user_id"], ["balance", "attrs", "note"], fold=fold)


def f18_apply_row(spark, sf):
    return _apply(spark, sf, "row")


def f18_apply_column(spark, sf):
    return _apply(spark, sf, "column")


APPLY_BATCHES = 4


def f18_stored_target(spark, sf):
    """F18 on a stored table: the accounts' changes in APPLY_BATCHES batches by commit time, each of which rewrites
    the buckets of its keys. The columns' latest values don't depend on the batches (SQL: all changes at once)."""
    from riverbed.streaming.target import StoredTarget
    rows = TB.accounts_target(TB.load(spark, sf, "customer"))
    target = StoredTarget(spark, scratch_path(spark, "accounts"), "user_id bigint, balance double, attrs string, note string", ["user_id"], buckets=16)
    target.start(rows)
    changes = _account_typed(spark, sf)
    ends = changes.agg(F.min("commit_seconds").alias("a"), F.max("commit_seconds").alias("b")).first()
    if ends["a"] is not None:
        width = (ends["b"] - ends["a"]) // APPLY_BATCHES + 1
        for i in range(APPLY_BATCHES):
            target.apply(changes.where(F.floor((F.col("commit_seconds") - ends["a"]) / width) == i), i)
    return target.read()


# ----------------------------------------------------------------------------- W*
def w8_window_start(spark, sf):
    ev = TB.load(spark, sf, "events").withColumn("t", F.col("ts").cast("timestamp"))
    return ev.select("event_id", ts_text(window_start(F.col("t"), "10s")).alias("w10s"),
                     ts_text(window_start(F.col("t"), "5m")).alias("w5m"),
                     ts_text(window_start(F.col("t"), "2h")).alias("w2h"))


RELEASE_INTERVAL = "6 hours"


def w1_release_all(spark, sf):
    """W1 twin: all changes in the order of their shard, with the interval that releases them."""
    from riverbed.streaming.ordered import commit_ms, interval_ms, release_batch
    i = interval_ms(RELEASE_INTERVAL)
    out = positions(release_batch(_image_sharded(spark, sf)), [*model.ORDER_COLUMNS, "mod_position"], ["shard"])
    return out.select("shard", *_ids(out), "position", ((F.floor(commit_ms() / i) + 1) * i).alias("released_at_ms"))


def w2_release_latest(spark, sf):
    """W2 twin: per interval the latest change of each key."""
    from riverbed.streaming.ordered import release_batch
    out = release_batch(_image_sharded(spark, sf), "latest", RELEASE_INTERVAL)
    return out.select("shard", "table_name", "keys_json", "released_at_ms", *_ids(out))


def w10_redistribute(spark, sf):
    out = T.redistribute(_changes(spark, sf))
    return out.select(*_ids(out), "table_name", "keys_json")


def _arrival(df):
    """Out-of-order arrival: event ids ending in the same digit arrive together, so later
    commits often arrive before earlier ones."""
    eid = F.col("server_txn_id").cast("bigint") * 4 + F.col("record_sequence").cast("bigint")
    return df.withColumn("arrival", eid % 10 * 1000000 + eid)


def w9_guard_twin(spark, sf):
    from riverbed.streaming.guard import guard_batch
    ch = _arrival(_changes(spark, sf))
    kept, skipped = guard_batch(ch, ["table_name", "keys_json"], "arrival")
    return (kept.select(*_ids(kept), F.lit(True).alias("kept"))
            .unionByName(skipped.select(*_ids(skipped), F.lit(False).alias("kept"))))


def w11_dedup_ids(spark, sf):
    ev = TB.load(spark, sf, "events")
    ids = ev.select(F.col("user_id").alias("id"), F.col("ts").cast("timestamp").alias("created_at"))
    out = dedup_ids(ids, now="2024-02-10 00:00:00")
    return out.select("id", ts_text("created_at").alias("created_at"))


# ----------------------------------------------------------------------------- sinks K*
def _supplier_sharded(spark, sf):
    ch = S.shard_by_mod(_changes(spark, sf), "UserId", 1 << 30)
    return ch.withColumn("shard", _supplier_shard_of(F.col("user_id"))).drop("user_id")


def k1_kafka_frame(spark, sf):
    shards = TB.supplier_shards(TB.load(spark, sf, "supplier"))
    fr = MSG.kafka_frame(_supplier_sharded(spark, sf), shards, "changes", pretty=False)
    return fr.select("topic", "partition", "key", "value", *_ids(fr))


def k2_ordered_topic(spark, sf):
    fr = MSG.ordered_topic_frame(_supplier_sharded(spark, sf))
    return fr.select("ordering_key", F.col("attributes")["shardId"].alias("shard_attr"), "data", *_ids(fr))


def _topic(spark, sf):
    path = scratch_path(spark, "topic")
    write_topic(MSG.ordered_topic_frame(_supplier_sharded(spark, sf)), path)
    return path


def k2_topic_messages(spark, sf):
    """K2: every message written to an ordered topic and read back, with its position in its shard."""
    got = read_topic(spark, _topic(spark, sf))
    return got.select("ordering_key", "position", F.col("attributes")["shardId"].alias("shard_attr"), "data")


def s3_capped_pull(spark, sf):
    """S3: what the first pull of a subscription takes of every shard."""
    return buffer_rows(read_topic(spark, _topic(spark, sf), max_messages=PULL_CAP))


def k5_shadow_upsert(spark, sf):
    ch = T.primary_key(_changes(spark, sf).where(F.col("table_name") == "account"), [("UserId", "INT64")])
    ch = ch.withColumn("UserId", F.col("pk.UserId"))
    shadow = _account_shadow(spark, sf)
    to_apply, _ = L.shadow_filter(ch, shadow, ["table_name", "UserId"])
    nxt = ST.shadow_upsert(shadow, to_apply, ["table_name", "UserId"])
    return nxt.select("table_name", "UserId", ts_text("processed_commit_ts").alias("processed_commit_ts"))


def k7_metadata(spark, sf):
    """K7: the runs' rows (here: a run per event type, from its first event) after one run starts anew."""
    ev = TB.load(spark, sf, "events")
    runs = ev.groupBy(F.col("event_type").alias("run_id")).agg(F.min(F.col("ts").cast("timestamp")).alias("t"))
    runs = runs.select("run_id", window_start(F.col("t"), "1h").alias("start_ts"), F.lit("1h").alias("window_duration"))
    out = ST.upsert_metadata(spark, runs, "signup", "2024-01-01T10:26:02.707Z", "10s")
    return out.select("run_id", ts_text("start_ts").alias("start_ts"), "window_duration")


def k8_progress_init(spark, sf):
    shards = TB.supplier_shards(TB.load(spark, sf, "supplier"))
    out = ST.init_progress(shards, SHADOW_RUN)
    return out.select("run_id", "shard", ts_text("created_upto").alias("created_upto"))


def k9_seen_insert(spark, sf):
    ev = TB.load(spark, sf, "events")
    old = ev.where(F.col("event_type") == "signup").select(F.col("user_id").alias("id"),
                                                           F.col("ts").cast("timestamp").alias("created_at"))
    new = ev.where(F.col("event_type") != "signup").select(F.col("user_id").alias("id"),
                                                           F.col("ts").cast("timestamp").alias("created_at"))
    out = ST.record_seen(old, new)
    return out.select("id", ts_text("created_at").alias("created_at"))


def k10_skip_rows(spark, sf):
    ch = S.shard_by_image(_changes(spark, sf), _session(spark)[0], lookup_deletes=False)
    sk = ch.where(F.col("shard") == S.DEFAULT_SKIP_SHARD)
    return sk.select(*_ids(sk), "table_name", "shard")


def k11_dead_letters(spark, sf):
    from riverbed.sinks.files import dead_letters
    ch = S.shard_by_image(_changes(spark, sf), _session(spark)[0], lookup_deletes=False)
    bad = ch.where(F.col("shard_error").isNotNull()).select(*_ids(ch), "table_name", "shard_error")
    dl = dead_letters(bad, "assign_shard", "shard_error")
    return dl.select("stage", "error", F.get_json_object("record", "$.server_txn_id").alias("server_txn_id"),
                     F.get_json_object("record", "$.record_sequence").alias("record_sequence"))


def k12_windowed_export(spark, sf):
    from riverbed.sinks.files import windowed_content
    out = windowed_content(_image_sharded(spark, sf), "1h")
    return out.select("shard", ts_text("window_start").alias("window_start"), *_ids(out), "record")


# ----------------------------------------------------------------------------- jobs Q*
def q1_direct_replication(spark, sf):
    from riverbed.plans.jobs import direct_replication_batch
    tm, cm = _session(spark)
    out, _ = direct_replication_batch(_spread_records(spark, sf), tm, cm, shard_count=500)
    return out.select("shard", "user_id", *_ids(out), "dml")


def q1_reference_mode(spark, sf):
    """Q1 with the reference's key: a user's changes supersede each other, whatever their table."""
    from riverbed.plans.jobs import direct_replication_batch
    tm, cm = _session(spark)
    out, _ = direct_replication_batch(_spread_records(spark, sf), tm, cm, shard_count=500, latest_by=("shard", "user_id"))
    return out.select("shard", "user_id", *_ids(out), "dml")


def _q2(spark, sf):
    from riverbed.plans.jobs import shadow_replication_batch
    tm, cm = _session(spark)
    shadow = _account_shadow(spark, sf).withColumnRenamed("UserId", "pk_value")
    return shadow_replication_batch(_spread_records(spark, sf), tm, cm, shadow.withColumn("pk_value", F.col("pk_value").cast("string")), dialect="postgresql")


def q2_shadow_replication(spark, sf):
    out, _, _ = _q2(spark, sf)
    return out.select(*_ids(out), "shard", "dml")


def q2_dead_letters(spark, sf):
    """What Q2 neither applies nor skips by rule, and why."""
    _, _, dead = _q2(spark, sf)
    return dead.select(*_ids(dead), "table_name", "error")


def _event_shards(spark, sf):
    """The shard file of the event stream's four shards, from the customers that have them."""
    return TB.load(spark, sf, "customer").select(F.concat(F.lit("shard"), (F.col("c_custkey") % 4).cast("string")).alias("logicalShardId")).distinct()


def q3_stream_to_buffer(spark, sf):
    from riverbed.plans.jobs import stream_to_buffer_batch
    tm, _ = _session(spark)
    out, _ = stream_to_buffer_batch(_spread_records(spark, sf), tm, "changes", _event_shards(spark, sf))
    return out.select("key", "partition", "position", "value")


def q4_buffer_to_database(spark, sf):
    from riverbed.plans.jobs import buffer_to_database_batch
    tm, cm = _session(spark)
    messages = MSG.buffer_messages(_supplier_sharded(spark, sf), pretty=False).select("shard", "value")
    out, _ = buffer_to_database_batch(messages, tm, cm)
    return out.select("shard", *_ids(out), "dml")


def q5_windowed_export(spark, sf):
    from riverbed.plans.jobs import windowed_export_batch
    tm, _ = _session(spark)
    out, _ = windowed_export_batch(_spread_records(spark, sf), tm, "1h")
    return out.select("shard", ts_text("window_start").alias("window_start"), *_ids(out), "record")


def q6_table_apply(spark, sf):
    """Q6: the change stream applied to every table that it is mapped to: the accounts, and the activity log
    that begins with the customers of even nations."""
    from riverbed.plans.jobs import table_apply_batch
    customer = TB.load(spark, sf, "customer")
    targets = {
        "accounts": TB.accounts_target(customer),
        "activity_log": customer.where(F.col("c_nationkey") % 2 == 0).select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("amount"), F.lit(None).cast("string").alias("props")),
    }
    tm, cm = _session(spark)
    done = table_apply_batch(_spread_records(spark, sf), tm, cm, targets)
    acc, act = done["accounts"], done["activity_log"]
    return (acc.select(F.lit("accounts").alias("src_table"), "user_id", F.col("balance").alias("amount"), F.col("attrs").alias("doc"), "note")
            .unionByName(act.select(F.lit("activity_log").alias("src_table"), "user_id", "amount", F.col("props").alias("doc"), F.lit(None).cast("string").alias("note"))))


def f1_exact_numbers(spark, sf):
    """F1 with a long fraction, and a nested field of the same name before it."""
    tm, cm = _session(spark)
    ch = _changes(spark, sf).where(F.col("table_name") == "account")
    eid = F.col("server_txn_id").cast("bigint") * 4 + F.col("record_sequence").cast("bigint")
    ch = ch.withColumn("new_values_json", F.when(F.col("mod_type") == "DELETE", F.lit("{}")).otherwise(
        F.concat(F.lit('{"props":{"value":7,"t":"1, 2: 3"},"value":'), eid.cast("string"), F.lit(".01234567890123456789}"))))
    r = D.render_dml(ch, tm, cm, "mysql")
    return r.select(*_ids(r), "dml")


_NAMES = """
s1_scan_range p1_filter_forward p1_filter_none p2_explode_mods p3_parse_buffer p5_row_image p6_primary_key
p7_change_key p8_validate_shard p9_replicable
x1_to_boolean x2_to_long x3_to_double x4_to_string x5_to_bytes x6_to_timestamp x7_to_date x8_to_numeric x8_wide_numeric x9_presence
a1_shard_mod a2_shard_column a3_shard_image a4_shard_constant a6_image_deletes a6_stored_versions a7_shard_udf
j1_map_tables j3_shadow_filter j4_asof_lookup j5_tables_without_shadow j6_seen_ids j8_kafka_partition
g1_latest_per_key g1_latest_reference_mode g1_repeated_keys g2_release_lag g3_batch_lag g4_record_counts g5_lag_distribution g5_lag_meter g6_latency_meter
g7_min_file_start g8_advance_progress g9_statement_batches o1_shard_order o3_partition_numbers o4_first_pull
f_dml_mysql_typed f_dml_postgres_typed f1_exact_numbers f7_escape_backslash f12_mysql_events f13_postgres_events f14_pk_only
f17_connection_urls f18_apply_row f18_apply_column f18_stored_target
w1_release_all w2_release_latest w8_window_start w9_guard_twin w10_redistribute w11_dedup_ids
k1_kafka_frame k2_ordered_topic k2_topic_messages s3_capped_pull k5_shadow_upsert k7_metadata k8_progress_init k9_seen_insert k10_skip_rows
k11_dead_letters k12_windowed_export
q1_direct_replication q1_reference_mode q2_shadow_replication q2_dead_letters q3_stream_to_buffer q4_buffer_to_database
q5_windowed_export q6_table_apply
""".split()

REGISTRY = {name: globals()[name] for name in _NAMES}
