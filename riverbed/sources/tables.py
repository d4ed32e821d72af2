"""Change streams derived from warehouse tables.

There is no live change stream in the test environment, so these functions turn the
driver's tables into change records with a fixed rule (same rule as the DuckDB oracle
text in ``riverbed.plans.oracle``). Every row of the input becomes one change, so the
work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.session import ensure_utc


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _num_text(c: Column) -> Column:
    return c.cast("string")


def event_changes(events: DataFrame) -> DataFrame:
    """One change record (one mod) per event.

    commit time = the event's hour (ties on purpose, so txn id and sequence decide order);
    four events form one transaction; click/view change table ``activity``, signup/purchase
    change ``account``, errors are DELETEs of ``account`` or, for every seventh event id,
    of a table the session does not know (``unmapped``). Tag ``txBy=fwd`` marks every tenth
    event as a loop-back write, and every event id ending in 1 has no tag at all.
    """
    eid = F.col("event_id")
    etype = F.col("event_type")
    commit = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    table = (F.when(etype.isin("click", "view"), F.lit("activity"))
             .when((etype == "error") & (eid % 7 == 0), F.lit("unmapped"))
             .otherwise(F.lit("account")))
    mod_type = (F.when(etype == "signup", F.lit("INSERT"))
                .when(etype == "error", F.lit("DELETE"))
                .otherwise(F.lit("UPDATE")))
    tag = (F.when(eid % 10 == 0, F.lit("txBy=fwd"))
           .when(eid % 10 == 1, F.lit(None).cast("string"))
           .otherwise(F.lit("")))
    keys_json = F.concat(F.lit('{"UserId":"'), F.col("user_id").cast("string"), F.lit('"}'))
    new_values = F.when(etype == "error", F.lit("{}")).otherwise(
        F.concat(F.lit('{"value":'), _num_text(F.col("value")), F.lit(',"props":'), F.col("props"),
                 F.lit(',"shard_id":"shard'), (F.col("user_id") % 4).cast("string"), F.lit('"}')))
    mod = F.struct(keys_json.alias("keys_json"), F.lit("{}").alias("old_values_json"),
                   new_values.alias("new_values_json"))
    return events.select(
        F.concat(F.lit("p"), (eid % 8).cast("string")).alias("partition_token"),
        commit.alias("commit_ts"),
        F.unix_seconds(commit).alias("commit_seconds"),
        ((F.unix_micros(commit) % 1_000_000) * 1000).cast("int").alias("commit_nanos"),
        F.lpad(F.floor(eid / 4).cast("string"), 12, "0").alias("server_txn_id"),
        (eid % 4 == 3).alias("is_last_in_txn"),
        F.lpad((eid % 4).cast("string"), 8, "0").alias("record_sequence"),
        table.alias("table_name"),
        F.array(mod).alias("mods"),
        mod_type.alias("mod_type"),
        F.lit("NEW_ROW").alias("value_capture_type"),
        F.lit(4).cast("bigint").alias("num_records_in_txn"),
        F.lit(1).cast("bigint").alias("num_partitions_in_txn"),
        tag.alias("txn_tag"),
        F.lit(False).alias("is_system_txn"),
    )


def order_records(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One multi-mod change record per order: the order's line items are its mods.

    Line items per order are bounded (an order has a handful of lines), so the per-order
    collect is a bounded group; the line-item side is pre-aggregated before the join.
    """
    mods = (lineitem
            .select("l_orderkey", F.struct(
                F.concat(F.lit('{"l_orderkey":"'), F.col("l_orderkey").cast("string"),
                         F.lit('","l_linenumber":"'), F.col("l_linenumber").cast("string"),
                         F.lit('"}')).alias("keys_json"),
                F.lit("{}").alias("old_values_json"),
                F.concat(F.lit('{"l_quantity":'), _num_text(F.col("l_quantity")),
                         F.lit(',"l_returnflag":"'), F.col("l_returnflag"), F.lit('"}')
                         ).alias("new_values_json"),
                F.col("l_linenumber").alias("_ln")).alias("m"))
            .groupBy("l_orderkey")
            .agg(F.array_sort(F.collect_list("m")).alias("ms")))
    mods = mods.select("l_orderkey", F.transform("ms", lambda m: m.dropFields("_ln")).alias("mods"))
    commit = F.col("o_orderdate").cast("timestamp")
    okey = F.col("o_orderkey")
    return (orders.join(mods, orders.o_orderkey == mods.l_orderkey, "inner")
            .select(
                F.lit("p0").alias("partition_token"),
                commit.alias("commit_ts"),
                F.unix_seconds(commit).alias("commit_seconds"),
                F.lit(0).alias("commit_nanos"),
                F.lpad(okey.cast("string"), 12, "0").alias("server_txn_id"),
                F.lit(True).alias("is_last_in_txn"),
                F.lit("00000000").alias("record_sequence"),
                F.lit("lineitem").alias("table_name"),
                F.col("mods"),
                F.when(F.col("o_orderstatus") == "F", F.lit("UPDATE")).otherwise(F.lit("INSERT")).alias("mod_type"),
                F.lit("NEW_ROW").alias("value_capture_type"),
                F.size("mods").cast("bigint").alias("num_records_in_txn"),
                F.lit(1).cast("bigint").alias("num_partitions_in_txn"),
                F.when(okey % 5 == 0, F.lit("txBy=rev")).otherwise(F.lit("")).alias("txn_tag"),
                F.lit(False).alias("is_system_txn")))


def accounts_target(customer: DataFrame) -> DataFrame:
    """Target table for change application: source table ``accounts`` from ``customer``."""
    return customer.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_acctbal").alias("balance"),
        F.lit(None).cast("string").alias("attrs"),
        F.col("c_mktsegment").alias("note"))


def account_shadow(customer: DataFrame) -> DataFrame:
    """Shadow rows (last applied commit per key) for table ``account`` from ``customer``."""
    ts = F.timestamp_seconds(F.lit(1704067200) + (F.col("c_custkey") % 30) * 86400
                             + F.col("c_nationkey") * 3600)
    return customer.select(F.lit("account").alias("table_name"),
                           F.col("c_custkey").alias("UserId"),
                           ts.alias("processed_commit_ts"))


def supplier_shards(supplier: DataFrame) -> DataFrame:
    """Shard list (shard-file layout) from ``supplier``; passwords never leave this frame."""
    return supplier.select(
        F.concat(F.lit("shard"), F.lpad(F.col("s_suppkey").cast("string"), 5, "0")).alias("logicalShardId"),
        F.concat(F.lit("db-"), F.col("s_nationkey").cast("string"), F.lit(".internal")).alias("host"),
        F.when(F.col("s_nationkey") % 2 == 0, F.lit("3306")).otherwise(F.lit("5432")).alias("port"),
        F.lit("replicator").alias("user"),
        F.lit("secret").alias("password"),
        F.concat(F.lit("db"), F.col("s_nationkey").cast("string")).alias("dbName"))


# ---------------------------------------------------------------------------------------
# Session (schema mapping) for the derived streams. Fixed configuration, same for every
# scale factor; stated in the session-file layout so that the loader is exercised.
# Stream table ``account``   -> source ``accounts``    (renamed columns, one source-only column)
# Stream table ``activity``  -> source ``activity_log`` (one stream-only column)
# Stream table ``lineitem``  -> source ``order_lines``  (two-column primary key)
# ---------------------------------------------------------------------------------------

def _sp_col(cid, name, typ, is_array=False):
    return cid, {"Name": name, "T": {"Name": typ, "Len": 0, "IsArray": is_array}, "NotNull": False, "Id": cid}


def _src_col(cid, name, typ):
    return cid, {"Name": name, "Type": {"Name": typ, "Mods": None}, "NotNull": False, "Id": cid}


def _pks(*cids):
    return [{"ColId": c, "Desc": False, "Order": i + 1} for i, c in enumerate(cids)]


EVENTS_SESSION = {
    "SpSchema": {
        "t1": {"Name": "account", "ColIds": ["c1", "c2", "c3", "c4"], "ShardIdColumn": "c4",
               "ColDefs": dict([_sp_col("c1", "UserId", "INT64"), _sp_col("c2", "value", "FLOAT64"),
                                _sp_col("c3", "props", "JSON"), _sp_col("c4", "shard_id", "STRING")]),
               "PrimaryKeys": _pks("c1")},
        "t2": {"Name": "activity", "ColIds": ["c5", "c6", "c7", "c8"], "ShardIdColumn": "c8",
               "ColDefs": dict([_sp_col("c5", "UserId", "INT64"), _sp_col("c6", "value", "FLOAT64"),
                                _sp_col("c7", "props", "JSON"), _sp_col("c8", "shard_id", "STRING")]),
               "PrimaryKeys": _pks("c5")},
        "t3": {"Name": "lineitem", "ColIds": ["c10", "c11", "c12", "c13"], "ShardIdColumn": "",
               "ColDefs": dict([_sp_col("c10", "l_orderkey", "INT64"), _sp_col("c11", "l_linenumber", "INT64"),
                                _sp_col("c12", "l_quantity", "FLOAT64"), _sp_col("c13", "l_returnflag", "STRING")]),
               "PrimaryKeys": _pks("c10", "c11")},
    },
    "SrcSchema": {
        "t1": {"Name": "accounts", "ColIds": ["c1", "c2", "c3", "c9"],
               "ColDefs": dict([_src_col("c1", "user_id", "bigint"), _src_col("c2", "balance", "double"),
                                _src_col("c3", "attrs", "json"), _src_col("c9", "note", "varchar")]),
               "PrimaryKeys": _pks("c1")},
        "t2": {"Name": "activity_log", "ColIds": ["c5", "c6", "c7"],
               "ColDefs": dict([_src_col("c5", "user_id", "int"), _src_col("c6", "amount", "decimal"),
                                _src_col("c7", "props", "text")]),
               "PrimaryKeys": _pks("c5")},
        "t3": {"Name": "order_lines", "ColIds": ["c10", "c11", "c12", "c13"],
               "ColDefs": dict([_src_col("c10", "orderkey", "bigint"), _src_col("c11", "linenumber", "int"),
                                _src_col("c12", "quantity", "double"), _src_col("c13", "returnflag", "char")]),
               "PrimaryKeys": _pks("c10", "c11")},
    },
}


def typed_changes(events: DataFrame) -> DataFrame:
    """Change records of table ``typed`` whose payload holds one field of every stream
    type family (for typed extraction and value rendering). One record per event."""
    eid = F.col("event_id")
    et = F.col("event_type")
    ts_text = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    payload = F.concat(
        F.lit('{"f":'), _num_text(F.col("value")),
        F.lit(',"b":'), F.when(F.col("value") > 100, F.lit("true")).otherwise(F.lit("false")),
        F.lit(',"s":"'), et,
        F.lit('","arr":["'), et, F.lit('","k'), (F.col("user_id") % 3).cast("string"),
        F.lit('"],"hx":"'), F.lower(F.hex(et)),
        F.lit('","by":"'), F.base64(et.cast("binary")),
        F.lit('","t":"'), ts_text,
        F.lit('","d":"'), F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd"),
        F.lit('","j":'), F.col("props"),
        F.lit(',"q":"it\'s '), et,
        F.lit('","nul":null,"n":"'), _num_text(F.col("value")),
        F.lit('"}'))
    keys = F.concat(F.lit('{"id":"'), eid.cast("string"), F.lit('"}'))
    commit = F.col("ts").cast("timestamp")
    return events.select(
        commit.alias("commit_ts"),
        F.unix_seconds(commit).alias("commit_seconds"),
        ((F.unix_micros(commit) % 1_000_000) * 1000).cast("int").alias("commit_nanos"),
        F.lpad(eid.cast("string"), 12, "0").alias("server_txn_id"),
        F.lit("00000000").alias("record_sequence"),
        F.lit("typed").alias("table_name"),
        keys.alias("keys_json"),
        F.lit("{}").alias("old_values_json"),
        payload.alias("new_values_json"),
        F.when(et == "error", F.lit("DELETE")).when(et == "signup", F.lit("INSERT"))
         .otherwise(F.lit("UPDATE")).alias("mod_type"),
        F.lit(1).cast("bigint").alias("num_records_in_txn"),
        F.lit("").alias("txn_tag"))


def wide_numbers(events: DataFrame) -> DataFrame:
    """Payloads with a number of 67 digits per event, in ``j``: 55 before the point (all nines for every 35th event), 12 behind it
    (for every fifth, nines and a half), a sign for odd ids, and an exponent of 3 for every third."""
    eid = F.col("event_id")
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    whole = F.when(eid % 35 == 0, F.repeat(F.lit("9"), F.lit(55))).otherwise(
        F.concat(F.lit("7"), pad(eid, 18), pad(F.col("user_id"), 18), pad(eid, 18)))
    part = F.when(eid % 5 == 0, F.lit("999999999500")).otherwise(F.concat(pad(F.col("user_id") % 1_000_000_000, 9), pad(eid % 1000, 3)))
    number = F.concat(F.when(eid % 2 == 1, F.lit("-")).otherwise(""), whole, F.lit("."), part, F.when(eid % 3 == 0, F.lit("E3")).otherwise(""))
    return events.select("event_id", F.concat(F.lit('{"n":'), number, F.lit(',"s":"'), number, F.lit('"}')).alias("j"))


TYPED_SESSION = {
    "SpSchema": {
        "t9": {"Name": "typed", "ColIds": [f"c{i}" for i in range(20, 33)], "ShardIdColumn": "",
               "ColDefs": dict([
                   _sp_col("c20", "id", "INT64"), _sp_col("c21", "f", "FLOAT64"), _sp_col("c22", "b", "BOOL"),
                   _sp_col("c23", "s", "STRING"), _sp_col("c24", "arr", "STRING", True),
                   _sp_col("c25", "hx", "STRING"), _sp_col("c26", "by", "BYTES"),
                   _sp_col("c27", "t", "TIMESTAMP"), _sp_col("c28", "d", "DATE"), _sp_col("c29", "j", "JSON"),
                   _sp_col("c30", "q", "STRING"), _sp_col("c31", "nul", "STRING"), _sp_col("c32", "n", "NUMERIC")]),
               "PrimaryKeys": _pks("c20")},
    },
    "SrcSchema": {
        "t9": {"Name": "typed_src", "ColIds": [f"c{i}" for i in range(20, 33)],
               "ColDefs": dict([
                   _src_col("c20", "id", "int"), _src_col("c21", "f", "double"), _src_col("c22", "b", "tinyint"),
                   _src_col("c23", "s", "enum"), _src_col("c24", "arr", "set"), _src_col("c25", "hx", "binary"),
                   _src_col("c26", "by", "blob"), _src_col("c27", "t", "datetime"), _src_col("c28", "d", "date"),
                   _src_col("c29", "j", "json"), _src_col("c30", "q", "varchar"), _src_col("c31", "nul", "varchar"),
                   _src_col("c32", "n", "decimal")]),
               "PrimaryKeys": _pks("c20")},
    },
}
