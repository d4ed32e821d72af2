"""Database writer (K3/K4) against embedded SQLite files (one per shard, no server):
PostgreSQL-dialect upserts run unchanged on SQLite. The written tables must equal the
column-fold application of the same changes (F18)."""

import os
import sqlite3

from pyspark.sql import functions as F

from riverbed import model
from riverbed.functions import values as V
from riverbed.operators import dml as D
from riverbed.operators import transforms as T
from riverbed.operators.latest import apply_changes
from riverbed.sinks.database import shard_summary, write_and_report, write_statements
from riverbed.sources import tables as TB
from riverbed.sources.config import session_from_dict
from tests.conftest import SF_SMALL


def make_connect(folder, flaky_marker=None):
    def connect(shard):
        if flaky_marker and not os.path.exists(flaky_marker):
            open(flaky_marker, "w").close()
            raise sqlite3.OperationalError("simulated connection loss")
        c = sqlite3.connect(os.path.join(folder, f"{shard}.db"), timeout=30)
        c.execute("CREATE TABLE IF NOT EXISTS accounts (user_id INTEGER PRIMARY KEY, balance REAL, attrs TEXT, note TEXT)")
        return c
    return connect


def test_writes_equal_column_fold(spark, tmpdir_path):
    ch = T.explode_mods(T.filter_changes(TB.event_changes(TB.load(spark, SF_SMALL, "events"))))
    ch = ch.where(F.col("table_name") == "account")
    ch = T.with_payloads(ch).withColumn("shard", F.concat(F.lit("s"), (V.to_long(F.col("_k"), "UserId") % 2)
                                                           .cast("string"))).drop("_k", "_n")
    tm, cm = session_from_dict(spark, TB.EVENTS_SESSION)
    r = D.render_dml(ch, tm, cm, "postgresql")
    status = shard_summary(write_statements(r, make_connect(tmpdir_path), writers_per_shard=3)).collect()
    assert all(s["ok"] for s in status) and sum(s["statements"] for s in status) == ch.count()
    got = {}
    for s in ("s0", "s1"):
        with sqlite3.connect(os.path.join(tmpdir_path, f"{s}.db")) as c:
            for uid, bal, attrs, note in c.execute("SELECT user_id, balance, attrs, note FROM accounts"):
                got[uid] = (round(bal, 6), attrs, note)
    n = T.with_payloads(ch)
    typed = n.select(V.to_long(F.col("_k"), "UserId").alias("user_id"), "mod_type", *model.order_columns(n),
                     V.to_double(F.col("_n"), "value").alias("balance"), V.has(F.col("_n"), "value").alias("balance__present"),
                     V.text(F.col("_n"), "props").alias("attrs"), V.has(F.col("_n"), "props").alias("attrs__present"),
                     F.lit(None).cast("string").alias("note"), F.lit(False).alias("note__present"))
    empty = spark.createDataFrame([], "user_id long, balance double, attrs string, note string")
    want = {r["user_id"]: (round(r["balance"], 6), r["attrs"], r["note"])
            for r in apply_changes(empty, typed, ["user_id"], ["balance", "attrs", "note"], fold="column").collect()}
    assert got == want


def test_retry_then_success(spark, tmpdir_path):
    df = spark.createDataFrame([("s0", "accounts", "k", 1, 0, "a", "0",
                                 "INSERT INTO accounts(user_id,balance) VALUES (1,2.0)")],
                               "shard string, table_name string, keys_json string, commit_seconds long, "
                               "commit_nanos int, server_txn_id string, record_sequence string, dml string")
    st = shard_summary(write_statements(df, make_connect(tmpdir_path, os.path.join(tmpdir_path, "flaky")),
                                        backoff_seconds=0.01, writers_per_shard=1)).collect()[0]
    assert st["ok"] and st["retries"] == 1 and st["statements"] == 1


ROWS = ("shard string, table_name string, keys_json string, commit_seconds long, commit_nanos int, server_txn_id string, "
        "record_sequence string, dml string")


def test_non_retryable_error_stops_shard(spark, tmpdir_path):
    """An error that no retry mends: the statement and all that follow in the shard are unwritten, and said so."""
    class NotThere(Exception):
        pass

    class Connection:
        def cursor(self):
            return self

        def execute(self, s):
            if s == "bad":
                raise NotThere(s)

        def commit(self):
            pass

        def close(self):
            pass

    data = [(shard, "x", "k", i, 0, "a", "0", "bad" if (shard, i) == ("s0", 3) else f"ok{i}") for shard in ("s0", "s1") for i in range(6)]
    out = write_and_report(spark.createDataFrame(data, ROWS), lambda shard: Connection(), batch_size=1, writers_per_shard=1)
    status = {r["shard"]: (r["ok"], r["statements"], r["retries"]) for r in shard_summary(out.where("kind = 'status'")).collect()}
    assert status == {"s0": (False, 3, 0), "s1": (True, 6, 0)}
    unwritten = out.where("kind = 'unwritten'").orderBy("commit_seconds").collect()
    assert [(r["shard"], r["dml"]) for r in unwritten] == [("s0", "bad"), ("s0", "ok4"), ("s0", "ok5")] and "NotThere" in unwritten[0]["error"]


def test_connections_follow_the_shards_not_the_tasks(spark, tmpdir_path):
    opened = os.path.join(tmpdir_path, "opened")
    os.makedirs(opened)

    def connect(shard):
        import uuid
        open(os.path.join(opened, f"{shard}-{uuid.uuid4().hex}"), "w").close()
        return sqlite3.connect(":memory:")

    data = [(f"s{i % 5}", "x", f"k{i}", i, 0, "a", "0", "SELECT 1") for i in range(400)]
    status = shard_summary(write_statements(spark.createDataFrame(data, ROWS).repartition(16), connect, writers_per_shard=2)).collect()
    assert sum(s["statements"] for s in status) == 400 and len(os.listdir(opened)) <= 5 * 2


def test_jdbc_append_embedded_derby(spark, tmpdir_path):
    """K3 plain append through Spark's JDBC writer into an in-process Derby database."""
    from riverbed.sinks.database import append_table_jdbc
    url = f"jdbc:derby:memory:rb{abs(hash(tmpdir_path)) % 10**8};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.createDataFrame([(1, "a"), (2, "b")], "user_id int, name string")
    append_table_jdbc(df, url, "ACCOUNTS", props)
    append_table_jdbc(df.where("user_id = 2"), url, "ACCOUNTS", props)
    back = spark.read.jdbc(url, "ACCOUNTS", properties=props)
    assert sorted((r[0], r[1]) for r in back.collect()) == [(1, "a"), (2, "b"), (2, "b")]
