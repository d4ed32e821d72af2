"""Streaming operators and jobs: the release buffer against its batch twin, order across batches, late rows,
and for every job that what goes in comes out: input = written + superseded + held + skipped + dead letters, with a
stop and a restart in the middle and with writes that fail.

Input files are landed in commit (or arrival) order, one file per chunk; a marker row far in the future lets
the last interval go."""

import glob
import json
import os
import sqlite3

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riverbed.operators import sharding as S
from riverbed.operators import transforms as T
from riverbed.operators.latest import latest_per_key
from riverbed.sources import tables as TB
from riverbed.sources.changes import read_changes
from riverbed.sources.config import session_from_dict
from riverbed.streaming import jobs as J
from riverbed.streaming.ordered import ReleaseBuffer, in_order, release_batch
from tests.conftest import SF_SMALL

IDS = ["server_txn_id", "record_sequence"]
START = "2000-01-01 00:00:00"


def land(spark, folder, order=(1, 2, 3, 4, 5), marker=True):
    """The events' change records in five files by commit time, written in the given order."""
    recs = TB.event_changes(TB.load(spark, SF_SMALL, "events"))
    parts = recs.withColumn("_c", F.ntile(5).over(Window.orderBy("commit_ts", *IDS))).cache()
    for i in order:
        parts.where(F.col("_c") == i).drop("_c").coalesce(1).write.mode("append").parquet(folder)
    if marker:
        (recs.limit(1).withColumn("commit_ts", F.lit("2031-01-01").cast("timestamp")).withColumn("commit_seconds", F.unix_seconds("commit_ts"))
         .withColumn("txn_tag", F.lit("")).withColumn("table_name", F.lit("__marker__")).coalesce(1).write.mode("append").parquet(folder))
    parts.unpersist()
    return recs


def scan(spark, folder):
    return read_changes(spark, folder, start=START, streaming=True, max_files_per_trigger=1)


def ids(df):
    return sorted(tuple(r) for r in df.select(*IDS).collect())


def released(spark, tmp, order, interval, emit, shards=4):
    """(changes, [rows of each batch in the order in which they went out])."""
    folder = os.path.join(tmp, "in")
    recs = land(spark, folder, order)
    ch = S.shard_by_mod(T.explode_mods(T.filter_changes(scan(spark, folder))), "UserId", shards)
    buffer = ReleaseBuffer(spark, os.path.join(tmp, "buffer"), interval, emit)
    out = []

    def handle(batch, batch_id):
        out.append([r.asDict() for r in in_order(buffer.step(batch, batch_id)).collect() if r["table_name"] != "__marker__"])

    J.start(ch, handle, "release-test", available_now=True, checkpoint=os.path.join(tmp, "ck")).awaitTermination(600)
    return S.shard_by_mod(T.explode_mods(T.filter_changes(recs)), "UserId", shards), out


def place(r):
    return (r["commit_seconds"], r["commit_nanos"], r["server_txn_id"], r["record_sequence"])


def test_release_all_in_order_across_batches(spark, tmpdir_path):
    changes, batches = released(spark, tmpdir_path, (1, 2, 3, 4, 5), "2 hours", "all")
    assert len(batches) == 6
    for shard in range(4):
        mine = [place(r) for b in batches for r in b if r["shard"] == str(shard)]
        assert mine == sorted(mine) and mine
    rows = [r for b in batches for r in b]
    assert sorted((r["server_txn_id"], r["record_sequence"]) for r in rows) == ids(release_batch(changes))
    for r in rows:  # the interval's end, counted from the epoch
        assert r["released_at_ms"] % 7_200_000 == 0 and 0 < r["released_at_ms"] - r["commit_seconds"] * 1000 <= 7_200_000


def test_release_latest_equals_the_twin(spark, tmpdir_path):
    changes, batches = released(spark, tmpdir_path, (1, 2, 3, 4, 5), "1 day", "latest", shards=500)
    got = sorted((r["shard"], r["released_at_ms"], r["table_name"], r["keys_json"], *place(r)) for b in batches for r in b)
    twin = release_batch(changes, "latest", "1 day").collect()
    assert got == sorted((r["shard"], r["released_at_ms"], r["table_name"], r["keys_json"], *place(r)) for r in twin)


def test_late_rows_are_released_not_dropped(spark, tmpdir_path):
    changes, batches = released(spark, tmpdir_path, (1, 2, 4, 5, 3), "2 hours", "all")
    rows = sorted((r["server_txn_id"], r["record_sequence"]) for b in batches for r in b)
    assert rows == ids(release_batch(changes))
    assert len(batches[4]) > 0  # the late file goes out with the batch that brings it


class Databases:
    """A sqlite file per shard; ``broken`` shards have no tables, so that every write there fails."""

    def __init__(self, folder, broken=()):
        self.folder, self.broken = folder, broken
        os.makedirs(folder)

    def __call__(self, shard):
        c = sqlite3.connect(os.path.join(self.folder, f"{shard}.db"), timeout=30)
        if shard in self.broken:
            raise ValueError(f"no database for {shard}")
        c.execute("CREATE TABLE IF NOT EXISTS accounts (user_id INTEGER PRIMARY KEY, balance REAL, attrs TEXT, note TEXT)")
        c.execute("CREATE TABLE IF NOT EXISTS activity_log (user_id INTEGER PRIMARY KEY, amount REAL, props TEXT)")
        return c

    def rows(self, table, value):
        out = {}
        for f in glob.glob(self.folder + "/*.db"):
            with sqlite3.connect(f) as c:
                if c.execute("SELECT count(*) FROM sqlite_master WHERE name = ?", (table,)).fetchone()[0]:
                    out.update({(os.path.basename(f)[:-3], u): round(v, 6) for u, v in c.execute(f"SELECT user_id, {value} FROM {table}")})
        return out


def dead(spark, path):
    """Dead letters: (txn id, sequence) -> error."""
    if not glob.glob(path + "/*"):
        return {}
    out = {}
    for r in spark.read.json(path).collect():
        rec = json.loads(r["record"])
        out[rec["server_txn_id"], rec["record_sequence"]] = r["error"]
    return out


def run(job, *args, **options):
    q = job(*args, available_now=True, **options)
    q.awaitTermination(900)
    assert q.exception() is None


def expected_tables(changes):
    """What the databases must hold after the latest change of every row: (shard, user) -> value, by table."""
    out = {"account": {}, "activity": {}}
    for r in latest_per_key(changes, ["shard", "table_name", "keys_json"]).collect():
        if r["table_name"] in out and r["mod_type"] != "DELETE":
            out[r["table_name"]][r["shard"], int(json.loads(r["keys_json"])["UserId"])] = round(json.loads(r["new_values_json"])["value"], 6)
    return out


def test_direct_replication_restart_and_account_of_all_changes(spark, tmpdir_path):
    """Q1: stopped after two files and started again. Every change is written, superseded or a dead letter."""
    folder, dlq = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "dlq")
    tm, cm = session_from_dict(spark, TB.EVENTS_SESSION)
    db = Databases(os.path.join(tmpdir_path, "db"))
    options = dict(interval="6 hours", shard_count=3, dialect="postgresql", dead_letter_path=dlq, checkpoint=os.path.join(tmpdir_path, "ck"))
    recs = land(spark, folder, (1, 2), marker=False)
    run(J.direct_replication_stream, spark, scan(spark, folder), tm, cm, db, **options)
    land(spark, folder, (3, 4, 5))
    run(J.direct_replication_stream, spark, scan(spark, folder), tm, cm, db, **options)
    ch = S.shard_by_mod(T.explode_mods(T.filter_changes(recs)), "UserId", 3)
    want = expected_tables(ch)
    assert db.rows("accounts", "balance") == want["account"] and db.rows("activity_log", "amount") == want["activity"]
    # the latest of each interval that has no statement, and nothing else
    unmapped = release_batch(ch.where("table_name = 'unmapped'"), "latest", "6 hours")
    lost = {k: v for k, v in dead(spark, dlq).items() if "__marker__" not in v}
    assert {k for k, v in lost.items() if v == "table not in session"} >= set(ids(unmapped)) and set(lost.values()) == {"table not in session"}


def test_failed_shard_stops_and_loses_nothing(spark, tmpdir_path):
    """The statements of the batch in which a shard fails, and all later ones, are dead letters."""
    folder, dlq = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "dlq")
    recs = land(spark, folder)
    tm, cm = session_from_dict(spark, TB.EVENTS_SESSION)
    db = Databases(os.path.join(tmpdir_path, "db"), broken=("0",))
    run(J.direct_replication_stream, spark, scan(spark, folder), tm, cm, db, interval="6 hours", shard_count=2, dialect="postgresql",
        dead_letter_path=dlq, checkpoint=os.path.join(tmpdir_path, "ck"))
    ch = S.shard_by_mod(T.explode_mods(T.filter_changes(recs)), "UserId", 2)
    due = release_batch(ch, "latest", "6 hours")
    got = dead(spark, dlq)
    mine = set(ids(due.where("shard = '0' AND table_name <> 'unmapped'")))
    assert {k for k, v in got.items() if "no database" in v or "stopped" in v} == mine
    want = expected_tables(ch.where("shard = '1'"))
    assert db.rows("accounts", "balance") == want["account"]


def test_failed_write_without_dead_letters_fails_the_batch(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "in")
    land(spark, folder, (1, 2))
    tm, cm = session_from_dict(spark, TB.EVENTS_SESSION)
    q = J.direct_replication_stream(spark, scan(spark, folder), tm, cm, Databases(os.path.join(tmpdir_path, "db"), broken=("0",)), interval="6 hours", shard_count=2,
                                    dialect="postgresql", available_now=True, checkpoint=os.path.join(tmpdir_path, "ck"))
    with pytest.raises(Exception, match="dead-letter"):
        q.awaitTermination(600)


def test_windowed_export_stream_accounts_for_all_changes(spark, tmpdir_path):
    """Q5: every change is in a file (deletes by their row's version) or a dead letter."""
    folder, out, dlq = (os.path.join(tmpdir_path, x) for x in ("in", "files", "dlq"))
    recs = land(spark, folder, marker=False)
    tm, _ = session_from_dict(spark, TB.EVENTS_SESSION)
    run(J.windowed_export_stream, spark, scan(spark, folder), tm, out, size="1h", dead_letter_path=dlq, checkpoint=os.path.join(tmpdir_path, "ck"))
    files = spark.read.json(out)
    got = {(r["t"], r["s"]): r["shard"] for r in files.select(F.get_json_object("record", "$.serverTransactionId").alias("t"), F.get_json_object("record", "$.recordSequence").alias("s"), "shard").collect()}
    lost = dead(spark, dlq)
    want = {(r["server_txn_id"], r["record_sequence"]): (r["shard"], r["shard_error"]) for r in S.shard_by_image(T.explode_mods(T.filter_changes(recs)), tm).collect()}
    assert set(got) | set(lost) == set(want) and not set(got) & set(lost)
    assert {k: v for k, (v, e) in want.items() if e is None} == got


def test_stream_to_buffer_equals_the_batch_job(spark, tmpdir_path):
    """Q3: the same messages in the same order per shard as the batch job, deletes included."""
    folder, out, dlq = (os.path.join(tmpdir_path, x) for x in ("in", "messages", "dlq"))
    recs = land(spark, folder)
    tm, _ = session_from_dict(spark, TB.EVENTS_SESSION)
    run(J.stream_to_buffer_stream, spark, scan(spark, folder), tm, out, interval="2 hours", dead_letter_path=dlq, checkpoint=os.path.join(tmpdir_path, "ck"))
    from riverbed.plans.jobs import stream_to_buffer_batch
    shards = spark.createDataFrame([(f"shard{i}",) for i in range(4)], "logicalShardId string")
    batch, lost = stream_to_buffer_batch(recs, tm, "t", shards)
    want = {}
    for r in batch.orderBy("key", "position").collect():
        want.setdefault(r["key"], []).append(r["value"].replace("\n", ""))
    got = {}
    for folder_ in sorted(glob.glob(out + "/batch=*/shard=*")):
        for f in sorted(glob.glob(folder_ + "/*.json")):
            with open(f) as lines:
                got.setdefault(folder_.rpartition("=")[2], []).extend(json.loads(x)["value"] for x in lines)
    norm = lambda d: {k: [json.loads(x) for x in v] for k, v in d.items()}
    assert norm(got) == norm(want)
    marker = {tuple(r) for r in spark.read.parquet(folder).where("table_name = '__marker__'").select(*IDS).collect()}
    assert set(dead(spark, dlq)) - marker == set(ids(lost)) - marker


def test_stream_to_topic_and_from_it(spark, tmpdir_path):
    """Q3 into an ordered topic and Q4 from a subscription to it: positions are the batch job's, a pull is capped, every message arrives in order."""
    from riverbed.plans.jobs import stream_to_buffer_batch
    from riverbed.sinks.topic import buffer_rows, read_topic, subscribe
    folder, out, dlq = (os.path.join(tmpdir_path, x) for x in ("in", "topic", "dlq"))
    recs = land(spark, folder)
    tm, _ = session_from_dict(spark, TB.EVENTS_SESSION)
    run(J.stream_to_buffer_stream, spark, scan(spark, folder), tm, out, interval="2 hours", dead_letter_path=dlq, checkpoint=os.path.join(tmpdir_path, "ck"), topic=True)
    shards = spark.createDataFrame([(f"shard{i}",) for i in range(4)], "logicalShardId string")
    batch, _ = stream_to_buffer_batch(recs, tm, "t", shards)
    want = {(r["key"], r["position"]): json.loads(r["value"]) for r in batch.collect()}
    got = {(r["ordering_key"], r["position"]): json.loads(r["data"]) for r in read_topic(spark, out).collect()}
    assert got == want
    pulled = {}

    def handle(frame, _):
        rows = frame.orderBy("ordering_key", "position").collect()
        for r in rows:
            pulled.setdefault(r["ordering_key"], []).append(r["position"])
        assert max((sum(r["ordering_key"] == k for r in rows) for k in pulled), default=0) <= 150

    messages = subscribe(spark, out, "all", 150)
    assert buffer_rows(messages).columns == ["shard", "value"] and messages.isStreaming
    q = messages.writeStream.option("checkpointLocation", os.path.join(tmpdir_path, "ck2")).trigger(processingTime="0 seconds").foreachBatch(handle).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert {(k, p) for k, ps in pulled.items() for p in ps} == set(want) and all(ps == sorted(ps) for ps in pulled.values())


def test_guard_stream_matches_twin(spark, tmpdir_path):
    from riverbed.streaming.guard import guard_batch, guard_stream
    recs = TB.event_changes(TB.load(spark, SF_SMALL, "events"))
    ch = T.explode_mods(recs).withColumn(
        "arrival", (F.col("server_txn_id").cast("long") * 4 + F.col("record_sequence").cast("long")) % 10 * 1000000
        + F.col("server_txn_id").cast("long") * 4 + F.col("record_sequence").cast("long"))
    folder = os.path.join(tmpdir_path, "arr")
    ch = ch.withColumn("_c", F.floor(F.col("arrival") / 1000000))
    for i in range(10):
        ch.where(F.col("_c") == i).drop("_c").coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(ch.drop("_c").schema).option("maxFilesPerTrigger", 1).parquet(folder)
    cols = ["table_name", "keys_json", "server_txn_id", "record_sequence", "commit_seconds", "commit_nanos", "arrival"]
    schema = ("table_name string, keys_json string, server_txn_id string, record_sequence string, "
              "commit_seconds long, commit_nanos int, arrival long, applied boolean")
    out = guard_stream(stream.select(*cols), ["table_name", "keys_json"], "arrival", schema)
    q = (out.writeStream.format("memory").queryName("guarded").outputMode("append")
         .option("checkpointLocation", os.path.join(tmpdir_path, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(600)
    got = {(r["server_txn_id"], r["record_sequence"]): r["applied"] for r in spark.sql("select * from guarded").collect()}
    kept, skipped = guard_batch(ch.drop("_c"), ["table_name", "keys_json"], "arrival")
    want = {(r["server_txn_id"], r["record_sequence"]): True for r in kept.collect()}
    want.update({(r["server_txn_id"], r["record_sequence"]): False for r in skipped.collect()})
    assert got == want and not all(want.values())


def test_buffer_to_database_stream(spark, tmpdir_path):
    """Q4: buffer messages (files, shard attribute) -> parse (malformed -> dead letters) ->
    statements -> per-shard databases."""
    from riverbed.sinks.messages import buffer_messages
    recs = TB.event_changes(TB.load(spark, SF_SMALL, "events"))
    ch = T.explode_mods(T.filter_changes(recs)).where(F.col("table_name") == "account")
    msgs = buffer_messages(ch.withColumn("shard", F.concat(F.lit("s"), (F.col("commit_seconds") % 2).cast("string"))),
                           pretty=False).select("shard", "value")
    buf = os.path.join(tmpdir_path, "buffer")
    msgs.union(spark.createDataFrame([("s0", "not a message")], "shard string, value string")) \
        .coalesce(2).write.json(buf)
    db = os.path.join(tmpdir_path, "db")
    os.makedirs(db)

    def connect(shard):
        c = sqlite3.connect(os.path.join(db, f"{shard}.db"), timeout=30)
        c.execute("CREATE TABLE IF NOT EXISTS accounts (user_id INTEGER PRIMARY KEY, balance REAL, attrs TEXT, note TEXT)")
        return c

    from riverbed.sources.changes import read_buffer_files
    tm, cm = session_from_dict(spark, TB.EVENTS_SESSION)
    dlq = os.path.join(tmpdir_path, "dlq")
    q = J.buffer_to_database_stream(spark, read_buffer_files(spark, buf), tm, cm, connect, dialect="postgresql",
                                    dead_letter_path=dlq, available_now=True, checkpoint=os.path.join(tmpdir_path, "ck"))
    q.awaitTermination(600)
    assert q.exception() is None
    assert spark.read.json(dlq).count() == 1
    users = set()
    for f in os.listdir(db):
        with sqlite3.connect(os.path.join(db, f)) as c:
            users |= {r[0] for r in c.execute("select user_id from accounts")}
    assert users


def test_shadow_replication_stream_never_goes_back(spark, tmpdir_path):
    """Q2: changes arrive out of commit order, with a restart. A change is applied unless its key has a later
    applied commit from an earlier batch; what isn't applied is a dead letter, a skip, or nothing at all."""
    folder, dlq = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "dlq")
    tm, cm = session_from_dict(spark, TB.EVENTS_SESSION)
    db = Databases(os.path.join(tmpdir_path, "db"))
    options = dict(dialect="postgresql", dead_letter_path=dlq, checkpoint=os.path.join(tmpdir_path, "ck"))
    recs = land(spark, folder, (1, 4), marker=False)
    run(J.shadow_replication_stream, spark, scan(spark, folder), tm, cm, db, **options)
    land(spark, folder, (2, 5, 3), marker=False)
    run(J.shadow_replication_stream, spark, scan(spark, folder), tm, cm, db, **options)
    parts = T.explode_mods(T.filter_changes(recs.withColumn("_c", F.ntile(5).over(Window.orderBy("commit_ts", *IDS)))))
    ch = sorted((r.asDict() for r in parts.collect()), key=lambda r: ((1, 4, 2, 5, 3).index(r["_c"]), *place(r)))
    versions, applied, shown, refused, unsharded, skipped = {}, {}, {}, set(), set(), set()
    for c in (1, 4, 2, 5, 3):
        batch = [r for r in ch if r["_c"] == c]
        before = dict(applied)
        for r in batch:
            me, key = (r["server_txn_id"], r["record_sequence"]), (r["table_name"], r["keys_json"])
            if r["table_name"] == "unmapped":
                skipped.add(me)
                continue
            if r["mod_type"] == "DELETE":
                earlier = [v for v in [*versions.get(key, []), *((place(x), json.loads(x["new_values_json"])["shard_id"]) for x in batch if (x["table_name"], x["keys_json"]) == key and x["mod_type"] != "DELETE")]
                           if v[0][0] <= r["commit_seconds"] - 1]
                if not earlier:
                    unsharded.add(me)
                    continue
                shard = max(earlier)[1]
            else:
                shard = json.loads(r["new_values_json"])["shard_id"]
            if key in before and before[key] > r["commit_seconds"]:
                refused.add(me)
                continue
            applied[key] = max(applied.get(key, 0), r["commit_seconds"])
            row = (r["table_name"], shard, int(json.loads(r["keys_json"])["UserId"]))
            if r["mod_type"] == "DELETE":
                shown.pop(row, None)
            else:
                shown[row] = round(json.loads(r["new_values_json"])["value"], 6)
        for r in batch:
            if r["table_name"] != "unmapped" and r["mod_type"] != "DELETE":
                versions.setdefault((r["table_name"], r["keys_json"]), []).append((place(r), json.loads(r["new_values_json"])["shard_id"]))
    got = dead(spark, dlq)
    assert {k for k, v in got.items() if v.startswith("older")} == refused and refused
    assert {k for k, v in got.items() if v == S.NO_VERSION} == unsharded
    assert set(got) == refused | unsharded
    assert {("account", *k): v for k, v in db.rows("accounts", "balance").items()} | {("activity", *k): v for k, v in db.rows("activity_log", "amount").items()} == shown


def test_progress_metrics(spark, tmpdir_path):
    src_dir = os.path.join(tmpdir_path, "in")
    land(spark, src_dir)
    src = read_changes(spark, src_dir, start="2000-01-01 00:00:00", streaming=True)
    obs = J.with_progress_metrics(src, "changes", shard_col="table_name")
    q = (obs.writeStream.format("noop").option("checkpointLocation", os.path.join(tmpdir_path, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    seen = [p["observedMetrics"]["changes"]["records"] for p in q.recentProgress if p.get("observedMetrics")]
    assert sum(seen) == 1001
    shards = [p["observedMetrics"]["changes"]["shards"] for p in q.recentProgress if p.get("observedMetrics")]
    assert max(shards) == 4
