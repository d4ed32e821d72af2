"""What streaming jobs keep between batches: the event clock, held rows, row versions, the shadow, stopped shards, commit marks and
dead letters. Batches are called by hand where no stream is needed; a batch that runs twice stands for one that
failed before its offsets were committed."""

import glob
import json
import os
import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from riverbed.operators import sharding as S
from riverbed.operators import transforms as T
from riverbed.sinks.database import write_and_report
from riverbed.sinks.files import DeadLetters
from riverbed.sources import tables as TB
from riverbed.sources.config import session_from_dict
from riverbed.streaming import jobs as J
from riverbed.streaming.clock import EventClock
from riverbed.streaming.ordered import BUFFER_SCHEMA, ReleaseBuffer
from riverbed.streaming.versions import KeyedLog, PartitionedLog
from tests.conftest import SF_SMALL
from tests.test_streaming import Databases, dead, expected_tables, ids, land, run, scan

RECORD = "partition_token string, commit_seconds bigint, commit_nanos int"


def records(spark, *rows):
    return spark.createDataFrame([(t, s, 0) for t, s in rows], RECORD)


def clock(spark, path, now, **options):
    return EventClock(spark, path, "10 seconds", now_ms=lambda: now[0] * 1000, **options)


def test_clock_follows_the_slowest_partition_and_leaves_idle_ones_out(spark, tmpdir_path):
    now = [1000]
    path = os.path.join(tmpdir_path, "clock")
    c = clock(spark, path, now, idle="30 seconds")
    assert c.step(records(spark, ("a", 105), ("b", 42)), 0) == (0, 40_000)
    now[0] += 10
    assert c.step(records(spark, ("a", 300)), 1) == (40_000, 40_000)  # b lags: nothing is released early
    now[0] += 10
    assert c.step(records(spark, ("b", 131)), 2) == (40_000, 130_000)
    c = clock(spark, path, now, idle="30 seconds")  # a restart
    now[0] += 25
    assert c.step(records(spark, ("a", 500)), 3) == (130_000, 130_000)
    now[0] += 10  # b has been silent for 35 seconds
    assert c.step(records(spark, ("a", 505)), 4) == (130_000, 500_000)
    now[0] += 999
    assert c.step(records(spark, ("a", 505)), 4) == (130_000, 500_000)  # the batch runs again, much later
    assert c.step(records(spark, ("b", 140), ("a", 700)), 5) == (500_000, 500_000)  # a boundary never goes back
    now[0] += 1
    assert c.step(records(spark), 6) == (500_000, 500_000)
    now[0] += 1
    assert c.step(records(spark, ("b", 777)), 7) == (500_000, 700_000)


def change(shard, seconds, n, position=0):
    return (shard, None, seconds, 0, f"t{n:04d}", "0", position, "account", json.dumps({"UserId": str(n)}), "{}", "{}", "UPDATE", 1, "")


def files(path):
    return {f: os.path.getsize(f) for f in glob.glob(path + "/**/*.parquet", recursive=True)}


def test_held_rows_are_written_once_and_released_with_their_interval(spark, tmpdir_path):
    buffer = ReleaseBuffer(spark, tmpdir_path, "10 seconds", idle="1 hour")
    frame = lambda rows: spark.createDataFrame(rows, BUFFER_SCHEMA)
    got = lambda df: sorted(r["server_txn_id"] for r in df.collect())
    first = [change("s", 95, 1), change("s", 101, 2), change("s", 109, 3), change("s", 131, 4)]
    assert got(buffer.step(frame(first), 0, records(spark, ("a", 131), ("b", 95)))) == []
    before = files(tmpdir_path + "/held")
    assert spark.read.parquet(tmpdir_path + "/held").count() == 4
    # a batch whose rows are all filtered moves the clock and releases what is held; nothing is written again
    out = buffer.step(frame([]), 1, records(spark, ("b", 112)))
    assert got(out) == ["t0001", "t0002", "t0003"] and {r["released_at_ms"] for r in out.collect()} == {100_000, 110_000}
    assert {k: v for k, v in files(tmpdir_path + "/held").items() if k in before} == before and files(tmpdir_path + "/held").keys() == before.keys()
    assert got(buffer.step(frame([]), 1, records(spark, ("b", 112)))) == ["t0001", "t0002", "t0003"]  # again
    # a restart; a late row goes out at once, folders of committed batches are gone
    buffer = ReleaseBuffer(spark, tmpdir_path, "10 seconds", idle="1 hour")
    assert got(buffer.step(frame([change("s", 97, 5), change("s", 133, 6)]), 2, records(spark, ("b", 133)))) == ["t0005"]
    assert got(buffer.rest(2)) == ["t0004", "t0006"]
    assert got(buffer.step(frame([]), 3, records(spark, ("a", 141), ("b", 140)))) == ["t0004", "t0006"]
    assert buffer.rest(3).count() == 0


def test_bytes_written_follow_the_batch_and_not_what_is_held(spark, tmpdir_path):
    buffer = ReleaseBuffer(spark, tmpdir_path, "10 seconds", idle="1 hour")
    size, seen = [], {}
    for b in range(6):  # b never comes: all is held
        rows = [change("s", 1000 + 5 * b, 100 * b + i) for i in range(100)]
        buffer.step(spark.createDataFrame(rows, BUFFER_SCHEMA), b, records(spark, ("a", 1000 + 5 * b), ("b", 10))).count()
        now = files(tmpdir_path + "/held")
        size.append(sum(v for k, v in now.items() if k not in seen))
        seen = now
    assert buffer.rest(5).count() == 600 and max(size) < 1.3 * min(size)


def test_keyed_log_equals_a_dictionary(spark, tmpdir_path):
    """Random batches, some of which run twice; runs are merged, and a batch writes its own keys only."""
    log = KeyedLog(spark, os.path.join(tmpdir_path, "log"), "k string", "v bigint", buckets=3, fold=3)
    r, want = random.Random(1), {f"k{i}": i for i in range(40)}
    log.start(spark.createDataFrame(list(want.items()), "k string, v bigint"), 0)
    for b in range(11):
        rows = [(f"k{r.randrange(60 + 20 * b)}", r.randrange(1000)) for _ in range(30)]
        df = spark.createDataFrame(rows, "k string, v bigint")
        for _ in range(2 if b % 4 == 0 else 1):
            got = {x["k"]: x["v"] for x in log.lookup(df, b).collect()}
            for k, _ in rows:
                assert got.get(k) == want.get(k)
            log.append(df, b)
        written = spark.read.parquet(*glob.glob(log.path + f"/bucket=*/first={b}/last={b}")).count()
        assert written == len({k for k, _ in rows})
        for k, v in rows:
            want[k] = max(v, want.get(k, v))
    assert max(len(log.runs(k, 11)) for k in range(3)) <= 6
    assert {x["k"]: x["v"] for x in log._read([(k, a, b) for k in range(3) for a, b in log.runs(k, 11)]).groupBy("k").agg(F.max("v").alias("v")).collect()} == want


def test_partitioned_log_replaces_a_batch_that_runs_again(spark, tmpdir_path):
    log = PartitionedLog(spark, os.path.join(tmpdir_path, "log"), "x bigint", "day")
    for b, rows in ((0, [(1, 5), (2, 6)]), (1, [(3, 5)]), (1, [(3, 5)])):
        log.append(spark.createDataFrame(rows, "x bigint, day bigint"), b)
    assert log.values() == [5, 6] and sorted(r["x"] for r in log.read([5], 9).collect()) == [1, 3]
    assert [r["x"] for r in log.read([5], 1).collect()] == [1] and log.read([], 9) is None
    log.drop([5])
    assert log.values() == [6]


VERSION = "table_name string, keys_json string, commit_seconds bigint, commit_nanos int, server_txn_id string, record_sequence string, mod_position int, mod_type string, shard string"


@pytest.mark.parametrize("retain", [None, "2 days"])
def test_a_delete_finds_its_version_after_newer_ones(spark, tmpdir_path, retain):
    """Versions of earlier batches: a delete that comes after five newer versions has the shard of a second before its commit."""
    versions = J.RowVersions(spark, os.path.join(tmpdir_path, "v"), None, retain=retain)
    day = 86_400
    at = [100, 200, day + 5, 2 * day, 2 * day + 50, 3 * day, 3 * day + 7, 5 * day]
    for b, seconds in enumerate(at):
        versions.add(spark.createDataFrame([("t", "k", seconds, 0, f"x{b}", "0", 0, "UPDATE", f"s{b}"), ("t", "other", seconds, 0, f"y{b}", "0", 0, "UPDATE", "wrong")], VERSION), b)
    dels = [(2 * day + 60, "s4"), (3 * day + 8, "s6"), (3 * day + 7, "s5"), (6 * day, "s7")]
    early = [(150, "s0"), (200, "s0"), (day, "s1"), (100, None)]
    for seconds, want in dels + early:
        probe = spark.createDataFrame([("t", "k", seconds, 0, "z", "0", 0, "DELETE", None)], VERSION).withColumn("shard_error", F.lit(S.NO_SHARD_COLUMN))
        got = S.fill_delete_shards(probe, stored=versions.upto(seconds - 1, 8)).first()
        if retain and (seconds, want) in early:  # of times before what is kept only the last version is known
            assert got["shard"] is None and got["shard_error"] == S.NO_VERSION
        else:
            assert got["shard"] == want and (got["shard_error"] is None) == (want is not None)
    if retain:
        assert len(versions.log.values()) <= 4 and len(versions.base.values()) <= 2


def q3(spark, tmp, folder, source=None, **options):
    tm, _ = session_from_dict(spark, TB.EVENTS_SESSION)
    run(J.stream_to_buffer_stream, spark, source or scan(spark, folder), tm, os.path.join(tmp, "messages"), dead_letter_path=os.path.join(tmp, "dlq"), checkpoint=os.path.join(tmp, "ck"), **options)


def messages(tmp):
    got = []
    for f in sorted(glob.glob(tmp + "/messages/batch=*/shard=*/*.json")):
        with open(f) as lines:
            got += [json.loads(json.loads(x)["value"]) for x in lines]
    return {(m["serverTransactionId"], m["recordSequence"]) for m in got}


def test_stream_whose_last_batches_are_filtered_or_dead_letters(spark, tmpdir_path):
    """Q3: rows that get no shard, or are loop-back writes, move the clock; a delete in the last file finds the version that was in force."""
    folder = os.path.join(tmpdir_path, "in")
    recs = land(spark, folder, (1, 2, 4, 5), marker=False)
    late = recs.limit(1).withColumn("commit_ts", F.lit("2031-01-01").cast("timestamp")).withColumn("commit_seconds", F.unix_seconds("commit_ts"))
    late.withColumn("table_name", F.lit("__marker__")).withColumn("txn_tag", F.lit("")).coalesce(1).write.mode("append").parquet(folder)
    late.withColumn("txn_tag", F.lit("txBy=fwd")).coalesce(1).write.mode("append").parquet(folder)
    q3(spark, tmpdir_path, folder, interval="2 hours")
    land(spark, folder, (3,), marker=False)  # a file of older commits: late, deletes of rows that have newer versions by now
    q3(spark, tmpdir_path, folder, interval="2 hours")
    tm, _ = session_from_dict(spark, TB.EVENTS_SESSION)
    good, lost = S.split_dropped(S.shard_by_column(T.explode_mods(T.filter_changes(recs)), tm))
    unknown = set(ids(lost))
    letters = {k: v for k, v in dead(spark, os.path.join(tmpdir_path, "dlq")).items()}
    # deletes of the files 4 and 5 whose last version is in file 3 had come before it
    early = set(letters) - unknown - {tuple(r) for r in late.select("server_txn_id", "record_sequence").collect()}
    assert messages(tmpdir_path) == set(ids(good)) - early and set(letters) >= unknown
    assert all(letters[k] == S.NO_VERSION for k in early)


def test_default_start_is_that_of_the_first_start(spark, tmpdir_path):
    """What is committed between two runs is read by the second, what was committed before the first by none."""
    folder = os.path.join(tmpdir_path, "in")
    recs = TB.event_changes(TB.load(spark, SF_SMALL, "events")).where("table_name = 'account' AND mod_type <> 'DELETE' AND coalesce(txn_tag, '') = ''").limit(4).cache()
    put = lambda df, shift: df.withColumn("commit_ts", F.expr(f"current_timestamp() + INTERVAL {shift}")).withColumn("commit_seconds", F.unix_seconds("commit_ts")).coalesce(1).write.mode("append").parquet(folder)
    put(recs, "-1 HOUR")
    source = J.ChangeSource(folder)
    q3(spark, tmpdir_path, folder, source, interval="1 second")
    started = J.start_instant(spark, "stream-to-buffer", os.path.join(tmpdir_path, "ck"))
    put(recs, "0 SECONDS")
    q3(spark, tmpdir_path, folder, source, interval="1 second")
    put(recs.limit(1), "1 HOUR")
    q3(spark, tmpdir_path, folder, source, interval="1 second")
    assert J.start_instant(spark, "stream-to-buffer", os.path.join(tmpdir_path, "ck")) == started
    assert messages(tmpdir_path) == set(ids(recs))


def test_resumed_shard_equals_an_undisturbed_run(spark, tmpdir_path):
    """A shard fails, is repaired and resumed: its dead letters are written in order before its new statements."""
    folder, dlq = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "dlq")
    tm, cm = session_from_dict(spark, TB.EVENTS_SESSION)
    db = Databases(os.path.join(tmpdir_path, "db"), broken=("0",))
    options = dict(interval="6 hours", shard_count=2, dialect="postgresql", dead_letter_path=dlq, checkpoint=os.path.join(tmpdir_path, "ck"))
    recs = land(spark, folder, (1, 2, 3), marker=False)
    run(J.direct_replication_stream, spark, scan(spark, folder), tm, cm, db, **options)
    land(spark, folder, (4,), marker=False)
    run(J.direct_replication_stream, spark, scan(spark, folder), tm, cm, db, resume=("0",), **options)  # not repaired yet
    assert not [k for k in db.rows("accounts", "balance") if k[0] == "0"]
    db.broken = ()
    land(spark, folder, (5,))
    run(J.direct_replication_stream, spark, scan(spark, folder), tm, cm, db, resume=("0",), **options)
    want = expected_tables(S.shard_by_mod(T.explode_mods(T.filter_changes(recs)), "UserId", 2))
    assert db.rows("accounts", "balance") == want["account"] and db.rows("activity_log", "amount") == want["activity"]


def test_a_batch_is_applied_once(spark, tmpdir_path):
    """K3: a batch that runs again, also after a later one, leaves the rows as they are; one that stopped half-way goes on there."""
    def connect(shard):
        c = sqlite3.connect(os.path.join(tmpdir_path, f"{shard}.db"), timeout=30)
        c.execute("CREATE TABLE IF NOT EXISTS log (n INTEGER)")
        return c

    def statements(*ns, bad=()):
        rows = [("s0", "log", f"k{n % 3}", n, 0, "t", "0", 0, "no statement" if n in bad else f"INSERT INTO log VALUES ({n})") for n in ns]
        return spark.createDataFrame(rows, "shard string, table_name string, keys_json string, commit_seconds long, commit_nanos int, server_txn_id string, record_sequence string, mod_position int, dml string")

    def numbers():
        with sqlite3.connect(os.path.join(tmpdir_path, "s0.db")) as c:
            return sorted(r[0] for r in c.execute("SELECT n FROM log"))

    done = lambda df, batch: write_and_report(df, connect, batch_size=4, mark=("it's a job", batch)).where("kind = 'status'").agg(F.sum("statements").alias("n")).first()["n"]
    assert done(statements(*range(20)), 7) == 20
    assert done(statements(*range(20)), 7) == 0 and numbers() == list(range(20))
    assert done(statements(20, 21, 22), 8) == 3
    assert done(statements(*range(20)), 7) == 0 and numbers() == list(range(23))
    ns = (30, 33, 36, 39, 42, 45, 48)  # one key: one writer, in order
    part = write_and_report(statements(*ns, bad=(42,)), connect, batch_size=2, max_retries=0, mark=("it's a job", 9))
    assert sorted(r["commit_seconds"] for r in part.where("kind = 'unwritten'").collect()) == [42, 45, 48]
    assert done(statements(*ns), 9) == 3 and numbers() == [*range(23), *ns]


def test_dead_letters_of_a_batch_that_runs_again_are_not_doubled(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "dlq")
    rows = spark.createDataFrame([("t1", "0", "bad"), ("t2", "0", "worse")], "server_txn_id string, record_sequence string, error string")
    for batch in (0, 1, 1, 2):
        dead_letters = DeadLetters(path)
        dead_letters.put(rows if batch else rows.limit(0), "write")
        dead_letters.put(rows.limit(batch and 1), "render")
        dead_letters.flush(batch)
    assert spark.read.json(path).groupBy("batch", "stage").count().orderBy("batch", "stage").collect() == [(1, "render", 1), (1, "write", 2), (2, "render", 1), (2, "write", 2)]
