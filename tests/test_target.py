"""F18 on stored tables: buckets that a batch touches, batches that run twice, readers, and Q6 as a stream."""

import os

import pytest
from pyspark.sql import functions as F

from riverbed.operators.latest import apply_changes
from riverbed.plans.jobs import table_apply_batch
from riverbed.sources import tables as TB
from riverbed.sources.config import session_from_dict
from riverbed.streaming import jobs as J
from riverbed.streaming.target import StoredTarget
from tests.conftest import SF_SMALL
from tests.test_streaming import dead, land, run, scan

CHANGE = "k int, mod_type string, commit_seconds bigint, commit_nanos int, server_txn_id string, record_sequence string, a int, a__present boolean, b string, b__present boolean"


def batch(spark, at, *rows):
    """(key, kind, a, b): a column that is None isn't in the record."""
    return spark.createDataFrame([(k, m, at, i, "x", "0", a, a is not None, b, b is not None) for i, (k, m, a, b) in enumerate(rows)], CHANGE)


def table(df):
    return sorted(tuple(r) for r in df.select("k", "a", "b").collect())


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def stored(spark, path, rows, buckets=8):
    t = StoredTarget(spark, path, "k int, a int, b string", ["k"], buckets)
    t.start(spark.createDataFrame(rows, "k int, a int, b string"))
    return t


def test_batches_give_what_all_changes_at_once_give(spark, tmpdir_path):
    rows = [(i, i, f"t{i}") for i in range(40)]
    t = stored(spark, os.path.join(tmpdir_path, "t"), rows)
    parts = [batch(spark, 1, (1, "UPDATE", 10, None), (2, "DELETE", None, None), (50, "INSERT", 5, "new")),
             batch(spark, 2, (2, "INSERT", 7, None), (1, "UPDATE", None, "late"), (3, "DELETE", None, None)), batch(spark, 3),
             batch(spark, 4, (50, "DELETE", None, None), (3, "INSERT", None, "again"), (3, "UPDATE", 9, None))]
    for i, p in enumerate(parts):
        t.apply(p, i)
    everything = parts[0].unionByName(parts[1]).unionByName(parts[3])
    want = apply_changes(spark.createDataFrame(rows, "k int, a int, b string"), everything, ["k"], ["a", "b"], fold="column")
    assert table(t.read()) == table(want)
    assert (2, 7, None) in table(t.read()) and (3, 9, "again") in table(t.read()) and (1, 10, "late") in table(t.read())


def test_only_touched_buckets_are_written(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    t = stored(spark, path, [(i, i, "x") for i in range(400)])
    before = files(path)
    touched = t.apply(batch(spark, 1, (7, "UPDATE", 1, None)), 0)
    new = set(files(path)) - set(before)
    assert len(touched) == 1 and new and all(f"/bucket={touched[0]}/batch=0/" in f for f in new)
    assert all(files(path)[f] == m for f, m in before.items())
    for i in range(1, 6):   # superseded forms go: at most those of two batches and the one that is being read stay
        t.apply(batch(spark, i + 1, (7, "UPDATE", i, None)), i)
    assert len(os.listdir(f"{path}/bucket={touched[0]}")) <= 3
    assert dict((k, a) for k, a, _ in table(t.read()))[7] == 5 and t.read().count() == 400


def test_a_batch_that_runs_twice_and_one_that_is_not_whole(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    t = stored(spark, path, [(1, 1, "x"), (2, 2, "x")])
    first = batch(spark, 1, (1, "DELETE", None, None), (2, "UPDATE", 5, None))
    t.apply(first, 0)
    once = table(t.read())
    t.apply(first, 0)
    assert table(t.read()) == once == [(2, 5, "x")]
    # a batch whose rows are there without its entry doesn't count, for readers and for its own second run
    t.apply(batch(spark, 2, (2, "UPDATE", 6, None), (3, "INSERT", 1, "n")), 1)
    whole = table(t.read())
    t.forms.delete("v=2")
    assert table(t.read()) == once
    t.apply(batch(spark, 2, (2, "UPDATE", 6, None), (3, "INSERT", 1, "n")), 1)
    assert table(t.read()) == whole == [(2, 6, "x"), (3, 1, "n")]


def test_emptied_and_empty_tables(spark, tmpdir_path):
    t = stored(spark, os.path.join(tmpdir_path, "t"), [(1, 1, "x")])
    t.apply(batch(spark, 1, (1, "DELETE", None, None), (9, "DELETE", None, None)), 0)
    assert table(t.read()) == []
    t.apply(batch(spark, 2, (1, "INSERT", 2, "y")), 1)
    assert table(t.read()) == [(1, 2, "y")]
    none = stored(spark, os.path.join(tmpdir_path, "none"), [])
    none.apply(batch(spark, 1), 0)
    none.apply(batch(spark, 2, (1, "INSERT", 2, "y")), 1)
    assert table(none.read()) == [(1, 2, "y")]
    with pytest.raises(RuntimeError):
        none.apply(batch(spark, 2), 7)


def test_table_apply_stream_equals_the_batch_job(spark, tmpdir_path):
    """Q6, stopped and started again between its files: the tables are those of one run over all changes."""
    folder, out, dlq, ck = (os.path.join(tmpdir_path, x) for x in ("in", "tables", "dlq", "ck"))
    recs = land(spark, folder)
    tm, cm = session_from_dict(spark, TB.EVENTS_SESSION)
    customer = TB.load(spark, SF_SMALL, "customer")
    targets = {"accounts": TB.accounts_target(customer),
               "activity_log": customer.select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("amount"), F.lit(None).cast("string").alias("props"))}
    options = dict(buckets=4, dead_letter_path=dlq, checkpoint=ck)
    run(J.table_apply_stream, spark, scan(spark, folder), tm, cm, targets, out, **options)
    run(J.table_apply_stream, spark, scan(spark, folder), tm, cm, targets, out, **options)
    want = table_apply_batch(recs, tm, cm, targets, fold="column")
    got = J.stored_targets(spark, targets, tm, cm, out, buckets=4)
    for name in targets:
        rows = got[name].read().select(*want[name].columns)
        assert sorted(map(repr, rows.collect())) == sorted(map(repr, want[name].collect()))
    assert set(dead(spark, dlq).values()) == {"table not in session"}
