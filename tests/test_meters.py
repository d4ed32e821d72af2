"""Live distributions (G5, G6): per batch and shard against the rows themselves, batches that run twice, and in a job."""

import os
import random

from pyspark.sql import functions as F

from riverbed.sources import tables as TB
from riverbed.sources.config import session_from_dict
from riverbed.streaming import jobs as J
from riverbed.streaming.meters import Meter
from tests.test_streaming import Databases, land, run, scan


def lags(spark, seed, n):
    rng = random.Random(seed)
    return [(rng.choice(["a", "a", "b", None]), float(rng.randrange(10_000)) if rng.random() < 0.95 else None) for _ in range(n)]


def put(spark, meter, batch_id, rows):
    meter.put(spark.createDataFrame(rows, "shard string, x double"), batch_id, x=F.col("x"))


def test_report_follows_the_rows(spark, tmpdir_path):
    meter = Meter(spark, os.path.join(tmpdir_path, "m"))
    batches = [lags(spark, i, 3000) for i in range(3)]
    for i, rows in enumerate(batches):
        put(spark, meter, i, rows)
    for chosen in (None, [1], [0, 2]):
        rows = [r for i, b in enumerate(batches) if chosen is None or i in chosen for r in b if r[1] is not None]
        rep = {(r["scope"], r["shard"]): r for r in meter.report(batches=chosen).collect()}
        assert set(rep) == {("all", None), ("shard", None), ("shard", "a"), ("shard", "b")}
        for (scope, shard), r in rep.items():
            mine = sorted(x for s, x in rows if scope == "all" or s == shard)
            assert (r["n"], float(r["sum"]), r["min"], r["max"]) == (len(mine), sum(mine), mine[0], mine[-1])
            for name, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
                assert sum(x < r[name] for x in mine) / len(mine) <= q + 2 * Meter.error and sum(x <= r[name] for x in mine) / len(mine) >= q - 2 * Meter.error


def test_a_batch_that_runs_twice_counts_once(spark, tmpdir_path):
    meter = Meter(spark, os.path.join(tmpdir_path, "m"))
    assert meter.report().count() == 0
    put(spark, meter, 0, [("a", 1.0), ("a", 5.0)])
    put(spark, meter, 1, [("a", 9.0)])
    put(spark, meter, 1, [("a", 9.0)])
    put(spark, meter, 2, [])
    put(spark, meter, 3, [("a", None)])
    r = meter.report((0.5, 0.999)).where("scope = 'all'").first()
    assert (r["n"], r["sum"], r["min"], r["max"], r["p50"], r["p99_9"]) == (3, 15, 1.0, 9.0, 5.0, 9.0)
    assert sorted(r["batch"] for r in meter.read().collect()) == [0, 1]


def test_job_meters_what_it_writes(spark, tmpdir_path):
    """Q1: a shard's count over all batches is the number of its statements."""
    folder = os.path.join(tmpdir_path, "in")
    land(spark, folder)
    tm, cm = session_from_dict(spark, TB.EVENTS_SESSION)
    meter = Meter(spark, os.path.join(tmpdir_path, "m"))
    seen = []

    class Recorded(Meter):
        def put_lag(self, rows, batch_id, now=None):
            seen.extend((batch_id, r["shard"]) for r in rows.select("shard").collect())
            meter.put_lag(rows, batch_id, "2024-06-01 00:00:00")

    run(J.direct_replication_stream, spark, scan(spark, folder), tm, cm, Databases(os.path.join(tmpdir_path, "db")), interval="6 hours", shard_count=2,
        dialect="postgresql", dead_letter_path=os.path.join(tmpdir_path, "dlq"), checkpoint=os.path.join(tmpdir_path, "ck"), meter=Recorded(spark, meter.path))
    got = {(r["batch"], r["shard"]): r["n"] for r in meter.read().collect()}
    assert got == {k: seen.count(k) for k in set(seen)} and sum(got.values()) > 100
    assert meter.report().where("min <= 0 OR min > p50 OR p50 > max").count() == 0
