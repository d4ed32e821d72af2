"""Filter, explode, buffer messages, shard validity and keys (P1-P9) over records made here: several mods
per record, commit times with nanoseconds, nulls in every place where a record may have one."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riverbed import model, session
from riverbed.operators import transforms as T
from riverbed.operators.latest import latest_per_key
from riverbed.operators.ordering import positions
from riverbed.plans import queries as Q
from riverbed.sinks.messages import buffer_messages


def record(n, tag=None, mods=(), table="stock", seconds=1_700_000_000, nanos=987_654_321):
    import datetime
    at = datetime.datetime.fromtimestamp(seconds, datetime.UTC).replace(tzinfo=None, microsecond=nanos // 1000)
    return ("part", at, seconds, nanos, f"txn{n:03d}", True, f"{n:08d}", table, [(k, "{}", v) for k, v in mods], "UPDATE", "NEW_ROW", len(mods), 1, tag, False)


def frame(spark, *records):
    return spark.createDataFrame(list(records), model.CHANGE_RECORD)


def test_loop_back_records_are_those_whose_tag_begins_with_the_prefix(spark):
    tags = {1: "txBy=", 2: "txby=9", 3: " txBy=9", 4: None, 5: "txBy=depot", 6: "x txBy=", 7: ""}
    df = frame(spark, *[record(n, tag) for n, tag in tags.items()])
    kept = {r["server_txn_id"] for r in T.filter_changes(df).collect()}
    assert kept == {f"txn{n:03d}" for n in (2, 3, 4, 6, 7)}
    assert T.filter_changes(df, "none").count() == len(tags)


def test_mods_keep_their_place_whatever_the_order_of_rows(spark):
    key = '{"depot":"a","sku":"1"}'
    recs = [record(n, mods=[(key, json.dumps({"qty": 10 * n + i})) for i in range(6)]) for n in (1, 2, 3)] + [record(9)]
    ch = T.explode_mods(frame(spark, *recs))
    assert ch.count() == 18
    for seed in (1, 2, 3):
        mixed = ch.orderBy(F.rand(seed)).repartition(5)
        (last,) = latest_per_key(mixed).collect()
        assert json.loads(last["new_values_json"])["qty"] == 35 and last["mod_position"] == 5
        numbered = positions(mixed, model.order_columns(mixed), ["table_name"], num_partitions=3).orderBy("position").collect()
        assert [json.loads(r["new_values_json"])["qty"] for r in numbered] == [10 * n + i for n in (1, 2, 3) for i in range(6)]


def test_dealt_mods_fill_tasks_evenly_however_alike_they_are(spark, tmpdir_path, monkeypatch):
    """``g1_repeated_keys``: 600 orders of four line items, all of one quantity and flag save the first of each."""
    spark.sql("SELECT id AS o_orderkey, 'F' AS o_orderstatus, TIMESTAMP_NTZ'1995-03-01' AS o_orderdate FROM range(600)").write.parquet(f"{tmpdir_path}/orders.parquet")
    spark.sql("SELECT id DIV 4 AS l_orderkey, CAST(id % 4 + 1 AS INT) AS l_linenumber, CAST(if(id % 4 = 0, 9, 5) AS DOUBLE) AS l_quantity, 'N' AS l_returnflag FROM range(2400)").write.parquet(f"{tmpdir_path}/lineitem.parquet")
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    dealt = Q._dealt_mods(spark, tmpdir_path)
    placed = dealt.select("server_txn_id", F.spark_partition_id().alias("task")).collect()
    shares = Counter(r["task"] for r in placed)
    assert sum(shares.values()) == 2400 and max(shares.values()) < 200
    assert len({(r["server_txn_id"], r["task"]) for r in placed}) > 2 * 600  # a record's mods are apart
    got = {(r["keys_json"], r["server_txn_id"], r["mod_position"], r["new_values_json"]) for r in Q.g1_repeated_keys(spark, tmpdir_path).collect()}
    assert got == {(f'{{"l_orderkey":"{i}"}}', f"{i:012d}", 3, '{"l_quantity":5.0,"l_returnflag":"N"}') for i in range(600)}


def test_messages_come_back_as_they_went(spark):
    ch = T.explode_mods(frame(spark, record(1, "nightly", [('{"sku":"7"}', '{"nick":"naïve \\"x\\"","qty":null}')]), record(2, None, [("{}", "{}")], nanos=1)))
    for pretty in (True, False):
        msgs = buffer_messages(ch.withColumn("shard", F.lit("north")), pretty).select("shard", "value")
        back, _ = T.parse_buffer(msgs)
        cols = [c for c in ch.columns if c != "mod_position"] + ["shard"]
        assert sorted(map(str, back.select(*cols).collect())) == sorted(map(str, ch.withColumn("shard", F.lit("north")).select(*cols).collect()))


@pytest.mark.parametrize("missing", ["tableName", "mods", "modType", "commitTimestamp"])
def test_message_without_a_part_is_an_error(spark, missing):
    ch = T.explode_mods(frame(spark, record(1, None, [('{"sku":"7"}', "{}")])))
    whole = buffer_messages(ch.withColumn("shard", F.lit("s"))).first()["value"]
    part = {k: v for k, v in json.loads(whole).items() if k != missing}
    df = spark.createDataFrame([(whole,), (json.dumps(part),), ("[]",), ("{",)], "value string")
    good, bad = T.parse_buffer(df, on_error="dlq")
    assert good.count() == 1 and {r["record"] for r in bad.collect()} == {json.dumps(part), "[]", "{"}
    with pytest.raises(Exception, match="not as expected"):
        T.parse_buffer(df)[0].collect()


def test_shard_ids_that_cannot_be(spark):
    df = spark.createDataFrame([(s,) for s in ("north", "", None, "a/b", "/", " ")], "shard string")
    good, bad = T.validate_shard(df, on_error="dlq")
    assert {r["shard"] for r in good.collect()} == {"north", " "}
    assert bad.count() == 4
    with pytest.raises(Exception, match="shard id"):
        T.validate_shard(df)[0].collect()


def test_image_and_key(spark):
    df = spark.createDataFrame([('{"sku":"5","depot":"k"}', '{"depot":null,"qty":2}'), ('{"depot":"q"}', '{"sku":"8"}'), ("{}", "{}")], "keys_json string, new_values_json string")
    images = [r["row_image"] for r in T.row_image(df).collect()]
    assert images == [{"sku": "5", "depot": None, "qty": "2"}, {"depot": "q", "sku": "8"}, {}]
    keys = T.primary_key(df.limit(2), [("sku", "INT64"), ("depot", "STRING")]).select("pk.*").collect()
    assert [tuple(r) for r in keys] == [(5, "k"), (8, "q")]
    with pytest.raises(Exception, match="sku"):
        T.primary_key(df, [("sku", "INT64")]).collect()
