"""Statements (F1-F16, P9, G9) against a plain renderer written from the grammar, over the depot's tables:
a two-column key, every kind of column, names that differ between the sides, and payloads with nested
fields of the same name, long decimals, bytes that aren't text and base64 in either alphabet."""

import base64
import json
from dataclasses import replace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riverbed.operators.dml import connection_urls, render_dml, replicable, statement_batches
from riverbed.sources.config import session_from_dict
from tests.fixtures.sessions import COURIERS, STOCK, Column, Table, depot, session

ROW = "table_name string, keys_json string, new_values_json string, mod_type string"
TZ = "-03:00"


def render(spark, doc, rows, dialect, **options):
    tm, cm = session_from_dict(spark, doc)
    got = render_dml(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ROW), tm, cm, dialect, TZ, **options)
    return [(r["dml"], r["drop_reason"]) for r in got.orderBy("i").collect()]


def quoted(text):
    return "'" + text.replace("\0", "").replace("'", "''") + "'"


def plain_value(c: Column, written: str, dialect):
    """``written``: the JSON text of the value."""
    v = json.loads(written, parse_float=str, parse_int=str)
    if v is None:
        return "NULL"
    if c.kind == "BOOL":
        v = "true" if v else "false"
    elif c.kind == "JSON":
        v = written
    elif c.array:
        v = ",".join(v)
    elif c.kind == "BYTES":
        v = base64.b64decode(v.translate(str.maketrans("-_", "+/")) + "==").decode("utf-8", "replace")
    elif c.type == "varbinary":
        try:
            v = bytes.fromhex(v).decode() if len(v) % 2 == 0 else v
        except ValueError:
            pass
        return "X'" + v.replace("'", "''").encode().hex() + "'"
    if c.type in ("datetime", "timestamp"):
        instant = quoted(v[:-1])
        if dialect == "mysql":
            return f" CONVERT_TZ({instant},'+00:00','{TZ}')"
        return f" TO_CHAR((TIMESTAMP {instant} AT TIME ZONE '+00:00' AT TIME ZONE '{TZ}'), 'YYYY-MM-DD HH24:MI:SS')"
    return v if c.type in ("int", "bigint", "decimal", "double", "tinyint") else quoted(v)


def plain_statement(t: Table, keys: dict, new: dict, mod: str, dialect: str) -> str:
    """``keys`` and ``new``: stream column -> JSON text."""
    have = {**new, **keys}
    key = [(c.source, plain_value(c, have[c.stream], dialect)) for k in t.source_key for c in t.columns if c.source == k]
    rest = [(c.source, plain_value(c, have[c.stream], dialect)) for c in t.columns if c.source and c.stream in have and c.source not in t.source_key]
    if mod == "DELETE":
        gap = " " if dialect == "mysql" else ""
        return f"DELETE FROM {t.source} WHERE " + " AND ".join(f"{gap}{n} = {v}" for n, v in key)
    names, values = ",".join(n for n, _ in key + rest), ",".join(v for _, v in key + rest)
    head = f"INSERT INTO {t.source}({names}) VALUES ({values})"
    if not rest:
        return head + (" " if dialect == "mysql" else "")
    if dialect == "mysql":
        return head + " ON DUPLICATE KEY UPDATE " + ",".join(f" {n} = {v}" for n, v in rest)
    return head + f" ON CONFLICT({', '.join(t.source_key)}) DO UPDATE SET" + ",".join(f" {n} = EXCLUDED.{n}" for n, _ in rest)


def as_json(d):
    return "{" + ",".join(f'"{k}":{v}' for k, v in d.items()) + "}"


texts = st.text("ab'\"\\ é中0,:{}", max_size=6)
VALUES = {
    "qty": st.integers(-9, 10**12).map(str),
    "weight": st.sampled_from(["0.1", "123456789.0123456789", "9999999999999999999999999999.123456789", "-2.50", "7"]),
    "temp": st.sampled_from(["21.5", "12.0", "123456789.0123456789", "1.25E3", "-0.00000000012345678901"]),
    "sealed": st.sampled_from(["true", "false"]),
    "labels": st.lists(st.sampled_from(["cold", "top", "old"]), min_size=1, max_size=3).map(json.dumps),
    "digest": st.sampled_from(['"00ff"'[:0] + '"706f7274"', '"xyz"', '"abc"']),
    "photo": st.binary(max_size=9).flatmap(lambda b: st.sampled_from([json.dumps(base64.b64encode(b).decode()), json.dumps(base64.urlsafe_b64encode(b).decode().rstrip("="))])),
    "counted": st.sampled_from(['"2021-11-05T07:08:09Z"', '"2022-02-03T04:05:06.123456789Z"']),
    "due": st.just('"2025-06-30"'),
    "extra": st.sampled_from(['{"qty":1,"temp":"9: 9"}', '{"weight":7}', '[1,2]']),
    "region": texts.map(json.dumps),
    "unmapped": st.just("1"),
}
payload = st.lists(st.sampled_from(sorted(VALUES)), unique=True, max_size=8).flatmap(lambda names: st.fixed_dictionaries({n: st.one_of(VALUES[n], VALUES[n], st.just("null")) for n in names}))
change = st.tuples(st.fixed_dictionaries({"depot": texts.map(json.dumps), "sku": st.integers(0, 99).map(lambda i: f'"{i}"')}), payload, st.sampled_from(["INSERT", "UPDATE", "DELETE"]))


@settings(max_examples=4, deadline=None)
@given(st.lists(change, min_size=20, max_size=40))
def test_statements_follow_the_grammar(spark, changes):
    rows = [("stock", as_json(k), as_json(n), m) for k, n, m in changes]
    for dialect in ("mysql", "postgresql"):
        got = render(spark, depot(), rows, dialect)
        assert got == [(plain_statement(STOCK, k, n, m, dialect), None) for k, n, m in changes]


def test_key_that_the_stream_keeps_among_the_values(spark):
    t = replace(COURIERS, stream_key=("nick",))
    keys, new = {"nick": '"Zoe"'}, {"courier_no": '"31"'}
    for dialect in ("mysql", "postgresql"):
        (got, reason), = render(spark, session(t), [("couriers", as_json(keys), as_json(new), "UPDATE")], dialect)
        assert reason is None and got == plain_statement(t, keys, new, "UPDATE", dialect)


def test_rows_without_a_statement_say_why(spark):
    rows = [("vans", '{"id":"1"}', "{}", "INSERT"), ("stock", '{"depot":"x"}', "{}", "INSERT"), ("couriers", '{"courier_no":"1"}', "{}", "TRUNCATE"),
            ("stock", '{"depot":"x","sku":"1"}', '{"photo":"?"}', "INSERT")]
    assert [r for _, r in render(spark, depot(), rows, "mysql")] == [
        "table not in session", "primary key value not in record", "unsupported mod type", "value can't be decoded"]
    assert render(spark, session(replace(COURIERS, source_key=())), [("couriers", '{"courier_no":"1"}', "{}", "INSERT")], "mysql") == [("", "source table has no primary key")]


def test_backslashes_are_doubled_on_request(spark):
    rows = [("couriers", '{"courier_no":"4"}', json.dumps({"nick": "a\\b'c"}), "INSERT")]
    (plain, _), = render(spark, depot(), rows, "mysql")
    (doubled, _), = render(spark, depot(), rows, "mysql", escape_backslash=True)
    assert "(4,'a\\b''c')" in plain and "(4,'a\\\\b''c')" in doubled


def test_insert_of_a_key_alone_can_be_repeated(spark):
    rows = [("couriers", '{"courier_no":"4"}', "{}", "INSERT")]
    assert render(spark, depot(), rows, "mysql", insert_if_absent=True)[0][0] == "INSERT IGNORE INTO drivers(driver_no) VALUES (4) "
    assert render(spark, depot(), rows, "postgresql", insert_if_absent=True)[0][0] == "INSERT INTO drivers(driver_no) VALUES (4) ON CONFLICT DO NOTHING"


def test_unknown_dialect(spark):
    with pytest.raises(ValueError):
        render(spark, depot(), [("couriers", "{}", "{}", "INSERT")], "sybase")


def test_batches_follow_the_change_order_of_a_shard(spark):
    tm, cm = session_from_dict(spark, depot())
    order = ["commit_seconds", "commit_nanos", "server_txn_id", "record_sequence"]
    rows = [("couriers", '{"courier_no":"%d"}' % i, "{}", "INSERT", f"d{i % 3}", 50 - i, i, "x", "y") for i in range(20)] + [("vans", "{}", "{}", "INSERT", "d0", 0, 0, "x", "y")]
    r = render_dml(spark.createDataFrame(rows, ROW + ", shard string, commit_seconds long, commit_nanos int, server_txn_id string, record_sequence string"), tm, cm)
    good, bad = replicable(r)
    assert good.count() == 20 and bad.count() == 1
    got = {}
    for b in statement_batches(r, order, batch_size=3).collect():
        assert b["n_statements"] == len(b["statements"]) <= 3 and b["first_position"] == b["batch_no"] * 3 + 1
        got.setdefault(b["shard"], []).append((b["batch_no"], b["statements"]))
    for d in range(3):
        joined = [s for _, part in sorted(got[f"d{d}"]) for s in part]
        assert joined == [f"INSERT INTO drivers(driver_no) VALUES ({i}) " for i in sorted((i for i in range(20) if i % 3 == d), reverse=True)]


def test_urls_carry_no_password(spark):
    shards = spark.createDataFrame([("north", "db1", "5432", "app", "hush", "stock")], "logicalShardId string, host string, port string, user string, password string, dbName string")
    for kind in ("mysql", "postgresql"):
        (r,) = connection_urls(shards, kind, tls=True).collect()
        assert "hush" not in str(r) and "db1:5432/stock" in r["jdbc_url"]
    with pytest.raises(ValueError):
        connection_urls(shards, "sybase")


@pytest.mark.parametrize("dialect", ["mysql", "postgresql"])
@pytest.mark.parametrize("absent", [False, True])
def test_both_forms_give_the_same_rows(spark, dialect, absent):
    """A mapping within the bound on columns becomes plain expressions, a larger one is broadcast: same statements, reasons and keys."""
    doc = depot()
    names = [t["Name"] for t in doc["SpSchema"].values()] + ["unknown", None]
    payloads = ["{}", None, "broken", '{"x":1}']
    for t in doc["SpSchema"].values():
        cols = [c["Name"] for c in t["ColDefs"].values()]
        for v in ("null", '"it\'s"', "1.50", '"2024-01-01T00:00:00Z"', "true", '"!"', '["a","b"]', '"6162"'):
            payloads.append("{" + ",".join(f'"{c}":{v}' for c in cols) + "}")
        payloads.append("{" + f'"{cols[0]}":7' + "}")
    rows = [(i, n, k, v, m) for i, (n, k, v, m) in enumerate((n, k, v, m) for n in names for k in payloads for v in payloads[::3] + payloads[:1]
                                                              for m in ("INSERT", "DELETE", "OTHER", None))]
    ch = spark.createDataFrame(rows, "i int, " + ROW)
    tm, cm = session_from_dict(spark, doc)
    one, other = (render_dml(ch, tm, cm, dialect, TZ, insert_if_absent=absent, compiled_columns=n) for n in (400, 0))
    assert one.schema.simpleString() == other.schema.simpleString()
    assert sorted(map(repr, one.collect())) == sorted(map(repr, other.collect()))
    assert one.where("dml <> ''").count() > 20 and one.select("drop_reason").distinct().count() > 3


def test_the_bound_on_compiled_columns(spark):
    """A table counts as its columns and one: at the bound the mapping is read, beyond it is not, and neither is one that names a table twice."""
    from riverbed.operators.mapping import collected_specs, table_specs
    tm, cm = session_from_dict(spark, depot())
    specs = table_specs(tm, cm)
    n = sum(len(r["pk_specs"]) + len(r["col_specs"]) + 1 for r in specs.where("sp_table IS NOT NULL").collect())
    assert collected_specs(specs, n) is not None and collected_specs(specs, n - 1) is None
    assert collected_specs(specs.unionByName(specs), 10 * n) is None
    assert collected_specs(specs.where("false"), n) == []
