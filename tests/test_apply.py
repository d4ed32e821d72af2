"""Change application (F18) and latest per key (G1) against a Python replay."""

from hypothesis import given, settings, strategies as st

from riverbed.operators.latest import apply_changes, latest_per_key

SCHEMA = ("k int, mod_type string, commit_seconds long, commit_nanos int, server_txn_id string, "
          "record_sequence string, a int, a__present boolean, b string, b__present boolean")

change = st.tuples(st.integers(0, 4), st.sampled_from(["INSERT", "UPDATE", "DELETE"]), st.integers(0, 30),
                   st.integers(0, 99), st.booleans(), st.integers(0, 9), st.booleans())


def replay(target, changes, fold):
    rows = {k: dict(v) for k, v in target.items()}
    ordered = sorted(changes, key=lambda c: (c[2], 0, c[3]))
    if fold == "row":
        last = {}
        for c in ordered:
            last[c[0]] = c
        todo = list(last.values())
    else:
        todo = ordered
    for k, mod, _, _, a_p, a, b_p in todo:
        if mod == "DELETE":
            rows.pop(k, None)
            continue
        row = rows.setdefault(k, {"a": None, "b": None})
        if a_p:
            row["a"] = a
        if b_p:
            row["b"] = f"b{a}"
    return {k: (v["a"], v["b"]) for k, v in rows.items()}


def frames(spark, target, changes):
    t = spark.createDataFrame([(k, v["a"], v["b"]) for k, v in target.items()] or [(-1, None, None)],
                              "k int, a int, b string").where("k >= 0")
    rows = [(k, mod, s, 0, f"{i:06d}", "0", a if a_p else None, a_p, f"b{a}" if b_p else None, b_p)
            for i, (k, mod, s, _, a_p, a, b_p) in enumerate(sorted(changes, key=lambda c: (c[2], c[3])))]
    return t, spark.createDataFrame(rows, SCHEMA)


@settings(max_examples=6, deadline=None)
@given(st.lists(change, min_size=1, max_size=25))
def test_apply_matches_replay(spark, changes):
    # the txn id encodes order inside one commit second, as the sort above makes it
    changes = [(k, m, s, i, ap, a, bp) for i, (k, m, s, _, ap, a, bp) in enumerate(sorted(changes, key=lambda c: (c[2], c[3])))]
    target = {0: {"a": 100, "b": "t0"}, 1: {"a": 101, "b": "t1"}}
    t, ch = frames(spark, target, changes)
    for fold in ("row", "column"):
        got = {r["k"]: (r["a"], r["b"]) for r in apply_changes(t, ch, ["k"], ["a", "b"], fold=fold).collect()}
        assert got == replay(target, changes, fold), fold


def test_latest_per_key(spark):
    rows = [(1, "INSERT", 5, 0, "a", "0", 1, True, None, False), (1, "UPDATE", 5, 0, "a", "1", 2, True, None, False),
            (1, "UPDATE", 4, 9, "z", "9", 3, True, None, False), (2, "DELETE", 1, 0, "a", "0", None, False, None, False)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["k"]: (r["mod_type"], r["a"]) for r in latest_per_key(df, ["k"]).collect()}
    assert got == {1: ("UPDATE", 2), 2: ("DELETE", None)}


def test_bucketed_target_is_not_shuffled(spark):
    from riverbed.operators.latest import save_bucketed
    spark.sql("DROP TABLE IF EXISTS rb_target_bucketed")
    target = spark.createDataFrame([(i, i * 10, f"t{i}") for i in range(50)], "k int, a int, b string")
    save_bucketed(target, "rb_target_bucketed", ["k"], 8)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    ch = spark.createDataFrame([(1, "UPDATE", 5, 0, "x", "0", 7, True, None, False)], SCHEMA)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    out = apply_changes(spark.table("rb_target_bucketed"), ch, ["k"], ["a", "b"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Bucketed: true" in plan
    # only the folded changes are shuffled; the stored target keeps its bucket layout
    assert plan.count("Exchange hashpartitioning") == 1
    got = {r["k"]: (r["a"], r["b"]) for r in out.collect()}
    assert got[1] == (7, "t1") and len(got) == 50


def test_row_payload(spark):
    from riverbed.functions import values as V
    df = spark.createDataFrame([(1, None, "s1")], "id int, name string, region string")
    m = df.select(V.parse(V.row_payload(df.columns)).alias("m")).collect()[0]["m"]
    assert m == {"id": "1", "name": None, "region": "s1"}
