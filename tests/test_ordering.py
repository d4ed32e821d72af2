"""Skew-safe positions (O1/O3) and prefix maximum (W9 twin) against brute force,
including one group that holds most rows."""

from hypothesis import given, settings, strategies as st

from riverbed.operators.ordering import positions, prefix_max


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]), st.integers(0, 10_000)),
                min_size=1, max_size=60, unique_by=lambda x: x[1]))
def test_positions_and_prefix_max(spark, rows):
    df = spark.createDataFrame([(g, o, (o * 7919) % 101) for g, o in rows], "g string, o long, v long")
    got = {r["o"]: r["position"] for r in positions(df, ["o"], ["g"], num_partitions=4).collect()}
    want = {}
    for g in {g for g, _ in rows}:
        for i, o in enumerate(sorted(o for gg, o in rows if gg == g)):
            want[o] = i + 1
    assert got == want
    pm = {r["o"]: r["prior_max"] for r in prefix_max(df, "v", ["o"], ["g"], num_partitions=4).collect()}
    vals = {o: (o * 7919) % 101 for _, o in rows}
    for g in {g for g, _ in rows}:
        seen = None
        for o in sorted(o for gg, o in rows if gg == g):
            assert pm[o] == seen
            seen = vals[o] if seen is None else max(seen, vals[o])


def test_positions_window_method(spark):
    df = spark.createDataFrame([("x", 3), ("x", 1), ("y", 2)], "g string, o long")
    got = sorted((r["g"], r["o"], r["position"]) for r in positions(df, ["o"], ["g"], method="window", start=0).collect())
    assert got == [("x", 1, 0), ("x", 3, 1), ("y", 2, 0)]
