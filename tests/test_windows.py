"""Window alignment (W8) and id de-duplication."""

from pyspark.sql import functions as F

from riverbed.streaming.windows import dedup_ids, size_micros, window_start


def starts(spark, ts, size):
    df = spark.createDataFrame([(ts,)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    return df.select(window_start(F.col("t"), size).alias("w"), F.window("t", size.replace("s", " seconds")).start
                     .alias("w2")).collect()[0]


def test_aligned_starts(spark):
    r = starts(spark, "2024-01-01 10:00:00", "10s")
    assert r["w"].strftime("%H:%M:%S") == "10:00:00" and r["w"] == r["w2"]
    r = starts(spark, "2024-01-01 10:26:02.707", "10s")
    assert r["w"].strftime("%H:%M:%S.%f") == "10:26:00.000000" and r["w"] == r["w2"]


def test_sizes():
    assert size_micros("10s") == 10_000_000 and size_micros("5m") == 300_000_000
    assert size_micros("2 hours") == 7_200_000_000


def test_dedup_ids_expiry(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-05 00:00:00"), (2, "2023-01-01 00:00:00")],
                               "id int, created_at string").withColumn("created_at", F.col("created_at").cast("timestamp"))
    out = {r["id"]: r["created_at"].day for r in dedup_ids(df, now="2024-01-20 00:00:00").collect()}
    assert out == {1: 1}
