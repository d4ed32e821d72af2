"""Live distributions of a running job (G4-G6): counts, sums, extremes and quantiles of lags and latencies, per shard and batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.operators.metrics import _ts
from riverbed.streaming.versions import _Folder

SCHEMA = "shard string, measure string, n bigint, sum decimal(38,6), min double, max double, sketch binary"


class Meter(_Folder):
    """A row per batch, shard and measure with count, sum, minimum, maximum and a KLL sketch of the values. A batch's rows are one partial
    aggregation over what the batch has written, so a hot shard costs a row per task; a batch that runs again replaces its own. Sketches merge: quantiles over any
    batches and shards come from the stored rows, within ``error`` of the rank (99 % of the time)."""

    #: Size of a sketch, and what it gives.
    K, error = 400, 0.01

    def __init__(self, spark: SparkSession, path: str, shard_col: str = "shard"):
        super().__init__(spark, path)
        self.shard = shard_col

    def put(self, rows: DataFrame, batch_id: int, **measures) -> None:
        """``measures``: name -> column of numbers; NULLs don't count."""
        named = [F.struct(F.lit(m).alias("measure"), F.count(m).alias("n"), F.sum(F.col(m).cast("decimal(28,6)")).alias("sum"), F.min(m).alias("min"),
                          F.max(m).alias("max"), F.kll_sketch_agg_double(m, self.K).alias("sketch")) for m in measures]
        wide = rows.select(F.col(self.shard).cast("string").alias("shard"), *[c.cast("double").alias(m) for m, c in measures.items()])
        long = wide.groupBy("shard").agg(F.array(*named).alias("_m")).select("shard", F.inline("_m")).where("n > 0")
        long.select(*[c.split()[0] for c in SCHEMA.split(", ")]).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def put_lag(self, rows: DataFrame, batch_id: int, now=None) -> None:
        """The lag in ms from a change's commit to ``now``, the instant at which the batch was written (default: this one)."""
        at = F.current_timestamp() if now is None else _ts(now)
        self.put(rows, batch_id, lag_ms=F.floor((F.unix_micros(at) - F.unix_micros("commit_ts")) / 1000))

    def read(self, batches=None) -> DataFrame:
        """The stored rows with ``batch``, of all or of these batches."""
        known = [b for b in self.numbers("batch") if (batches is None or b in batches) and self.has(f"batch={b}/_SUCCESS")]
        if not known:
            return self.spark.createDataFrame([], f"{SCHEMA}, batch bigint")
        return (self.spark.read.schema(f"{SCHEMA}, batch bigint").option("basePath", self.path).parquet(*[f"{self.path}/batch={b}" for b in known]))

    def report(self, quantiles=(0.5, 0.95, 0.99), batches=None) -> DataFrame:
        """Per measure and shard, and over all shards (``scope`` "all"): ``n``, ``sum``, ``min``, ``max`` and ``p50``, ... (of the ``quantiles``)."""
        total = (self.read(batches).rollup("measure", "shard")
                 .agg(F.sum("n").alias("n"), F.sum("sum").cast("decimal(38,6)").alias("sum"), F.min("min").alias("min"), F.max("max").alias("max"),
                      F.kll_merge_agg_double("sketch", self.K).alias("_s"), F.grouping_id().alias("_g")).where("_g < 3"))
        at = [F.kll_sketch_get_quantile_double("_s", F.lit(float(q))).alias(f"p{q * 100:g}".replace(".", "_")) for q in quantiles]
        return total.select("measure", "shard", F.when(F.col("_g") == 1, F.lit("all")).otherwise(F.lit("shard")).alias("scope"), "n", "sum", "min", "max", *at)
