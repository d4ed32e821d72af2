"""What the operators share: Arrow passes over a table, hashing and column picking."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from riverbed.session import broadcast_checked, ship_package

#: Code points or bytes of text that one Python step holds at a time; a batch is cut into runs
#: of rows of about this size, so that memory follows it and not the length of a batch.
RUN_BYTES = 8 << 20
#: Bytes of an Arrow batch between Spark and Python: without it a batch is 10,000 rows, however long.
BATCH_BYTES = 8 << 20
#: Bytes of an Arrow batch and rows of a Parquet reader's batch where a job has many passes one after another: the JVM's
#: heap and idle Python workers keep what the largest batch took, and the passes' shares add up.
LEAN_BYTES, LEAN_ROWS = 1 << 20, 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **types: str) -> DataFrame:
    """The named columns in the given types; one that the frame lacks is null throughout."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{c}`") if c in have else F.lit(None)).cast(t).alias(c) for c, t in types.items()])


def _at_most(spark: SparkSession, key: str, most: int) -> None:
    have = spark.conf.get(key)
    if have.rstrip("b").isdigit() and int(have.rstrip("b")) > most:
        spark.conf.set(key, str(most))


def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Batches by bytes for the passes of this session, unless it has a smaller bound already."""
    _at_most(spark, "spark.sql.execution.arrow.maxBytesPerBatch", most)


def lean_batches(spark: SparkSession) -> None:
    """Small batches for the scans and passes of this session, unless it has smaller bounds already. A reader's
    batch is 4,096 rows otherwise, however long: its texts are one array that grows by doubling."""
    bounded_batches(spark, LEAN_BYTES)
    _at_most(spark, "spark.sql.parquet.columnarReaderBatchSize", LEAN_ROWS)


def runs(batch: pa.RecordBatch, column: str, most: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose ``column`` holds about ``most`` bytes each (one row at least)."""
    at = batch.schema.get_field_index(column)
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0)))
    start = 0
    while start < batch.num_rows:
        base = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, base + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def arrow_pass(df: DataFrame, work: Callable[[dict[str, list]], dict[str, list]], made: str,
               keep: Iterable[str] = (), text: str | None = "text", reads: Iterable[str] = (), run_bytes: int = RUN_BYTES) -> DataFrame:
    """One pass of ``work`` over the rows of ``df``, without a shuffle.

    ``work`` gets the columns of a run of rows as Python lists and returns those of ``made`` (a
    schema in DDL); ``keep`` names the columns that are handed on untouched, which ``work`` sees
    only if they are named in ``reads`` or are the text (runs of rows are cut by its size, ``run_bytes``, if there is one). When ``work`` returns a key ``"*"``, it is the list of row numbers that the result's rows come from:
    rows can be dropped or repeated."""
    ship_package(df.sparkSession)
    bounded_batches(df.sparkSession)
    keep = list(keep)
    fields = T._parse_datatype_string(made).fields if made else []
    types = {f.name: to_arrow_type(f.dataType) for f in fields}
    unseen = set(keep) - {text, *reads}

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch, text, run_bytes) if text else [batch]:
                got = work({f.name: run.column(i).to_pylist() for i, f in enumerate(run.schema) if f.name not in unseen})
                kept = [run.column(run.schema.get_field_index(c)) for c in keep]
                if "*" in got:
                    take = pa.array(got["*"], pa.int64())
                    kept = [c.take(take) for c in kept]
                yield pa.RecordBatch.from_arrays(kept + [pa.array(got[n], t) for n, t in types.items()], names=[*keep, *types])

    return df.mapInArrow(step, T.StructType([df.schema[c] for c in keep] + fields))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over 64-bit integers (SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hash_order(column: str, seed: int) -> Column:
    """A reproducible order that has nothing to do with the order of the keys."""
    return F.xxhash64(F.col(column).cast("string"), F.lit(seed))


def sampled(df: DataFrame, by: str, key: str, most: int, seed: int = 11) -> DataFrame:
    """At most ``most`` rows for each value of ``by``, those that come first in hash order of
    ``key``. A count without the wide columns sets a threshold on the hash first, so that about
    three times as many rows reach the ranking, however large the table is."""
    counts = df.groupBy(F.col(by).alias("__by")).agg(F.count("*").alias("__n"))
    lot = F.pmod(hash_order(key, seed), F.lit(1 << 40)) / F.lit(float(1 << 40))
    near = (df.withColumn("__lot", lot).join(broadcast_checked(counts), F.col(by).eqNullSafe(F.col("__by")))
            .where(F.col("__lot") * F.col("__n") < 3.0 * most + 50))
    rank = F.row_number().over(Window.partitionBy(by).orderBy("__lot", key))
    return near.withColumn("__rank", rank).where(F.col("__rank") <= most).drop("__lot", "__by", "__n", "__rank")
