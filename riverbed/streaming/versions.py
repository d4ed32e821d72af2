"""Tables that micro-batches keep, in forms that a batch may write twice.

``VersionedTable`` is for a few rows (a clock, stopped shards): batch ``b`` reads the version of the batch before and
writes its own. ``PartitionedLog`` and ``KeyedLog`` are for state of any size: a batch appends its own rows
and reads only the folders that it needs, so that what it writes follows the batch and not the table.

A batch that is run again after a failure or a restart finds the same input and writes the same folders, which makes
its effect the same however often it runs. What a batch has no more use for goes when the next one begins: then it is
known to be committed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _names(schema: str) -> list[str]:
    return [c.strip().split()[0] for c in schema.split(",")]


class _Folder:
    """Folders below a path of the shared file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(sc._jsc.hadoopConfiguration()), p

    def has(self, name: str) -> bool:
        fs, p = self._fs(f"{self.path}/{name}")
        return fs.exists(p)

    def numbers(self, column: str, below: str = "") -> list[int]:
        """The values of the folders ``column=value`` directly below."""
        fs, p = self._fs(f"{self.path}/{below}".rstrip("/"))
        if not fs.exists(p):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(x.split("=", 1)[1]) for x in found if x.startswith(f"{column}="))

    def delete(self, name: str) -> None:
        fs, p = self._fs(f"{self.path}/{name}")
        fs.delete(p, True)


class VersionedTable(_Folder):
    def __init__(self, spark: SparkSession, path: str, schema: str):
        super().__init__(spark, path)
        self.schema = schema

    def exists(self, version: int) -> bool:
        return version >= 0 and self.has(f"v={version}/_SUCCESS")

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v={version}")

    def before(self, batch_id: int) -> DataFrame | None:
        """The version that batch ``batch_id`` starts from; None before the first batch. A version
        that is missing later on is an error: going on without it would lose rows."""
        if batch_id == 0:
            return None
        if not self.exists(batch_id - 1):
            raise RuntimeError(f"{self.path} has no version {batch_id - 1}: the checkpoint and the table do not belong together")
        return self.read(batch_id - 1)

    def write(self, df: DataFrame, batch_id: int) -> DataFrame:
        df.select(*_names(self.schema)).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/v={batch_id}")
        if batch_id >= 2:
            self.delete(f"v={batch_id - 2}")
        return self.read(batch_id)


class PartitionedLog(_Folder):
    """Rows appended by batches, in folders by the whole number ``by`` and the batch: a row is written once.
    Only the folders of the values that are asked for are listed and read."""

    def __init__(self, spark: SparkSession, path: str, schema: str, by: str):
        super().__init__(spark, path)
        self.schema, self.by = schema, by

    def append(self, df: DataFrame, batch_id: int) -> None:
        """``df`` has the columns of the schema and ``by``. A batch that runs again replaces its own folders."""
        (df.select(*_names(self.schema), F.col(self.by).cast("bigint").alias(self.by), F.lit(batch_id).cast("bigint").alias("batch"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.by, "batch").parquet(self.path))

    def values(self) -> list[int]:
        return self.numbers(self.by)

    def read(self, values: list[int], batch_id: int) -> DataFrame | None:
        """The rows of these values that batches before ``batch_id`` have appended; None if there is no such folder."""
        folders = [f"{self.path}/{self.by}={v}" for v in values]
        if not folders:
            return None
        rows = self.spark.read.schema(f"{self.schema}, {self.by} bigint, batch bigint").option("basePath", self.path).parquet(*folders)
        return rows.where(F.col("batch") < batch_id).select(*_names(self.schema))

    def drop(self, values: list[int]) -> None:
        for v in values:
            self.delete(f"{self.by}={v}")


class KeyedLog(_Folder):
    """One value per key, the greatest that batches have appended.

    Keys are dealt into ``buckets`` by a hash. A batch appends a run with its own keys to each bucket that it touches, and looks
    its keys up in those buckets only. Runs are merged by ``fold``s: after ``fold`` batches their runs become one, after ``fold`` of
    those one again, so that a row is written log(batches) / log(fold) times and a bucket has few runs. A run is
    known by the batches that it covers; one inside another is superseded."""

    def __init__(self, spark: SparkSession, path: str, key_schema: str, value: str, buckets: int = 16, fold: int = 16):
        super().__init__(spark, path)
        self.keys, self.value = _names(key_schema), value.split()[0]
        self.schema, self.buckets, self.fold = f"{key_schema}, {value}", buckets, fold

    def bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets))

    def _write(self, rows: DataFrame, first: int, last: int) -> None:
        best = rows.groupBy(*self.keys).agg(F.max(self.value).alias(self.value)).withColumn("bucket", self.bucket())
        number = lambda x: F.lit(x).cast("bigint")
        (best.repartition("bucket").withColumn("first", number(first)).withColumn("last", number(last))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "first", "last").parquet(self.path))

    def runs(self, bucket: int, batch_id: int) -> list[tuple[int, int]]:
        """(first, last) of a bucket's runs that end before a batch, without superseded ones."""
        found = [(a, b) for a in self.numbers("first", f"bucket={bucket}") for b in self.numbers("last", f"bucket={bucket}/first={a}") if b < batch_id]
        return [x for x in found if not any(y != x and y[0] <= x[0] and x[1] <= y[1] for y in found)]

    def _read(self, places: list[tuple[int, int, int]]) -> DataFrame:
        folders = [f"{self.path}/bucket={k}/first={a}/last={b}" for k, a, b in places]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def start(self, rows: DataFrame, batch_id: int) -> None:
        """Values from before the first batch, written with it."""
        if batch_id == 0:
            self._write(rows, -1, -1)

    def lookup(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """The values before ``batch_id`` of (at least) the keys of ``rows``."""
        touched = sorted(r["k"] for r in rows.select(self.bucket().alias("k")).distinct().collect())  # ``buckets`` numbers at most
        known = self._read([(k, a, b) for k in touched for a, b in self.runs(k, batch_id)])
        return known.groupBy(*self.keys).agg(F.max(self.value).alias(self.value))

    def append(self, rows: DataFrame, batch_id: int) -> None:
        self._write(rows, batch_id, batch_id)
        self._tidy(batch_id)

    def _tidy(self, batch_id: int) -> None:
        """Drop what the batch before superseded, then merge the runs of ``fold``, ``fold`` squared, ... batches that end with
        the batch before, the widest that is due."""
        for k in self.numbers("bucket"):
            kept = set(self.runs(k, batch_id - 1))
            for a in self.numbers("first", f"bucket={k}"):
                for b in self.numbers("last", f"bucket={k}/first={a}"):
                    if b < batch_id - 1 and (a, b) not in kept:
                        self.delete(f"bucket={k}/first={a}/last={b}")
        width = 1
        while batch_id and batch_id % (width * self.fold) == 0:
            width *= self.fold
        if width > 1:
            places = [(k, a, b) for k in self.numbers("bucket") for a, b in self.runs(k, batch_id) if a >= batch_id - width]
            self._write(self._read(places), batch_id - width, batch_id - 1)
