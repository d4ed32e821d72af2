"""F18 on a table that is stored, batch by batch: only the buckets that a batch's keys fall into are read and written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.operators.latest import apply_changes
from riverbed.streaming.versions import VersionedTable, _Folder


class StoredTarget(_Folder):
    """A table with a row per key, dealt into ``buckets`` by a hash of the key (choose them so that a bucket fits a task: a batch
    rewrites whole buckets). ``path/bucket=k/batch=b`` is the bucket as batch ``b`` left it, and a small versioned table tells which
    batch's form each bucket has.

    A batch reads the forms before it and writes its own beside them; they count once its row of the versioned table is
    written, so that a reader sees all of a batch or nothing. A batch that runs again replaces what it wrote. A form stays until the
    second batch after the one that superseded it. Keys are never NULL. ``fold`` is that of ``apply_changes``; with "column" the table doesn't depend on
    how changes are dealt to batches, as long as a key's changes come in order from batch to batch."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key_cols, buckets: int = 64, fold: str = "column"):
        super().__init__(spark, path)
        self.schema, self.keys, self.buckets, self.fold = schema, list(key_cols), buckets, fold
        self.columns = spark.createDataFrame([], schema).columns
        # batch b is version b + 1: version 0 is the table that the first batch finds
        self.forms = VersionedTable(spark, f"{self.path}-forms", "bucket int, batch bigint")

    def bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def started(self) -> bool:
        return bool(self.forms.numbers("v"))

    def start(self, rows: DataFrame) -> None:
        """The table before the first batch; nothing where it is there already."""
        if not self.started():
            self._put(rows, -1, range(self.buckets), {})

    def _forms(self, version: int) -> dict[int, int]:
        return {r["bucket"]: r["batch"] for r in self.forms.read(version).collect()}  # ``buckets`` rows at most

    def _read(self, forms: dict[int, int]) -> DataFrame:
        folders = [f"{self.path}/bucket={k}/batch={b}" for k, b in forms.items()]
        rows = self.spark.read.schema(self.schema)
        return rows.parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def read(self, batch_id: int | None = None) -> DataFrame:
        """The table before ``batch_id``; without one, after the last batch that is whole."""
        version = max(v for v in self.forms.numbers("v") if self.forms.exists(v)) if batch_id is None else batch_id
        if not self.forms.exists(version):
            raise RuntimeError(f"{self.path} has no table before batch {batch_id}: the checkpoint and the table do not belong together")
        return self._read(self._forms(version))

    def _put(self, rows: DataFrame, batch_id: int, touched, forms: dict[int, int]) -> None:
        (rows.select(*self.columns).withColumn("bucket", self.bucket()).repartition("bucket").withColumn("batch", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(self.path))
        # a bucket whose last row is deleted has no folder
        now = {k: b for k, b in forms.items() if k not in touched} | {k: batch_id for k in touched if self.has(f"bucket={k}/batch={batch_id}")}
        self.forms.write(self.spark.createDataFrame(sorted(now.items()), self.forms.schema), batch_id + 1)

    def apply(self, changes: DataFrame, batch_id: int, order_cols=None) -> list[int]:
        """Execute a batch's upserts and deletes (columns as for ``apply_changes``); returns the buckets that were rewritten."""
        if not self.forms.exists(batch_id):
            raise RuntimeError(f"{self.path} has no table before batch {batch_id}: the checkpoint and the table do not belong together")
        forms = self._forms(batch_id)
        touched = sorted(r["k"] for r in changes.select(self.bucket().alias("k")).distinct().collect())  # ``buckets`` numbers at most
        if batch_id and self.forms.exists(batch_id - 1):
            self._tidy(forms, self._forms(batch_id - 1))
        if touched:
            old = self._read({k: b for k, b in forms.items() if k in set(touched)})
            values = [c for c in self.columns if c not in self.keys]
            self._put(apply_changes(old, changes, self.keys, values, self.fold, order_cols), batch_id, set(touched), forms)
        else:
            self.forms.write(self.spark.createDataFrame(sorted(forms.items()), self.forms.schema), batch_id + 1)
        return touched

    def _tidy(self, forms: dict[int, int], before: dict[int, int]) -> None:
        """Drop the forms that neither this batch nor the one before it starts from."""
        last = max([-1, *forms.values()])
        for k in self.numbers("bucket"):
            for b in self.numbers("batch", f"bucket={k}"):
                if b <= last and b not in (forms.get(k), before.get(k)):
                    self.delete(f"bucket={k}/batch={b}")
