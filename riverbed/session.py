"""Session helpers: building a session for tests/bench, UTC pinning, checkpoint folders,
and size-checked broadcasting of configuration frames."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Configuration frames (session mapping, shard lists, catalogs) are broadcast only
# while they stay under this many rows; above it the join falls back to a shuffle.
BROADCAST_ROW_LIMIT = 100_000

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ensure_rocksdb_state(spark: SparkSession) -> None:
    """Stateful processors (``transformWithState``) need the RocksDB state store, which also
    keeps large state off the JVM heap."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, "") != ROCKSDB_PROVIDER:
        spark.conf.set(key, ROCKSDB_PROVIDER)


def build_session(master: str | None = None, app: str = "riverbed", partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster, pass the cluster's own master."""
    master = master or os.environ.get("RIVERBED_MASTER", "local[8]")
    # Python processes started by the JVM (workers, the stateful-processor runner) inherit
    # the environment: put the package root on their path before the JVM starts.
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([root] + paths)
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.shuffle.partitions", str(partitions or 8))
         .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
         .config("spark.driver.memory", "8g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Commit timestamps are instants; all text rendering assumes a UTC session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect sessions have no SparkContext)
        return None


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (None when unset).

    The setting itself is read, not ``SparkContext.getCheckpointDir()``: that one carries a
    subfolder of this application, which a restarted job would not find again."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    sc = _context(spark)
    return sc.getCheckpointDir() if sc is not None else None


def _one_machine(spark: SparkSession) -> bool:
    sc = _context(spark)
    return sc is not None and re.fullmatch(r"local(\[[^\]]*\])?", sc.master or "") is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. A private scratch folder is made only where driver and
    executors are one process (tests, local runs); on a cluster a missing setting is an error,
    because executors would write to disks that nobody else can read."""
    d = checkpoint_root(spark)
    if not d:
        if not _one_machine(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="riverbed-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc = _context(spark)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def stream_checkpoint(spark: SparkSession, name: str, path: str | None = None) -> str:
    """Checkpoint location of a streaming job: ``path`` when given, else the job's name under
    the shared checkpoint folder. It is stable: a job started again under the same name goes on
    where it stopped. Two different jobs need two names."""
    return path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"


#: Scratch tables of this process, by the session's application: (session, path).
_SCRATCH: list = []


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Cut lineage by writing the frame once as parquet into the shared checkpoint folder
    and reading it back (a reliable copy: survives executor loss, and values computed by
    non-deterministic expressions such as partition ids are fixed from then on).

    ``DataFrame.checkpoint`` would compute the plan twice (once to count, once to write);
    a table write computes it once. The partitioning is kept as one file per partition.
    ``release_scratch`` removes the copies once the results that read them are written; those
    left over go when the process ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared checkpoint folder, for files that ``release_scratch`` removes."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tables/{name}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(release_scratch)
    _SCRATCH.append((spark, path))
    return path


def release_scratch(spark: SparkSession | None = None) -> int:
    """Delete the scratch tables written so far (of ``spark``, or of all sessions); frames that
    still read them become unusable. Returns how many were deleted."""
    gone = 0
    for entry in list(_SCRATCH):
        owner, path = entry
        if spark is not None and owner is not spark:
            continue
        _SCRATCH.remove(entry)
        try:
            sc = owner.sparkContext
            where = sc._jvm.org.apache.hadoop.fs.Path(path)
            gone += bool(where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True))
        except Exception:  # noqa: BLE001  (the session has ended: nothing can be reached any more)
            continue
    return gone


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if its scan has fewer partitions than there are: a file of one row group is one
    task, however much work its rows are later. A scan of many partitions is left as it is."""
    sc = _context(df.sparkSession)
    if sc is None or df.rdd.getNumPartitions() >= sc.defaultParallelism:
        return df
    return df.repartition(sc.defaultParallelism)


#: Rows that a task is to hold at most where it sorts them.
TASK_ROWS = 500_000


def tasks_for(df: DataFrame, least: int = 1) -> int:
    """How many tasks ``df``'s rows need at ``TASK_ROWS`` each. They are counted: for a stored table
    that reads the files' footers only."""
    return max(least, -(-df.count() // TASK_ROWS))


BROADCAST_BYTE_LIMIT = 64 * 1024 * 1024


def _plan_size_bytes(df: DataFrame) -> int | None:
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # noqa: BLE001
        return None


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT,
                      max_bytes: int = BROADCAST_BYTE_LIMIT) -> DataFrame:
    """Broadcast-hint a frame only after proving its size bound.

    First Catalyst's size estimate of the plan is used (exact for cached and local frames,
    an upper bound for most derived ones); when it does not prove the bound, the rows are
    counted (one small job on a configuration frame). Above the bound no hint is added and
    Spark plans a shuffle join instead."""
    size = _plan_size_bytes(df)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``riverbed`` importable in Python workers (stateful processors, pandas UDFs):
    zip the package once and ``addPyFile`` it, which distributes it to every executor."""
    sc = _context(spark)
    key = sc.applicationId if sc is not None else id(spark)
    if key in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="riverbed-pkg-"), "riverbed.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    if sc is not None:
        sc.addPyFile(out)
    else:
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED.add(key)
