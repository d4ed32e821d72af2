"""Database writer (K3) with per-shard connection routing (K4), bounded retries and a
status frame that drives fail-stop per shard (W4).

Statements are routed to their shard's connection inside executor tasks. Each task gets
whole keys, sorted in change order, so per-key order is kept while a shard is written by a stated
number of tasks. Upserts and deletes by primary key are idempotent, so a re-run task after an executor
loss converges to the same rows; a plain insert of a table that has nothing but its key is so only
in the form that ``render_dml(insert_if_absent=True)`` gives it, which the jobs use.

With ``mark=(job, batch)`` a batch is applied once, whatever its statements: in the transaction of each chunk a row of
MARKS says how many statements of which batch a writer has executed. A batch that runs again skips what it has done, also
after later ones: their effects stay.

``connect(shard_id)`` is the caller's DB-API connection factory (a real deployment opens a
JDBC/driver connection from the shard frame; tests use ``sqlite3``).
"""

from __future__ import annotations

import time

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed import model

STATUS_SCHEMA = "shard string, statements bigint, retries bigint, ok boolean, error string"
REPORT_SCHEMA = (f"kind string, {STATUS_SCHEMA}, table_name string, keys_json string, commit_seconds bigint, commit_nanos int, "
                 "server_txn_id string, record_sequence string, mod_position int, dml string")
_ROW = ["table_name", "keys_json", "commit_seconds", "commit_nanos", "server_txn_id", "record_sequence", "mod_position", "dml"]
#: Tasks that write to a shard at a time (each with a connection of its own); a shard's keys are dealt out over them.
WRITERS_PER_SHARD = 2
#: The table of the marks in each target; made if the connection's user may.
MARKS = "riverbed_commit_marks"


def _default_retryable(exc: Exception) -> bool:
    name = type(exc).__name__.lower()
    return "operational" in name or "connection" in name or "timeout" in name


class Marks:
    """How far a writer of a job has come in one target: the statements that it has executed of its latest batch. In plain SQL, without
    parameters, whose style depends on the driver."""

    def __init__(self, job: str, batch: int, writer: int):
        self.batch, self.where = batch, "job = '" + job.replace("'", "''") + f"' AND writer = {writer}"
        self.key = self.where.replace("job = ", "").replace(" AND writer = ", ", ")

    def done(self, connection) -> int | None:
        """Statements of this batch that are executed; None: all, in a batch before a later one."""
        cur = connection.cursor()
        cur.execute(f"CREATE TABLE IF NOT EXISTS {MARKS} (job VARCHAR(200) NOT NULL, writer INTEGER NOT NULL, batch BIGINT NOT NULL, done BIGINT NOT NULL, PRIMARY KEY (job, writer))")
        connection.commit()
        cur.execute(f"SELECT batch, done FROM {MARKS} WHERE {self.where}")
        row = cur.fetchone()
        if row is None or row[0] < self.batch:
            return 0
        return row[1] if row[0] == self.batch else None

    def put(self, cursor, done: int) -> None:
        cursor.execute(f"DELETE FROM {MARKS} WHERE {self.where}")
        cursor.execute(f"INSERT INTO {MARKS} (job, writer, batch, done) VALUES ({self.key}, {self.batch}, {done})")


def write_and_report(rendered: DataFrame, connect, batch_size: int = 1000, max_retries: int = 5, backoff_seconds: float = 1.0,
                     is_retryable=_default_retryable, writers_per_shard: int = WRITERS_PER_SHARD,
                     mark: tuple[str, int] | None = None) -> DataFrame:
    """Execute ``dml`` per shard; returns rows of two kinds: ``status``, one per (task, shard) with what was
    executed, and ``unwritten``, one per statement that wasn't (the chunk that failed and all that follows in
    that task and shard). Connection errors are retried with exponential backoff up to ``max_retries``.

    Statements are dealt out by (shard, hash of the key modulo ``writers_per_shard``): a shard has at most
    so many connections, whatever the number of tasks, and a key's changes stay in one task, in order. The
    report is written once before it is read, so that no statement is executed a second time for it."""
    from riverbed.session import cut_lineage, ship_package
    ship_package(rendered.sparkSession)
    stmts = rendered.where(F.col("dml") != "")
    if model.MOD_POSITION not in stmts.columns:
        stmts = stmts.withColumn(model.MOD_POSITION, F.lit(0))
    order = [*model.ORDER_COLUMNS, model.MOD_POSITION]
    stmts = stmts.select("shard", *_ROW).withColumn("_writer", F.pmod(F.xxhash64("table_name", "keys_json"), F.lit(writers_per_shard)))
    parts = stmts.repartition("shard", "_writer").sortWithinPartitions("shard", "_writer", *order, "dml")

    def run(batches):
        conns, stats, failed, places = {}, {}, {}, {}
        for pdf in batches:
            unwritten = []
            for (shard, writer), grp in pdf.groupby(["shard", "_writer"], sort=False):
                st = stats.setdefault(shard, {"statements": 0, "retries": 0})
                marks = None if mark is None else Marks(*mark, int(writer))
                for i in range(0, len(grp), batch_size):
                    chunk = grp.iloc[i:i + batch_size]
                    # statements of this writer before the chunk: its order is the same whenever the batch runs
                    place = places.get((shard, writer), 0)
                    places[shard, writer] = place + len(chunk)
                    attempt = 0
                    while shard not in failed:
                        try:
                            if shard not in conns:
                                # a task's rows are sorted by shard: a connection to another one isn't needed any more
                                for other in list(conns):
                                    conns.pop(other).close()
                                conns[shard] = connect(shard)
                            done = 0 if marks is None else marks.done(conns[shard])
                            rest = chunk["dml"].iloc[:0] if done is None else chunk["dml"].iloc[max(0, done - place):]
                            cur = conns[shard].cursor()
                            for s in rest:
                                cur.execute(s)
                            if marks is not None and len(rest):
                                marks.put(cur, place + len(chunk))
                            conns[shard].commit()
                            st["statements"] += len(rest)
                            break
                        except Exception as e:  # noqa: BLE001
                            try:
                                conns.pop(shard).close()
                            except Exception:  # noqa: BLE001
                                pass
                            if is_retryable(e) and attempt < max_retries:
                                attempt += 1
                                st["retries"] += 1
                                time.sleep(backoff_seconds * (2 ** (attempt - 1)))
                                continue
                            failed[shard] = f"{type(e).__name__}: {e}"
                    if shard in failed:
                        unwritten.append(chunk.assign(kind="unwritten", error=failed[shard], statements=None, retries=None, ok=False))
            if unwritten:
                yield pd.concat(unwritten)[_REPORT]
        for c in conns.values():
            try:
                c.close()
            except Exception:  # noqa: BLE001
                pass
        status = pd.DataFrame([{"kind": "status", "shard": s, **v, "ok": s not in failed, "error": failed.get(s)} for s, v in stats.items()], columns=_REPORT)
        yield status.astype(object).where(status.notna(), None)

    return cut_lineage(parts.mapInPandas(run, REPORT_SCHEMA), "write-report")


_REPORT = [c.split()[0] for c in REPORT_SCHEMA.split(", ")]


def write_statements(rendered: DataFrame, connect, **options) -> DataFrame:
    """The status rows of ``write_and_report``: ``(shard, statements, retries, ok, error)``."""
    return write_and_report(rendered, connect, **options).where("kind = 'status'").select(*[c.split()[0] for c in STATUS_SCHEMA.split(", ")])


def shard_summary(status: DataFrame) -> DataFrame:
    """Fold task statuses to one row per shard (G4 records written, G6 retries)."""
    return status.groupBy("shard").agg(F.sum("statements").alias("statements"), F.sum("retries").alias("retries"),
                                       F.min(F.col("ok").cast("int")).cast("boolean").alias("ok"),
                                       F.max("error").alias("error"))


def append_table_jdbc(df: DataFrame, url: str, table: str, properties: dict, batch_size: int = 1000) -> None:
    """Plain append of a frame into a database table (``DataFrameWriter.jdbc``)."""
    df.write.option("batchsize", batch_size).jdbc(url, table, mode="append", properties=properties)
