"""Ordered topic as a Spark data source: the writer of K2 with commit and abort, and the capped pull of S3.

``format("ordered_topic")`` keeps messages (ordering_key, attributes, data) as Arrow files below a folder that driver and executors
share. A task writes under a name of its own; what counts is the listing that the commit writes, one small file per batch, so that a
failed or repeated task leaves nothing that a reader sees, and a batch that is committed already is not written a second time.
A message's position is its number in its key's order, from 1, over all batches; batches are written one after another. A key's order within a batch is
that of the writer's partitions and of the rows in each: ``write_topic`` deals the rows out by ranges of (key, change
order), so that a hot key is several tasks' work and still in order.

A record batch of a file is one flush of the publisher: at most PUBLISH_MAX_MESSAGES, PUBLISH_MAX_BYTES and PUBLISH_MAX_DELAY_MS.

As a stream, a subscription pulls at most ``max_messages`` of each key in a micro-batch. Offsets are positions by key; they are acknowledged
when Spark has committed the batch, that is after its write. A pull is written down before Spark is told of it, so that a subscription that
starts again begins with the last pull: Spark repeats it if it wasn't committed, and passes it over if it was. With the trigger
``availableNow`` one run is one pull.

Special cases: a null key is a key like any other; a null data is handed on as null; an empty batch is a listing without files; a key without
messages has no offset; a topic that nothing was written to is empty."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter,
                                    DataSourceStreamReader, InputPartition, WriterCommitMessage)

from riverbed import model
from riverbed.session import ship_package
from riverbed.sinks.messages import flushes

#: Messages of a key in a pull (fixed value: the subscriber's cap).
PULL_MESSAGES = 2000

_MESSAGE = pa.schema([("ordering_key", pa.string()), ("attributes", pa.map_(pa.string(), pa.string())), ("data", pa.string())])
_ROW = pa.schema([("ordering_key", pa.string()), ("position", pa.int64()), ("attributes", pa.map_(pa.string(), pa.string())), ("data", pa.string())])
SCHEMA = "ordering_key string, position long, attributes map<string,string>, data string"


def _name(key: str | None) -> str:
    """A key as a member name of a JSON object."""
    return json.dumps(key)


class Topic:
    """The folder of a topic."""

    def __init__(self, path: str) -> None:
        self.fs, at = pafs.FileSystem.from_uri(path)
        self.folder = at.rstrip("/")
        self.known: dict[int, dict] = {}

    def exists(self, name: str) -> bool:
        return self.fs.get_file_info(f"{self.folder}/{name}").type != pafs.FileType.NotFound

    def put(self, name: str, value) -> None:
        self.fs.create_dir(f"{self.folder}/{name}".rpartition("/")[0], recursive=True)
        fresh = f"{self.folder}/{name}.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(fresh) as out:
            out.write(json.dumps(value).encode())
        self.fs.move(fresh, f"{self.folder}/{name}")

    def get(self, name: str):
        with self.fs.open_input_stream(f"{self.folder}/{name}") as file:
            return json.loads(file.read())

    def batches(self) -> list[int]:
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.folder}/batches", allow_not_found=True))
        return sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json"))

    def listing(self, batch: int) -> dict:
        if batch not in self.known:
            self.known[batch] = self.get(f"batches/{batch:012d}.json")
        return self.known[batch]

    def committed(self, batch: int) -> bool:
        return self.exists(f"batches/{batch:012d}.json")

    def totals(self) -> dict[str, int]:
        """Messages of each key so far."""
        got = self.batches()
        return self.listing(got[-1])["totals"] if got else {}

    def commit(self, batch: int, files: list[dict]) -> None:
        """Only the driver commits, batch after batch. The listing has each key's total, so that no reader adds up all batches."""
        last = self.batches()
        if last and last[-1] > batch:
            raise RuntimeError(f"{self.folder} has batch {last[-1]} already: batch {batch} would come behind it")
        before = self.totals()
        totals = dict(before)
        for f in files:
            for key, n in f["runs"]:
                totals[_name(key)] = totals.get(_name(key), 0) + n
        self.put(f"batches/{batch:012d}.json", {"files": files, "totals": totals})

    def spans(self, start: dict[str, int] | None, end: dict[str, int] | None) -> Iterator[Span]:
        """The files with messages after position ``start`` and up to ``end`` of their keys (None: all), from the newest batch back to the
        last one that has any."""
        batches = self.batches()
        for i in range(len(batches) - 1, -1, -1):
            totals = self.listing(batches[i])["totals"]
            if start is not None and all(n <= start.get(k, 0) for k, n in totals.items()):
                return
            at = dict(self.listing(batches[i - 1])["totals"]) if i else {}
            for f in self.listing(batches[i])["files"]:
                row, takes = 0, []
                for key, n in f["runs"]:
                    k = _name(key)
                    first, last = at.get(k, 0), at.get(k, 0) + n
                    low = max(first, start.get(k, 0) if start is not None else 0)
                    high = min(last, end.get(k, 0) if end is not None else last)
                    if low < high:
                        takes.append((row + low - first, high - low, low + 1))
                    at[k], row = last, row + n
                if takes:
                    yield Span(f["name"], takes)


@dataclass
class Span(InputPartition):
    """Messages of a file: first row, number, position of the first, in ascending order of rows."""

    name: str
    takes: list


def rows(path: str, span: Span) -> Iterator[pa.RecordBatch]:
    """The messages of a span with their positions, a record batch of the file at a time."""
    topic = Topic(path)
    with topic.fs.open_input_file(f"{topic.folder}/{span.name}") as source, pa.ipc.open_file(source) as file:
        takes, row, i = span.takes, 0, 0
        for k in range(file.num_record_batches):
            batch = file.get_batch(k)
            while i < len(takes) and takes[i][0] < row + batch.num_rows:
                first, n, position = takes[i]
                low, high = max(first, row), min(first + n, row + batch.num_rows)
                if low < high:
                    part = batch.slice(low - row, high - low)
                    at = pa.array(range(position + low - first, position + high - first), pa.int64())
                    yield pa.RecordBatch.from_arrays([part.column(0), at, part.column(1), part.column(2)], schema=_ROW)
                if first + n > row + batch.num_rows:
                    break
                i += 1
            row += batch.num_rows
            if i == len(takes):
                return


@dataclass
class Written(WriterCommitMessage):
    part: int
    file: dict | None


class _Writer:
    """What the writers of a batch and of a stream have in common."""

    def __init__(self, path: str, batch: int | None) -> None:
        self.path, self.batch = path, batch

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        part = TaskContext.get().partitionId()
        topic = Topic(self.path)
        name = f"messages/{part:06d}-{uuid.uuid4().hex}.arrow"
        messages = (m for b in batches for m in zip(*(b.column(n).to_pylist() for n in _MESSAGE.names)))
        first = next(messages, None)
        if first is None:
            return Written(part, None)
        topic.fs.create_dir(f"{topic.folder}/messages", recursive=True)
        runs: list[list] = []
        with topic.fs.open_output_stream(f"{topic.folder}/{name}") as out, pa.ipc.new_file(out, _MESSAGE) as file:
            for flush in flushes(_led(first, messages), lambda m: len(m[2] or "")):
                columns = zip(_MESSAGE.types, zip(*flush))
                file.write_batch(pa.RecordBatch.from_arrays([pa.array(list(c), t) for t, c in columns], schema=_MESSAGE))
                for key, _, _ in flush:
                    if runs and runs[-1][0] == key:
                        runs[-1][1] += 1
                    else:
                        runs.append([key, 1])
        return Written(part, {"name": name, "runs": runs})

    def _commit(self, messages: list[Written | None], batch: int) -> None:
        topic = Topic(self.path)
        if topic.committed(batch):  # a batch that runs again after its commit
            return self._abort(messages)
        topic.commit(batch, [m.file for m in sorted((m for m in messages if m is not None and m.file), key=lambda m: m.part)])

    def _abort(self, messages: list[Written | None]) -> None:
        topic = Topic(self.path)
        for m in messages:
            if m is not None and m.file and topic.exists(m.file["name"]):
                topic.fs.delete_file(f"{topic.folder}/{m.file['name']}")


def _led(first, rest: Iterable) -> Iterator:
    yield first
    yield from rest


class TopicWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        got = Topic(self.path).batches()
        self._commit(messages, self.batch if self.batch is not None else got[-1] + 1 if got else 0)

    def abort(self, messages) -> None:
        self._abort(messages)


class TopicStreamWriter(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self._commit(messages, batchId)

    def abort(self, messages, batchId: int) -> None:
        self._abort(messages)


class TopicReader(DataSourceReader):
    """All messages, or the first ``most`` of each key."""

    def __init__(self, path: str, most: int | None) -> None:
        self.path, self.most = path, most

    def partitions(self) -> list[Span]:
        topic = Topic(self.path)
        end = None if self.most is None else {k: self.most for k in topic.totals()}
        return list(topic.spans(None, end)) or [Span("", [])]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        return rows(self.path, partition) if partition.name else iter(())


class Subscription(DataSourceStreamReader):
    def __init__(self, path: str, name: str, most: int) -> None:
        self.path, self.most, self.folder = path, most, f"subscriptions/{name}"
        self.topic = Topic(path)
        self.pulled: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        mark = f"{self.folder}/pulled.json"
        if self.pulled is None and self.topic.exists(mark):
            self.pulled = self.topic.get(mark)  # the last pull before the restart, whatever became of it
            return self.pulled
        before = self.pulled or {}
        self.pulled = {k: min(n, before.get(k, 0) + self.most) for k, n in self.topic.totals().items()}
        if self.pulled != before:
            self.topic.put(mark, self.pulled)
        return self.pulled

    def partitions(self, start: dict, end: dict) -> list[Span]:
        return list(self.topic.spans(start, end)) or [Span("", [])]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        return rows(self.path, partition) if partition.name else iter(())

    def commit(self, end: dict) -> None:
        self.topic.put(f"{self.folder}/acknowledged.json", end)

    def __getstate__(self) -> dict:  # tasks open the files themselves
        return self.__dict__ | {"topic": None}


class OrderedTopic(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ordered_topic"

    def schema(self) -> str:
        return SCHEMA

    def _option(self, name: str, kind: Callable, default=None):
        value = self.options.get(name)
        return default if value is None else kind(value)

    def reader(self, schema) -> TopicReader:
        return TopicReader(self.options["path"], self._option("max_messages", int))

    def streamReader(self, schema) -> Subscription:
        return Subscription(self.options["path"], self.options["subscription"], self._option("max_messages", int, PULL_MESSAGES))

    def writer(self, schema, overwrite: bool) -> TopicWriter:
        if overwrite:
            raise ValueError("an ordered topic is only appended to")
        return TopicWriter(self.options["path"], self._option("batch", int))

    def streamWriter(self, schema, overwrite: bool) -> TopicStreamWriter:
        return TopicStreamWriter(self.options["path"], None)


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(OrderedTopic)


def write_topic(frame: DataFrame, path: str, batch: int | None = None) -> None:
    """K2: publish the messages of ``ordered_topic_frame`` in change order per key. ``batch`` (in ``foreachBatch``: its id) makes
    it once however often the batch runs; without one the rows are a new batch. Any error fails the write, and then none of it is visible."""
    register(frame.sparkSession)
    order = ["ordering_key", *model.order_columns(frame)]
    w = (frame.repartitionByRange(*order).sortWithinPartitions(*order).select(*_MESSAGE.names)
         .write.format("ordered_topic").mode("append"))
    (w if batch is None else w.option("batch", batch)).save(path)


def read_topic(spark: SparkSession, path: str, max_messages: int | None = None) -> DataFrame:
    """The messages with their positions; with ``max_messages`` the first pull of every key."""
    register(spark)
    r = spark.read.format("ordered_topic")
    return (r if max_messages is None else r.option("max_messages", max_messages)).load(path)


def subscribe(spark: SparkSession, path: str, subscription: str, max_messages: int = PULL_MESSAGES) -> DataFrame:
    """S3: the topic as a stream, at most ``max_messages`` of each key in a micro-batch."""
    register(spark)
    return spark.readStream.format("ordered_topic").option("subscription", subscription).option("max_messages", max_messages).load(path)


def topic_rows(messages: DataFrame) -> DataFrame:
    """``shard`` and ``value`` (``buffer_messages``) as ``write_topic`` takes them."""
    return messages.select(F.col("shard").alias("ordering_key"), F.create_map(F.lit("shardId"), F.col("shard")).alias("attributes"),
                           F.col("value").alias("data"), *model.order_columns(messages))


def buffer_rows(messages: DataFrame) -> DataFrame:
    """Messages as ``buffer_to_database_stream`` reads them: ``shard``, ``value``."""
    return messages.selectExpr("ordering_key AS shard", "data AS value")
