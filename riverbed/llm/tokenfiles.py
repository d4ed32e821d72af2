"""Token ids as binary files: documents in ascending order of their ids, Simple-8b blocks, offsets.

``write`` deals the documents out by ranges of their order, encodes each range in order and writes a file
for it; ``read`` gives a row per document from the files. Both are a Spark data source
(``format("simple8b")``): a task writes under a name of its own, and only files that the commit lists exist for readers,
so that a task that is repeated or lost leaves nothing behind that counts. The commit is one small JSON file with a line of totals per file;
from them follows where in the whole each file starts.

A file: MAGIC, the coded blocks one after another (words, then the escapes' values and places), and a footer: per block its
offset, numbers of words and escapes; per document its id and number of tokens; then the footer's sizes and
offset, and MAGIC again. A reader takes the footer and decodes any run of blocks by their offsets.

Special cases: null and empty texts have the closing id alone; a document whose doc_id is null comes first;
documents of one doc_id are in the order of a hash of their texts (equal rows give equal rows, and any number of them is dealt over many
files); very long texts are coded and checked block by block; an empty table gives no file and no rows; only
doc_id and text are read, other columns don't matter."""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from riverbed.llm import simple8b
from riverbed.llm.common import bounded_batches, pick, runs
from riverbed.llm.simple8b import BLOCK, Blocks
from riverbed.llm.wordids import RUN_BYTES, word_ids
from riverbed.session import scratch_path, ship_package

MAGIC = b"S8BTOK01"
LISTING = "_files.json"
END_ID = 2
#: Bytes of text of a range of documents, about; a file holds their ids.
RANGE_BYTES = 32 << 20
#: Blocks that are coded or decoded together.
STEP = 256

_TAIL = struct.Struct("<QQQQ8s")  # offset of the footer, blocks, documents, ids
_ENTRY = np.dtype([("offset", "<u8"), ("words", "<u4"), ("escapes", "<u4")])
_DOC = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("tokens", "<u8")])


def place(path: str) -> tuple[pafs.FileSystem, str]:
    fs, at = pafs.FileSystem.from_uri(path)
    return fs, at.rstrip("/")


class FileWriter:
    """One file. Memory: the ids of STEP blocks, and the footer."""

    def __init__(self, out) -> None:
        self.out, self.offset = out, 0
        self.entries: list[tuple[int, int, int]] = []
        self.docs: list[np.ndarray] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.put(MAGIC)

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.offset += len(data)

    def add(self, doc_ids: list[int | None], tokens: np.ndarray, ids: np.ndarray) -> None:
        rows = np.zeros(len(doc_ids), _DOC)
        rows["doc_id"], rows["known"], rows["tokens"] = [d or 0 for d in doc_ids], [d is not None for d in doc_ids], tokens
        self.docs.append(rows)
        self.n_ids += len(ids)
        for at in range(0, len(ids), STEP * BLOCK):  # one very long text is taken in parts
            part = ids[at:at + STEP * BLOCK]
            self.waiting.append(part)
            self.n_waiting += len(part)
            if self.n_waiting >= STEP * BLOCK:
                self.flush()

    def flush(self, last: bool = False) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        coded = simple8b.encode(ids[:whole])
        words, escapes = np.cumsum(coded.n_words), np.cumsum(coded.n_escapes)
        for w1, n, e1, k in zip(words.tolist(), coded.n_words.tolist(), escapes.tolist(), coded.n_escapes.tolist()):
            self.entries.append((self.offset, n, k))
            self.put(coded.words[w1 - n:w1].astype("<u8").tobytes() + coded.values[e1 - k:e1].astype("<u8").tobytes() + coded.places[e1 - k:e1].astype("<u2").tobytes())
        self.waiting, self.n_waiting = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self.flush(last=True)
        at = self.offset
        docs = np.concatenate(self.docs) if self.docs else np.zeros(0, _DOC)
        self.put(np.array(self.entries, _ENTRY).tobytes() + docs.tobytes())
        self.put(_TAIL.pack(at, len(self.entries), len(docs), self.n_ids, MAGIC))


class FileReader:
    """One file, by its footer."""

    def __init__(self, file) -> None:
        self.file, size = file, file.size()
        at, n_blocks, n_docs, self.n_ids, magic = _TAIL.unpack(file.read_at(_TAIL.size, size - _TAIL.size))
        if magic != MAGIC or file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a token file, or one that was cut off")
        footer = file.read_at(size - _TAIL.size - at, at)
        self.entries = np.frombuffer(footer, _ENTRY, n_blocks)
        self.docs = np.frombuffer(footer, _DOC, n_docs, n_blocks * _ENTRY.itemsize)

    def blocks(self, first: int, stop: int) -> np.ndarray:
        """The ids of the blocks ``first`` to ``stop``, which are read in one piece."""
        entries = self.entries[first:stop]
        if not len(entries):
            return np.zeros(0, np.uint64)
        start, last = int(entries["offset"][0]), entries[-1]
        data = self.file.read_at(int(last["offset"]) + 8 * int(last["words"]) + 10 * int(last["escapes"]) - start, start)
        words, values, places = [], [], []
        for offset, n, k in entries.tolist():
            at = offset - start
            words.append(np.frombuffer(data, "<u8", n, at))
            if k:
                values.append(np.frombuffer(data, "<u8", k, at + 8 * n))
                places.append(np.frombuffer(data, "<u2", k, at + 8 * (n + k)))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        sizes = np.minimum(BLOCK, self.n_ids - np.arange(first, first + len(entries)) * BLOCK)
        return simple8b.decode(Blocks(join(words, np.uint64), entries["words"].astype(np.int64), join(places, np.uint16), join(values, np.uint64), entries["escapes"].astype(np.int64)), sizes)

    def ids(self, first: int, stop: int) -> np.ndarray:
        """The ids from place ``first`` to ``stop`` of the file: only their blocks are read."""
        stop = min(stop, self.n_ids)
        if first >= stop:
            return np.zeros(0, np.uint64)
        block = first // BLOCK
        return self.blocks(block, -(-stop // BLOCK))[first - block * BLOCK:stop - block * BLOCK]


@dataclass
class Written(WriterCommitMessage):
    file: dict | None


def given_ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a batch one after another, and how many each document has."""
    ids = batch.column("ids")
    if ids.null_count:
        raise ValueError("ids must not be null")
    ends = np.frombuffer(ids.buffers()[1], np.int64 if pa.types.is_large_binary(ids.type) else np.int32)[ids.offset:ids.offset + len(ids) + 1].astype(np.int64)
    return np.frombuffer(ids.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]].view("<u4"), np.diff(ends) // 4


class Writer(DataSourceArrowWriter):
    """Columns doc_id and either ids (little-endian unsigned 32-bit) or, with a tokenizer's file, text, which the task
    encodes. The partitions are in order, and so are their rows."""

    def __init__(self, path: str, tokenizer: str | None, end_id: int) -> None:
        self.path, self.tokenizer, self.end_id = path, tokenizer, end_id

    def coded(self, batch: pa.RecordBatch) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        if self.tokenizer is None:
            ids, tokens = given_ids(batch)
            yield batch.column("doc_id").to_pylist(), tokens, ids
            return
        for run in runs(batch, "text", RUN_BYTES):
            ids, ends = word_ids(self.tokenizer).encode(run.column("text").to_pylist(), self.end_id)
            yield run.column("doc_id").to_pylist(), np.diff(ends, prepend=0), ids

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = place(self.path)
        part, writer, out = TaskContext.get().partitionId(), None, None
        name = f"part-{part:06d}-{uuid.uuid4().hex}.s8b"
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                fs.create_dir(folder, recursive=True)
                out = fs.open_output_stream(f"{folder}/{name}")
                writer = FileWriter(out)
            for doc_ids, tokens, ids in self.coded(batch):
                writer.add(doc_ids, tokens, ids)
        if writer is None:
            return Written(None)
        writer.close()
        out.close()
        return Written({"part": part, "name": name, "documents": sum(map(len, writer.docs)), "ids": writer.n_ids})

    def commit(self, messages) -> None:
        fs, folder = place(self.path)
        files = sorted((m.file for m in messages if m is not None and m.file), key=lambda f: f["part"])
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/{LISTING}.new") as out:
            out.write(json.dumps(files).encode())
        fs.move(f"{folder}/{LISTING}.new", f"{folder}/{LISTING}")

    def abort(self, messages) -> None:
        fs, folder = place(self.path)
        for m in messages:
            if m is not None and m.file:
                fs.delete_file(f"{folder}/{m.file['name']}")


@dataclass
class Part(InputPartition):
    name: str
    start: int


class Reader(DataSourceReader):
    def __init__(self, path: str, ids: bool) -> None:
        self.path, self.with_ids = path, ids

    def partitions(self) -> list[Part]:
        fs, folder = place(self.path)
        with fs.open_input_stream(f"{folder}/{LISTING}") as listing:
            files = json.loads(listing.read())
        out, start = [], 0
        for f in files:
            out.append(Part(f["name"], start))
            start += f["ids"]
        return out or [Part("", 0)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        fs, folder = place(self.path)
        with fs.open_input_file(f"{folder}/{partition.name}") as file:
            yield from document_rows(FileReader(file), partition.start, self.with_ids)


def document_rows(file: FileReader, start: int, with_ids: bool = False) -> Iterator[pa.RecordBatch]:
    """Per document: doc_id, start, n_tokens, ids_crc32 (and ids). The checksum goes on from one run of blocks to the
    next, so that memory follows the run and not the document."""
    ends = np.cumsum(file.docs["tokens"].astype(np.int64))
    doc, check, held = 0, 0, []
    rows: dict[str, list] = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []} | ({"ids": []} if with_ids else {})

    def batch() -> pa.RecordBatch:
        kinds = {"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids_crc32": pa.int64(), "ids": pa.binary()}
        out = pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for k, v in rows.items()], names=list(rows))
        for v in rows.values():
            v.clear()
        return out

    for block in range(0, max(1, len(file.entries)), STEP):
        ids = file.blocks(block, block + STEP).astype("<u4")
        base, at = block * BLOCK, 0
        while doc < len(ends) and (at < len(ids) or ends[doc] == base + at):
            stop = min(int(ends[doc]) - base, len(ids))
            part = ids[at:stop]
            check = zlib.crc32(part, check)
            if with_ids:
                held.append(part.tobytes())
            at = stop
            if base + at < ends[doc]:
                break
            d, tokens = file.docs[doc], int(file.docs["tokens"][doc])
            rows["doc_id"].append(int(d["doc_id"]) if d["known"] else None)
            rows["start"].append(start + int(ends[doc]) - tokens)
            rows["n_tokens"].append(tokens)
            rows["ids_crc32"].append(check)
            if with_ids:
                rows["ids"].append(b"".join(held))
            doc, check, held = doc + 1, 0, []
        yield batch()


class Simple8bSource(DataSource):
    """``spark.read.format("simple8b").option("ids", "true").load(path)`` and the writer for it."""

    @classmethod
    def name(cls) -> str:
        return "simple8b"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if self.with_ids() else "")

    def with_ids(self) -> bool:
        return str(self.options.get("ids", "false")).lower() == "true"

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"], self.with_ids())

    def writer(self, schema, overwrite: bool) -> Writer:
        fs, folder = place(self.options["path"])
        if fs.get_file_info(f"{folder}/{LISTING}").type != pafs.FileType.NotFound:
            raise ValueError(f"{folder} holds token files already")
        return Writer(self.options["path"], self.options.get("tokenizer"), int(self.options.get("end_id", END_ID)))


def in_order(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id and text in partitions of about ``range_bytes`` of text, in ascending order."""
    rows = pick(docs, doc_id="long", text="string")
    size = rows.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 16).alias("size")).first()["size"] or 0
    # the last one only splits rows that are equal throughout
    tied = rows.withColumn("__tie", F.xxhash64("text")).withColumn("__row", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), "__tie", "__row"]
    return tied.repartitionByRange(max(1, -(-size // range_bytes)), *order).sortWithinPartitions(*order).select("doc_id", "text")


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, range_bytes: int = RANGE_BYTES) -> None:
    """Encode every text, with ``end_id`` behind it, and write the files below ``path``, a folder that driver and
    executors share."""
    spark = docs.sparkSession
    ship_package(spark)
    bounded_batches(spark)
    spark.dataSource.register(Simple8bSource)
    in_order(docs, range_bytes).write.format("simple8b").option("tokenizer", tokenizer).option("end_id", end_id).mode("append").save(path)


def read(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 and, if ``ids``, the ids."""
    ship_package(spark)
    spark.dataSource.register(Simple8bSource)
    return spark.read.format("simple8b").option("ids", str(ids).lower()).load(path)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """The documents written to scratch files and read back."""
    path = scratch_path(docs.sparkSession, "tokens")
    write(docs, path, tokenizer, end_id)
    return read(docs.sparkSession, path)
