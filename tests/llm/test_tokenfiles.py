import glob
import json
import os
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.fs as pafs
import pytest
from riverbed.llm import tokenfiles
from tests.llm.fixtures import empty, frame, prose, rows
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain(data):
    """(doc_id, n_tokens, ids_crc32) of each document by the library itself."""
    t = Tokenizer.from_file(PATH)
    out = []
    for i, text, *_ in data:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, len(ids), zlib.crc32(ids.tobytes())))
    return out


def check(got, data):
    assert Counter((g.doc_id, g.n_tokens, g.ids_crc32) for g in got) == Counter(plain(data))
    at = 0
    for g in sorted(got, key=lambda g: g.start):
        assert g.start == at
        at += g.n_tokens
    ids = [g.doc_id for g in sorted(got, key=lambda g: g.start)]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))


def test_documents_come_back(spark):
    check(tokenfiles.round_trip(frame(spark, extra=True), PATH).collect(), rows())


def test_many_files_and_a_hot_id(spark, tmpdir_path):
    """A third of all rows has one id and one text; still they are dealt over files, in order."""
    data = [(7, "the same text for all of them", "en", "s", 1)] * 400 + [(i, prose(i, 20), "en", "s", 1) for i in range(800)]
    path = os.path.join(tmpdir_path, "files")
    tokenfiles.write(frame(spark, data).repartition(6), path, PATH, range_bytes=8_000)
    got = tokenfiles.read(spark, path, ids=True).collect()
    check(got, data)
    with open(f"{path}/{tokenfiles.LISTING}") as listing:
        files = json.load(listing)
    assert len(files) > 5 and max(f["documents"] for f in files) < 400
    assert sum(f["ids"] for f in files) == sum(g.n_tokens for g in got)
    for g in got:
        assert zlib.crc32(g.ids) == g.ids_crc32 and len(g.ids) == 4 * g.n_tokens
    # any run of ids is found by the offsets
    whole = np.concatenate([np.frombuffer(g.ids, "<u4") for g in sorted(got, key=lambda g: g.start)])
    start = 0
    for f in files:
        with pafs.LocalFileSystem().open_input_file(f"{path}/{f['name']}") as file:
            reader = tokenfiles.FileReader(file)
            for a, b in ((0, 3), (5, 5), (f["ids"] // 2, f["ids"]), (f["ids"] - 1, f["ids"] + 9)):
                assert reader.ids(a, b).tolist() == whole[start:start + f["ids"]][a:b].tolist()
        start += f["ids"]


def test_documents_longer_than_a_step(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(tokenfiles, "STEP", 2)
    out = os.path.join(tmpdir_path, "one.s8b")
    rng = np.random.default_rng(1)
    docs = [(1, 30_000), (2, 0), (None, 1), (4, 8192), (5, 8192), (6, 3), (7, 0)]
    ids = rng.integers(0, 49_408, sum(n for _, n in docs)).astype("<u4")
    with open(out, "wb") as file:
        writer = tokenfiles.FileWriter(file)
        writer.add([d for d, _ in docs], np.array([n for _, n in docs]), ids)
        writer.close()
    with pafs.LocalFileSystem().open_input_file(out) as file:
        got = [r for b in tokenfiles.document_rows(tokenfiles.FileReader(file), 100, True) for r in b.to_pylist()]
    assert [(g["doc_id"], g["n_tokens"]) for g in got] == docs
    assert b"".join(g["ids"] for g in got) == ids.tobytes()
    assert [g["start"] for g in got] == (100 + np.cumsum([0, *(n for _, n in docs)])[:-1]).tolist()


def test_uncommitted_and_broken_files(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "files")
    data = rows()[:6]
    tokenfiles.write(frame(spark, data), path, PATH)
    with open(f"{path}/part-000000-lost.s8b", "wb") as lost:  # of a task that was repeated
        lost.write(b"S8B")
    check(tokenfiles.read(spark, path).collect(), data)
    with pytest.raises(Exception, match="already"):
        tokenfiles.write(frame(spark, data), path, PATH)
    for f in glob.glob(f"{path}/*.s8b"):
        with open(f, "r+b") as cut:
            cut.truncate(os.path.getsize(f) - 1)
    with pytest.raises(Exception, match="token file"):
        tokenfiles.read(spark, path).collect()


def test_ids_of_another_encoder(spark, tmpdir_path):
    """Ids can be given instead of texts, of any 32 bits."""
    path = os.path.join(tmpdir_path, "files")
    ids = [np.random.default_rng(i).integers(0, 1 << 32, 5 * i, np.uint64).astype("<u4").tobytes() for i in range(40)]
    spark.dataSource.register(tokenfiles.Simple8bSource)
    spark.createDataFrame(list(enumerate(ids)), "doc_id long, ids binary").coalesce(1).write.format("simple8b").mode("append").save(path)
    got = sorted(tokenfiles.read(spark, path, ids=True).collect())
    assert [bytes(g.ids) for g in got] == ids and [g.n_tokens for g in got] == [5 * i for i in range(40)]


def test_empty_table(spark):
    assert tokenfiles.round_trip(empty(spark), PATH).collect() == []
