"""The pipeline against a plain version of its five stages, one after another."""

import os
import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from riverbed.llm import langid, quality
from riverbed.llm.common import LEAN_BYTES, LEAN_ROWS
from tests.llm.fixtures import DOCS, empty, frame, prose, rows
from tests.llm.test_neardup import brute as classes
from tests.llm.test_neardup import edited
from tests.llm.test_packing import check_places
from tests.llm.test_secretscan import brute as secret_spans
from tokenizers import Tokenizer


def corpus():
    good = [(i, prose(i, 90 + 5 * i, ["en", "de", "fr"][i % 3]), ["en", "de", "fr"][i % 3], f"s{i % 2}", 1) for i in range(40)]
    good[7] = (7, good[7][1] + ' token = "0123456789abcdef01234567" and password: hunter22', "de", "s", 1)
    near = [(200 + i, edited(good[i][1], 1, i), good[i][2], "s", 1) for i in range(0, 40, 4)]
    junk = [(300 + i, " ".join(w + "%%%" for w in prose(400 + i, 120).split()), "en", "s", 1) for i in range(6)]
    odd = [(None if r[0] is None else 1000 + r[0], *r[1:]) for r in rows()]
    return good + near + junk + odd + [good[3], good[3]]


def plain(data):
    measured = [quality.measure(r[1]) for r in data]
    model = quality.fit(dict(Counter(quality.pattern(quality.votes(m)) for m in measured)))
    docs = [r for r, m in zip(data, measured) if not m.base_failed and model.posterior(quality.votes(m)) >= 0.5]
    learned = [r for r in docs if r[2] is not None and not (r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0)]
    names = sorted({r[2] for r in learned})
    by_id = lambda r: (r[0] is None, r[0] or 0, r[1])
    compressors = langid.Compressors(tuple((n, langid.assemble([r[1][:langid.DICTIONARY_BYTES // 8] for r in sorted(learned, key=by_id) if r[2] == n])) for n in names))
    docs = [r for r in docs if compressors.predict(r[1])[2]]
    least = {}
    for (doc_id, class_id, size), n in classes(docs).items():
        least.setdefault(doc_id, class_id)
    seen, kept = set(), []
    for r in docs:
        if least[r[0]] == r[0] and r[0] not in seen:
            seen.add(r[0])
            kept.append(r)
    out = []
    for r in kept:
        text, done, parts = r[1], 0, []
        for span in filter(None, secret_spans(text).split(",")):
            kind, a, b = span.split(":")
            a, b = int(a), int(b)
            if kind == "assign":
                a += len(re.match(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", text[a:], re.I)[0])
            if a >= done:
                parts += [text[done:a], "[SECRET]"]
            done = max(done, b)
        out.append((r[0], "".join(parts) + text[done:]))
    return out


def test_rows_equal_the_plain_version(spark, tmpdir_path):
    data = corpus()
    frame(spark, data).repartition(3).write.parquet(os.path.join(tmpdir_path, "documents.parquet"))
    got = corpus_pipeline.run(spark, tmpdir_path).collect()
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    want = Counter()
    for doc_id, text in plain(data):
        ids = t.encode(text, add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            want[doc_id, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((g.doc_id, g.piece, g.start, g.length, g.ids_crc32) for g in got) == want
    assert len(check_places(got, 2048)) <= -(-sum(g.length for g in got) // 2048) + 1
    ids = {g.doc_id for g in got}
    assert set(range(40)) <= ids and not ids & set(range(200, 310))  # clean documents stay; copies and junk go


def test_stages_keep_the_columns(spark):
    df = frame(spark, corpus(), extra=True)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, "")
        assert df.columns[:5] == [f.name for f in DOCS.fields], name
    none = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "").count() == 0


BATCHES = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")


@pytest.fixture
def batches(spark):
    """The session's batches as they are at first, and put back afterwards."""
    had = {k: spark.conf.get(k) for k in BATCHES}
    for k in BATCHES:
        spark.conf.unset(k)
    yield BATCHES
    for k, v in had.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_every_stage_reads_in_small_batches(spark, tmpdir_path, batches, name, stage):
    path = os.path.join(tmpdir_path, "texts.parquet")
    spark.range(0, 2000, 1, 1).selectExpr("id", "repeat(sha2(string(id), 256), 64) AS text").write.parquet(path)
    stage(spark, empty(spark), "")

    def sizes(got):
        import pyarrow as pa
        for b in got:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "size": [b.nbytes]})

    got = spark.read.parquet(path).mapInArrow(sizes, "rows long, size long").collect()
    assert sum(g.rows for g in got) == 2000 and max(g.size for g in got) <= 1.1 * LEAN_BYTES
    assert spark.conf.get(batches[1]) == str(LEAN_ROWS)


def test_smaller_batches_stay(spark, batches):
    for k in batches:
        spark.conf.set(k, "100")
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, empty(spark), "")
    assert [spark.conf.get(k) for k in batches] == ["100", "100"]
