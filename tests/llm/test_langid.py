import zlib

from riverbed.llm import langid
from tests.llm.fixtures import empty, frame, prose, rows


def test_every_row_gets_a_learned_language_or_und(spark):
    got = langid.identify(frame(spark, extra=True)).collect()
    assert len(got) == len(rows())
    for g in got:
        assert 0 <= g.score <= 1 and g.lang_pred in {"en", "de", "fr", "und"}
        assert g.held_out == (g.doc_id is not None and zlib.crc32(str(g.doc_id).encode()) % 5 == 0)
    by = {}
    for g in got:
        by.setdefault(g.doc_id, g)
    for i, t, *_ in rows():
        letters = t is not None and any(c.isalpha() for c in t)
        assert (by[i].lang_pred == "und") == (not letters)


def test_held_out_accuracy(spark):
    data = [(i, prose(i, 80, lang), lang, "s", 1) for i, lang in enumerate(["en", "de", "fr"] * 60)]
    got = [r for r in langid.identify(frame(spark, data)).collect() if r.held_out]
    assert len(got) > 20
    assert sum(r.lang_pred == ["en", "de", "fr"][r.doc_id % 3] for r in got) >= 0.97 * len(got)


def test_labels_of_held_out_rows_are_not_learned_from(spark):
    data = [(i, prose(i, 80), "en", "s", 1) for i in range(40)]
    data = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, s, n) for i, t, lang, s, n in data]
    assert {r.lang_pred for r in langid.identify(frame(spark, data)).collect()} == {"en"}


def test_narrow_margins_are_rejected():
    model = langid.Compressors((("a", b"the harbour in the morning " * 40), ("b", b"the harbour in the morning " * 40)))
    assert not model.predict("the harbour in the morning")[2]
    assert langid.Compressors(()).predict("text") == ("und", 0.0, False)


def test_filter_keeps_columns_and_empty_table(spark):
    kept = langid.keep_known(frame(spark, extra=True))
    assert kept.columns == frame(spark, extra=True).columns and kept.count() >= 30
    assert langid.identify(empty(spark)).count() == 0 and langid.keep_known(empty(spark)).count() == 0
