import re
from collections import Counter

from riverbed.llm import quality
from tests.llm.fixtures import empty, frame, prose, rows


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)
    windows = Counter(tuple(words[i:i + 3]) for i in range(n - 2))
    covered = {i + k for i in range(n - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n")]
    dup = sum(1 for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:i])
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_measures_match_the_definition(spark):
    got = quality.judge(frame(spark, extra=True)).collect()
    assert len(got) == len(rows())
    want = Counter((r[0], *brute(r[1])) for r in rows())
    assert Counter((g.doc_id, g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) for g in got) == want
    for g in got:
        assert g.base_failed == (g.n_words < 50 or 100 * g.n_repeat_words > 50 * g.n_words)
        assert not (g.kept and g.base_failed)


def test_junk_goes_and_prose_stays(spark):
    good = [(i, prose(i, 120), "en", "s", 1) for i in range(80)]
    junk = [(100 + i, " ".join(w + "###" for w in prose(900 + i, 120).split()), "en", "s", 1) for i in range(8)]
    junk += [(200 + i, " | ".join(prose(700 + i, 120).split()), "en", "s", 1) for i in range(8)]
    got = {r.doc_id: r for r in quality.judge(frame(spark, good + junk)).collect()}
    assert all(got[d].kept for d, *_ in good)
    assert not any(got[d].kept for d, *_ in junk)
    kept = quality.keep_good(frame(spark, good + junk, extra=True))
    assert kept.columns == frame(spark, extra=True).columns
    assert {r.doc_id for r in kept.collect()} == {d for d, *_ in good}


def test_label_model_recovers_what_rules_do():
    good, bad = quality.pattern((1, 0, 0, 1, 0, 1, 0, 0, 0)), quality.pattern((-1, -1, 0, 1, 0, 1, 0, 0, 0))
    model = quality.fit({good: 900, bad: 100})
    assert model.posterior(quality.unpack(good)) > 0.95 and model.posterior(quality.unpack(bad)) < 0.05
    assert quality.unpack(quality.pattern((1, 0, -1, 1, 0, -1, 0, 1, 0))) == (1, 0, -1, 1, 0, -1, 0, 1, 0)


def test_variety_does_not_depend_on_length():
    at = quality.RULES.index("variety")
    vote = lambda words: quality.votes(quality.measure(" ".join(words)))[at]
    few = [f"word{i * i % 61}" for i in range(20_000)]
    assert [vote(few[:n]) for n in (1000, 4999, 5000, 5001, 20_000)] == [-1] * 5
    varied = [f"w{i * 7919 % 400}" for i in range(20_000)]  # 400 words in all: a fiftieth of the text, two fifths of a stretch
    assert [vote(varied[:n]) for n in (1000, 4999, 5000, 20_000)] == [0] * 4


def test_empty_table(spark):
    assert quality.judge(empty(spark)).count() == 0
    assert quality.keep_good(empty(spark)).count() == 0
