"""Quality rules by weak supervision.

Every rule looks at a few measures of a text and votes good (1), bad (-1) or abstains (0). No
rule is trusted outright: expectation-maximisation over the votes of the whole corpus estimates
how often each rule gives each vote on good and on bad documents, and a document is kept when
the posterior probability that it is good reaches a threshold.

With R rules there are at most 3**R vote patterns, so that the corpus enters the estimation as a
count per pattern: one partial aggregation over all documents, a bounded number of rows to the
driver, and exact sums over every document.

Special cases: a null or empty text has no words, every measure is 0 and its base verdict is
failed; repeated rows are judged one by one, each counts (equal texts get equal verdicts); long texts are measured whole; without documents the model is its
prior. Columns besides the ones named are ignored by :func:`judge` and handed on by
:func:`keep_good`."""

from __future__ import annotations

from dataclasses import dataclass
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import arrow_pass, pick
from riverbed.session import cut_lineage

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
RULES = ("symbols", "marked", "bare", "upper", "shout", "repeats", "lines", "variety", "word_length")
#: What a rule is taken to do before it has seen a document: rows good, bad; columns votes bad, abstain, good.
PRIOR = np.array([[0.005, 0.145, 0.85], [0.35, 0.25, 0.40]])
#: Weight of the prior, as a share of the corpus.
PRIOR_SHARE = 0.05
PRIOR_GOOD = 0.90
#: Most that a rule may vote bad on good documents. The rules are written for that; the bound keeps
#: estimation from explaining a whole kind of junk, on which one rule only speaks, as good.
FALSE_ALARMS = 0.005
#: Words of a stretch; how varied a text's words are is told within its stretches, so that a long text counts like a short one.
STRETCH = 1000
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"

_SPACE = re.compile(r"[\x20\x09-\x0D]")
_MARKS = re.compile(r"[#*$%&|<>]+")


def repeated(words: list[bytes]) -> int:
    """Words that stand in a window of three words which occurs twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    _, pair = np.unique(a[:-1] * len(ids) + a[1:], return_inverse=True)
    _, triple, often = np.unique(pair[:-1] * len(ids) + a[2:], return_inverse=True, return_counts=True)
    twice = often[triple] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= twice
    return int(covered.sum())


def dup_lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and all lines with a word."""
    seen: set[str] = set()
    again = lines = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            lines += 1
            if line in seen:
                again += 1
            seen.add(line)
    return again, lines


@dataclass(frozen=True)
class Measured:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    lines: int
    letters: int
    upper: int
    marks: int
    bare: int
    shouts: int
    distinct: int

    @property
    def base_failed(self) -> bool:
        return self.n_words < 50 or 100 * self.n_repeat_words > 50 * self.n_words


def measure(text: str | None) -> Measured:
    text = text or ""
    # bytes.split() parts at exactly the six ASCII white space characters
    words = text.encode("utf-8", "surrogatepass").split()
    again, lines = dup_lines(text)
    upper = sum(map(str.isupper, text))
    letters = upper + sum(map(str.islower, text))
    return Measured(
        n_words=len(words),
        word_chars=len(text) - len(_SPACE.findall(text)),
        n_symbols=sum(map(text.count, SYMBOLS)),
        n_dup_lines=again,
        n_repeat_words=repeated(words),
        lines=lines,
        letters=letters,
        upper=upper,
        marks=len(_MARKS.findall(text)),
        bare=sum(1 for w in words if len(w) < 4 and not any(48 <= b < 58 or b > 64 and b not in b"[\\]^_`{|}~" for b in w)),
        shouts=text.count("!!") + text.count("??"),
        distinct=sum(len(set(words[i:i + STRETCH])) for i in range(0, len(words), STRETCH)),
    )


def _vote(value: float, good_to: float, bad_from: float) -> int:
    return 1 if value <= good_to else -1 if value >= bad_from else 0


def votes(m: Measured) -> tuple[int, ...]:
    """One vote per rule, in the order of RULES. The absence of one kind of junk says little for
    a text, so that most rules vote bad or abstain; three speak for a text as well."""
    n = max(1, m.n_words)
    alarm = lambda bad: -1 if bad else 0
    return (
        _vote(m.n_symbols / max(1, m.word_chars), 0.02, 0.08),
        alarm(m.marks >= 0.30 * n),
        alarm(m.bare >= 0.25 * n),
        0 if m.letters < 40 else _vote(m.upper / m.letters, 0.20, 0.50),
        alarm(m.shouts >= 0.20 * n),
        0 if m.n_words < 20 else _vote(m.n_repeat_words / n, 0.10, 0.40),
        alarm(m.lines >= 4 and m.n_dup_lines >= 0.40 * m.lines),
        alarm(m.n_words >= 50 and m.distinct < 0.10 * n),
        alarm(m.n_words and not 2.5 <= m.word_chars / n <= 14),
    )


def pattern(v: tuple[int, ...]) -> int:
    """The votes as one number, base 3."""
    code = 0
    for x in v:
        code = code * 3 + x + 1
    return code


def unpack(code: int) -> tuple[int, ...]:
    out = []
    for _ in RULES:
        out.append(code % 3 - 1)
        code //= 3
    return tuple(reversed(out))


@dataclass(frozen=True)
class LabelModel:
    """p_good: share of good documents; given[rule][y][vote + 1]: how often the rule gives the
    vote on good (y = 0) and on bad (y = 1) documents."""

    p_good: float
    given: np.ndarray

    def posterior(self, v: tuple[int, ...]) -> float:
        at = np.log([self.p_good, 1 - self.p_good])
        for r, x in enumerate(v):
            at = at + np.log(self.given[r, :, x + 1])
        at = np.exp(at - at.max())
        return float(at[0] / at.sum())


def fit(counts: dict[int, int], rounds: int = 100, tolerance: float = 1e-9) -> LabelModel:
    """Expectation-maximisation over the counts of vote patterns, from the prior, with the prior
    as pseudo-counts, so that good and bad can't change places."""
    codes = sorted(counts)
    given = np.repeat(PRIOR[None], len(RULES), 0).copy()
    p = PRIOR_GOOD
    if not codes:
        return LabelModel(p, given)
    n = np.array([counts[c] for c in codes], float)
    cast = np.array([unpack(c) for c in codes]) + 1
    onehot = np.eye(3)[cast]  # pattern, rule, vote
    pseudo = PRIOR_SHARE * n.sum() + 1.0
    before = -np.inf
    for _ in range(rounds):
        logs = np.log([p, 1 - p])[None] + np.einsum("irv,ryv->iy", onehot, np.log(given))
        top = logs.max(1, keepdims=True)
        total = top[:, 0] + np.log(np.exp(logs - top).sum(1))
        resp = np.exp(logs - total[:, None]) * n[:, None]
        sums = np.einsum("iy,irv->ryv", resp, onehot) + pseudo * PRIOR[None] * np.array([PRIOR_GOOD, 1 - PRIOR_GOOD])[None, :, None]
        given = sums / sums.sum(2, keepdims=True)
        given[:, 0, 0] = np.minimum(given[:, 0, 0], FALSE_ALARMS)
        given /= given.sum(2, keepdims=True)
        good = resp[:, 0].sum() + pseudo * PRIOR_GOOD
        p = float(good / (n.sum() + pseudo))
        now = float((total * n).sum())
        if abs(now - before) <= tolerance * abs(now):
            break
        before = now
    return LabelModel(p, given)


def _measure_rows(columns: dict[str, list]) -> dict[str, list]:
    got = [measure(t) for t in columns["text"]]
    return {
        "n_words": [m.n_words for m in got], "word_chars": [m.word_chars for m in got],
        "n_symbols": [m.n_symbols for m in got], "n_dup_lines": [m.n_dup_lines for m in got],
        "n_repeat_words": [m.n_repeat_words for m in got], "base_failed": [m.base_failed for m in got],
        "pattern": [pattern(votes(m)) for m in got],
    }


def measured(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The measures and the vote pattern of each document."""
    return arrow_pass(docs.select(*keep, F.col("text").cast("string").alias("text")), _measure_rows,
                      MEASURES + ", base_failed boolean, pattern int", keep=keep)


def fitted(patterns: DataFrame) -> LabelModel:
    """The label model of a frame with a column ``pattern``; at most 3**len(RULES) rows are
    gathered, whatever the size of the frame."""
    return fit({r["pattern"]: r["n"] for r in patterns.groupBy("pattern").agg(F.count("*").alias("n")).collect()})


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per document: the measures, base_failed, the posterior quality and kept."""
    # one small row per document: the texts are read once, for the model and for the verdicts
    rows = cut_lineage(measured(pick(docs, doc_id="long", text="string")), "quality")
    model = fitted(rows)
    verdicts = rows.sparkSession.createDataFrame(
        [(c, model.posterior(unpack(c))) for c in range(3 ** len(RULES))], "pattern int, quality double")
    return (rows.join(F.broadcast(verdicts), "pattern")  # 3**9 rows
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)).drop("pattern"))


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that pass, with all their columns. The votes are cast twice, once for the
    model and once for the verdict: cheaper than to write the texts in between."""
    model = fitted(measured(docs, ()))
    verdict = {c: model.posterior(unpack(c)) >= threshold for c in range(3 ** len(RULES))}

    def chosen(columns: dict[str, list]) -> dict[str, list]:
        stay = []
        for i, t in enumerate(columns["text"]):
            m = measure(t)
            if not m.base_failed and verdict[pattern(votes(m))]:
                stay.append(i)
        return {"*": stay}

    return arrow_pass(docs, chosen, "", keep=docs.columns)
