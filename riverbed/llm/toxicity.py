"""Toxicity by a classifier chain.

Categories are predicted one after another. Each has a linear (logistic) model over the words
and word beginnings of a text and over the probabilities of the categories before it. For
training, those probabilities come from models that haven't seen the row (out-of-fold), as they
will for a new text; for prediction, from the models fitted on all training rows.

The categories come from the labels: low quality, then explicit (toxic with one of the words that are most typical of
toxic texts, which are counted, not listed), then toxic, whose evidence includes both.

The features are picked on the training rows by how much more often they stand in texts of a
category than in others: Spark counts the texts per feature, and only the picked ones of a text reach
the driver, where the small models are fitted. A word's features depend on the word alone, so that a worker computes
them once per distinct word (up to CACHE_WORDS) and a text's scores are sums over its words.

The models are fitted on a bounded sample of labelled documents (SAMPLE_DOCS); prediction
reads every document whole.

Special cases: a null or empty text has only the models' constant terms as evidence; a document
with several label rows counts as toxic and of low quality if one of them says so; labels without quality say nothing of it; without
labelled documents every probability is 0; a very long text is counted word by word, and what is held follows its distinct words; ties
among features are settled by their names; repeated rows are judged alike; an empty table gives none; columns that aren't named are
ignored."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import arrow_pass, hash_order, pick
from riverbed.session import cut_lineage

#: Labelled documents that the models are fitted on, at most.
SAMPLE_DOCS = 20_000
#: Features per category, at most.
FEATURES = 1500
FOLDS = 4
#: A feature stands in at least so many texts of a category, and is at least so many times as frequent there.
LEAST_TEXTS, LEAST_RATIO = 3, 4.0
#: Features that a step counts before it hands the counts on.
STEP_FEATURES = 150_000
CACHE_WORDS = 400_000
THRESHOLD = 0.5
CATEGORIES = ("low_quality", "explicit", "toxic")
#: Of them, those that are counted (the labels'); the words most typical of toxic texts that make one explicit.
COUNTED = ("low_quality", "toxic")
MARK_WORDS = 20

_WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> tuple[str, ...]:
    """The word itself and its beginnings."""
    return (word + "$", *(word[:k] for k in range(4, 9) if len(word) > k))


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


@dataclass(frozen=True)
class Chain:
    """weights: word feature -> one weight per category; bias per category; earlier[c]: weights of
    the log-odds of the categories before c."""

    categories: tuple[str, ...]
    weights: dict[str, tuple[float, ...]]
    bias: tuple[float, ...]
    earlier: tuple[tuple[float, ...], ...]

    def of_word(self, word: str):
        """The weights of a word's features, summed, or None."""
        got = [self.weights[f] for f in features(word) if f in self.weights]
        return tuple(map(sum, zip(*got))) if got else None

    def probabilities(self, counts: dict[str, int], cache: dict) -> list[float]:
        if not self.weights:
            return [0.0] * len(self.categories)
        sums = list(self.bias)
        for w, n in counts.items():
            if w in cache:
                got = cache[w]
            else:
                got = cache[w] = self.of_word(w)
            if got:
                by = 1.0 + np.log(n)
                for c, x in enumerate(got):
                    sums[c] += x * by
        out: list[float] = []
        for c, z in enumerate(sums):
            z += sum(w * p for w, p in zip(self.earlier[c], out))
            out.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
        return out


def strength(hit: int, texts: int, n1: int, n0: int) -> float:
    """The z score of a feature that stands in ``hit`` of ``n1`` texts of a category and in ``texts`` of
    all; 0 if it is too rare or not typical enough."""
    p1, p0 = (hit + 0.5) / (n1 + 1), (texts - hit + 0.5) / (n0 + 1)
    if hit < LEAST_TEXTS or p1 < LEAST_RATIO * p0:
        return 0.0
    p = texts / (n1 + n0)
    return (p1 - p0) / float(np.sqrt(p * (1 - p) * (1 / max(1, n1) + 1 / max(1, n0)) + 1e-12))


def strongest(counts: dict[str, tuple[int, int]], n1: int, n0: int) -> list[str]:
    """``counts``: feature -> (texts of the category, texts of all)."""
    scored = sorted((-strength(hit, texts, n1, n0), f) for f, (hit, texts) in counts.items())
    return [f for z, f in scored[:FEATURES] if z < 0]


def _pick_features(docs: list[dict[str, float]], y: np.ndarray) -> list[str]:
    of: dict[str, list[int]] = {}
    for d, t in zip(docs, y):
        for f in d:
            c = of.setdefault(f, [0, 0])
            c[0] += int(t)
            c[1] += 1
    return strongest({f: (a, b) for f, (a, b) in of.items()}, int(y.sum()), int((1 - y).sum()))


def _logistic(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, dense: np.ndarray, y: np.ndarray, width: int, rounds: int = 150, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression over sparse columns, dense columns and a constant (last), by
    accelerated gradient steps; the rarer class has the weight of the other."""
    n, extra = len(y), dense.shape[1]
    w, speed = np.zeros(width + extra + 1), np.zeros(width + extra + 1)
    weight = np.where(y == 1, min(20.0, max(1.0, (y == 0).sum() / max(1, (y == 1).sum()))), 1.0) / n
    scale = np.bincount(cols, values**2 * weight[rows], width) if len(cols) else np.zeros(width)
    step = 1.0 / (0.25 * np.concatenate([scale, (dense**2 * weight[:, None]).sum(0), [weight.sum()]]) * 8 + ridge * 8)
    for k in range(rounds):
        at = w + k / (k + 3) * speed
        z = dense @ at[width:width + extra] + at[-1]
        if len(rows):
            z = z + np.bincount(rows, values * at[cols], n)
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
        grad = np.concatenate([np.bincount(cols, values * g[rows], width) if len(cols) else np.zeros(width), dense.T @ g, [g.sum()]])
        grad[:-1] += ridge * at[:-1]
        new = at - step * grad
        speed, w = new - w, new
    return w


def _scores(w: np.ndarray, rows, cols, values, dense, n: int, width: int) -> np.ndarray:
    z = dense @ w[width:width + dense.shape[1]] + w[-1]
    return z + (np.bincount(rows, values * w[cols], n) if len(rows) else 0)


def fit(texts: list[dict[str, float]], targets: dict[str, np.ndarray], folds: np.ndarray, names: list[str] | None = None) -> Chain:
    """``texts``: feature -> value per training row; ``targets``: category -> 0/1 per row, in the
    order of the chain; ``folds``: the fold of each row; ``names``: the features to use, if they are
    picked already."""
    categories = tuple(targets)
    if not texts:
        return Chain(categories, {}, (0.0,) * len(categories), ((),) * len(categories))
    if names is None:
        names = sorted({f for y in targets.values() for f in _pick_features(texts, y)})
    index = {f: i for i, f in enumerate(names)}
    rows, cols, values = [], [], []
    for i, d in enumerate(texts):
        for f, v in d.items():
            if f in index:
                rows.append(i)
                cols.append(index[f])
                values.append(v)
    return fit_sparse(np.array(rows, np.int64), np.array(cols, np.int64), np.array(values, float), len(texts), targets, folds, names)


def fit_sparse(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, n: int, targets: dict[str, np.ndarray], folds: np.ndarray, names: list[str]) -> Chain:
    """``values`` of the features ``cols`` (places in ``names``) in the texts ``rows`` of ``n``."""
    categories = tuple(targets)
    weights, bias, earlier = [], [], []
    before = np.zeros((n, 0))  # out-of-fold probabilities of the categories so far
    for y in targets.values():
        full = _logistic(rows, cols, values, before, y, len(names))
        weights.append(full[:len(names)])
        earlier.append(tuple(full[len(names):-1]))
        bias.append(float(full[-1]))
        out = np.zeros(n)
        for f in range(int(folds.max()) + 1):
            here = folds == f
            if not here.any():
                continue
            seen = ~here
            inside = seen[rows]
            number = np.cumsum(seen) - 1
            part = _logistic(number[rows[inside]], cols[inside], values[inside], before[seen], y[seen], len(names))
            z = _scores(part, rows, cols, values, before, n, len(names))
            out[here] = (1 / (1 + np.exp(-np.clip(z, -30, 30))))[here]
        before = np.column_stack([before, out])
    table = np.array(weights).T
    return Chain(categories, {f: tuple(table[i]) for i, f in enumerate(names) if np.abs(table[i]).max() > 1e-4}, tuple(bias), tuple(earlier))


def _count(columns: dict[str, list]) -> dict[str, list]:
    """Texts per feature, all and of each counted category; the feature "" stands for the texts themselves."""
    out: dict[str, list] = {k: [] for k in ("feature", "texts", *COUNTED)}
    counts = [Counter() for _ in range(1 + len(COUNTED))]

    def hand_on() -> None:
        for f in counts[0]:
            out["feature"].append(f)
            for name, c in zip(("texts", *COUNTED), counts):
                out[name].append(c[f])
        for c in counts:
            c.clear()

    for text, low, toxic in zip(columns["text"], columns["low_quality"], columns["toxic"]):
        here = {f for w in set(words(text)) for f in features(w)} | {""}
        for c, yes in zip(counts, (1, low, toxic)):
            if yes:
                c.update(here)
        if len(counts[0]) > STEP_FEATURES:
            hand_on()
    hand_on()
    return out


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Chain:
    """``labels``: doc_id, toxic (0 or 1), and quality (0 or 1), if there is one."""
    marks = (pick(labels, doc_id="long", toxic="int", quality="int").where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
             .agg(F.max("toxic").alias("toxic"), F.coalesce(F.max((F.col("quality") == 0).cast("int")), F.lit(0)).alias("low_quality")))
    lot = hash_order("doc_id", 3)
    few = cut_lineage(marks.orderBy(lot, "doc_id").limit(sample_docs), "labelled")
    # sample_docs rows at most; their texts are written once
    rows = cut_lineage(pick(docs, doc_id="long", text="string").where("text IS NOT NULL").join(F.broadcast(few), "doc_id"), "labelled-texts")
    counted = arrow_pass(rows.select("text", "toxic", "low_quality"), _count, "feature string, texts long, " + ", ".join(f"{c} long" for c in COUNTED))
    sums = cut_lineage(counted.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("texts", *COUNTED)]), "features")
    total = sums.where("feature = ''").first()
    if total is None:
        return fit([], {c: np.zeros(0) for c in CATEGORIES}, np.zeros(0, np.int64))
    picked: dict[str, list[str]] = {}
    for c in COUNTED:
        n1, n0 = total[c], total["texts"] - total[c]
        typical = (F.col(c) >= LEAST_TEXTS) & ((F.col(c) + 0.5) / (n1 + 1) >= LEAST_RATIO * (F.col("texts") - F.col(c) + 0.5) / (n0 + 1)) & (F.col("feature") != "")
        kept = sums.where(typical).orderBy(F.desc(c), "feature").limit(20 * FEATURES).collect()
        picked[c] = strongest({r["feature"]: (r[c], r["texts"]) for r in kept}, n1, n0)
    names = sorted(set().union(*picked.values()))
    index = {f: i for i, f in enumerate(names)}
    explicit = frozenset([f[:-1] for f in picked["toxic"] if f.endswith("$")][:MARK_WORDS])

    def sparse(columns: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("explicit", "cols", "values")}
        for text, toxic in zip(columns["text"], columns["toxic"]):
            counts = Counter(words(text))
            d: dict[int, float] = {}
            for w, n in counts.items():
                for f in features(w):
                    if f in index:
                        d[index[f]] = d.get(index[f], 0.0) + 1.0 + float(np.log(n))
            out["explicit"].append(int(bool(toxic) and not explicit.isdisjoint(counts)))
            out["cols"].append(list(d))
            out["values"].append(list(d.values()))
        return out

    # sample_docs rows of a few numbers each
    got = arrow_pass(rows, sparse, "explicit int, cols array<int>, values array<float>", keep=("doc_id", "toxic", "low_quality"), reads=("toxic",)).toArrow().sort_by("doc_id").combine_chunks()
    n, cols, values = got.num_rows, got.column("cols").combine_chunks(), got.column("values").combine_chunks()
    at = np.repeat(np.arange(n), np.diff(cols.offsets.to_numpy()))
    targets = {c: got.column(c).to_numpy().astype(float) for c in CATEGORIES}
    folds = got.column("doc_id").to_numpy() % FOLDS
    return fit_sparse(at, cols.flatten().to_numpy().astype(np.int64), values.flatten().to_numpy().astype(float), n, targets, folds, names)


def predict(docs: DataFrame, model: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, a probability per category, toxic (the last one reaches the threshold)."""
    def work(columns: dict[str, list]) -> dict[str, list]:
        cache = _CACHE.setdefault(hash((model.bias, len(model.weights))), {})
        if len(cache) > CACHE_WORDS:
            cache.clear()
        got = []
        for t in columns["text"]:
            counts: dict[str, int] = {}
            for w in words(t):
                counts[w] = counts.get(w, 0) + 1
            got.append(model.probabilities(counts, cache))
        out = {f"p_{c}": [g[i] for g in got] for i, c in enumerate(model.categories)}
        return out | {"toxic": [g[-1] >= threshold for g in got]}

    made = ", ".join(f"p_{c} double" for c in model.categories) + ", toxic boolean"
    return arrow_pass(pick(docs, doc_id="long", text="string"), work, made, keep=("doc_id",))


_CACHE: dict[int, dict] = {}


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return predict(docs, learn(docs, labels))
