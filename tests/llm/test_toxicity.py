import numpy as np
from riverbed.llm import toxicity
from tests.llm.fixtures import empty, frame, prose, rows

LABELS = "doc_id long, toxic int"
INSULTS = ("dolt", "oaf", "twit", "lout")
CONTEMPT = ("rotten", "vile", "foul")


def data(n=160):
    out, labels = [], []
    for i in range(n):
        text = prose(i, 80)
        toxic = i % 5 == 0
        if toxic:
            w = text.split(" ")
            w.insert(7, INSULTS[i % 4])
            w.insert(30, CONTEMPT[i % 3])
            text = " ".join(w)
        out.append((i, text, "en", "s", 1))
        labels.append((i, int(toxic)))
    return out, labels


def test_unseen_toxic_texts_are_found_and_clean_ones_left_alone(spark):
    docs, labels = data()
    got = {r.doc_id: r for r in toxicity.classify(frame(spark, docs, extra=True), spark.createDataFrame(labels[:100], LABELS)).collect()}
    assert [got[i].toxic for i in range(160)] == [i % 5 == 0 for i in range(160)]
    assert all(0 <= p <= 1 for r in got.values() for p in (r.p_low_quality, r.p_explicit, r.p_toxic))


def test_quality_labels_are_a_category_of_their_own(spark):
    docs, labels = data()
    docs = [(i, t + " ### junk mark" * (3 if i % 7 == 3 else 0), *rest) for i, t, *rest in docs]
    marks = spark.createDataFrame([(i, x, int(i % 7 != 3)) for i, x in labels], LABELS + ", quality int")
    got = {r.doc_id: r for r in toxicity.classify(frame(spark, docs), marks.where("doc_id < 110")).collect()}
    assert [got[i].toxic for i in range(160)] == [i % 5 == 0 for i in range(160)]
    assert [got[i].p_low_quality >= 0.5 for i in range(160)] == [i % 7 == 3 for i in range(160)]
    assert [got[i].p_explicit >= 0.5 for i in range(160)] == [i % 5 == 0 for i in range(160)]


def test_the_sample_is_bounded(spark):
    docs, labels = data()
    marks = spark.createDataFrame(labels, LABELS)
    a, b = (toxicity.learn(frame(spark, docs), marks, n) for n in (160, 10_000))
    assert a.weights == b.weights and toxicity.learn(frame(spark, docs), marks, 40).weights != a.weights


def test_later_models_use_the_probabilities_of_earlier_ones():
    """The last category can only be told from the first one's evidence and from the chain."""
    rng = np.random.default_rng(1)
    texts = [{"w$": 1.0} if k else {} for k in rng.integers(0, 2, 200)]
    y = np.array([1.0 if t else 0.0 for t in texts])
    chain = toxicity.fit(texts, {"a": y, "b": y.copy()}, np.arange(200) % 4)
    assert chain.categories == ("a", "b") and len(chain.earlier[0]) == 0 and len(chain.earlier[1]) == 1 and chain.earlier[1][0] > 0.1
    p = chain.probabilities({"w": 1}, {})
    assert p[0] > 0.5 and p[1] > 0.5 and max(chain.probabilities({"v": 1}, {})) < 0.5


def test_training_probabilities_are_out_of_fold(monkeypatch):
    """A model that saw its own row would be sure of a feature that only that row has."""
    seen = []
    real = toxicity._logistic

    def spy(rows, cols, values, dense, y, width, **more):
        seen.append(len(y))
        return real(rows, cols, values, dense, y, width, **more)

    monkeypatch.setattr(toxicity, "_logistic", spy)
    texts = [{"w$": 1.0} if i % 2 else {"v$": 1.0} for i in range(40)]
    y = np.array([float(i % 2) for i in range(40)])
    toxicity.fit(texts, {"a": y, "b": y}, np.arange(40) % 4)
    assert seen == [40, 30, 30, 30, 30] * 2


def test_special_cases(spark):
    docs = frame(spark, extra=True)
    none = toxicity.classify(docs, spark.createDataFrame([], LABELS)).collect()
    assert len(none) == len(rows()) and not any(r.toxic for r in none)
    some = toxicity.classify(docs, spark.createDataFrame([(0, 1), (0, 0), (3, None), (None, 1), (5, 0), (10**9, 1)], LABELS))
    assert some.count() == len(rows())
    assert toxicity.classify(empty(spark), spark.createDataFrame([(0, 1)], LABELS)).count() == 0
