"""Small documents with the cases that every operator must stand."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()))])

VOCABULARY = {
    "en": "the of and to in is that with for was on are by this from harbour morning letter garden window winter answer question river market".split(),
    "de": "der die und das ist nicht mit auf für von ein zu Straße Garten Fenster Winter Antwort Frage Fluss Markt schön über größer".split(),
    "fr": "le la les et des que pour dans est une avec sur jardin fenêtre hiver réponse été rivière marché être où très leçon".split(),
}


def prose(seed: int, words: int, lang: str = "en") -> str:
    r = random.Random(seed)
    out, line = [], []
    for i in range(words):
        w = r.choice(VOCABULARY[lang]) + r.choice(["", "", "ly", "er", "ing", str(r.randrange(10)) if r.random() < 0.02 else "s"])
        line.append(w + ("." if r.random() < 0.1 else ""))
        if r.random() < 0.05:
            out.append(" ".join(line))
            line = []
    return "\n".join([*out, " ".join(line)])


def rows():
    """(doc_id, text, lang, source, n_chars)"""
    texts = [(prose(i, 60 + 11 * i, lang), lang) for i, lang in enumerate(["en", "de", "fr"] * 10)]
    texts += [
        (None, None), ("", "en"), (" \n\t ", "en"), ("one", "en"), ("12 34 !?", None),
        (prose(500, 6000), "en"), (prose(500, 6000), "en"),  # long, twice
        ("  two  spaces\tand   tabs \n\n and　wide ", "en"), ("x" * 30_000, "en"),
        ("a\x1cb c\x85d e​f ﷐g 😀 \r\n h", "en"),
        ("same words here again " * 40, "en"),
    ]
    out = [(i, t, lang, f"s{i % 3}", None if t is None else len(t)) for i, (t, lang) in enumerate(texts)]
    out += [out[3], out[3], (None, "no id here, but a text of some words", "en", None, 1), (900, texts[4][0], "de", "s", 3)]
    return out


def frame(spark, data=None, extra=False):
    """The documents as a frame; with ``extra`` also columns whose names operators use."""
    df = spark.createDataFrame(rows() if data is None else data, DOCS)
    if extra:
        from pyspark.sql import functions as F
        for name in ("piece", "length", "key", "bands", "spans", "kept", "pattern", "range", "score", "label", "n_words", "base", "salt", "rank"):
            df = df.withColumn(name, F.lit("clash"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)
