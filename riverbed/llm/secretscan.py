"""Secret scans in DataFrame functions only.

Three patterns give base spans. Other long tokens are judged by whether they look drawn at random:
their encoding is inferred (hexadecimal, base 32, base 64), the characters become numbers in its
alphabet, and three tests of uniform randomness are made: chi-squared over equal parts of the
alphabet, runs above and below its middle, and serial correlation of neighbours. Fisher's method
makes one p value of them. Natural text fails these tests, keys pass.

Which tokens count as failed is decided by false-discovery control (Benjamini-Hochberg) within
strata of encoding and length, because a short token's tests have less power than a long one's: of the
tokens set aside as natural, a share of ALPHA at most is expected to be random. The p values enter
as counts per stratum and logarithmic bin, so that the control covers every token of the corpus
and gathers a bounded number of rows. Tokens that aren't set aside are added as ``random`` spans.

Positions come from the text itself: a match is wrapped in private-use characters (those that the
text has are exchanged for another one first, which changes neither lengths nor matches), the text is
split there, and the lengths of the parts add up to offsets in code points.

Special cases: a null or empty text has no spans and the digest of an empty list; repeated rows
give equal rows; spans of equal start are listed by kind; long texts are scanned whole; an empty table gives no rows; columns
besides doc_id and text are ignored by ``find``; without candidates nothing is set aside and nothing added. The chi-squared
test has 4 equal parts of the alphabet below 80 characters and 8 from there on, so that enough are expected in each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverbed.llm.common import pick
from riverbed.session import cut_lineage

#: Kind, pattern with a group for what stands before the secret and one for the secret itself, least
#: length of the latter. The kinds in the order in which spans of equal start are listed. A run
#: shorter than the least length can't be part of a longer match, except in ``assign``.
KINDS = (
    ("assign", r"((?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?)([A-Za-z0-9+/_.=-]+)", 6),
    ("access", r"()(AKIA[A-Z0-9]{16,})", 20),
    ("hex", r"()([0-9a-f]{24,})", 24),
)
NAMES = [k for k, _, _ in KINDS] + ["random"]
CANDIDATE = r"()((?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,})"
#: Encodings as they are tried: name, pattern, alphabet.
ENCODINGS = (
    ("hex", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", "0123456789abcdef"),
    ("HEX", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base64", r"^(?=.*[A-Z0-9])(?=.*[a-z])[A-Za-z0-9+/]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", r"^(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9])[A-Za-z0-9_-]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
ALPHA = 0.05
#: Lengths at which a new stratum begins.
LENGTHS = (20, 24, 32, 40, 64, 128)
#: Bins per unit of -ln p, and the last bin.
FINE, LAST = 50, 2000
REDACTED = "[SECRET]"

# Private-use characters: opening, closing, between the groups, and what they are exchanged for in a text.
_OPEN, _CLOSE, _BETWEEN, _INSTEAD = "\ue000", "\ue001", "\ue002", "\ue003"


def _clean(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _OPEN + _CLOSE + _BETWEEN, _INSTEAD * 3)


def _parts(text: Column, pattern: str) -> Column:
    """What stands before the first match, then per match the match and what follows it."""
    return F.split(F.regexp_replace(text, pattern, f"{_OPEN}$1{_BETWEEN}$2{_CLOSE}"), _OPEN)


def _spans(parts: Column, kind: int) -> Column:
    """array<struct<start, kind, end, secret, token>>: offsets of the match, of the secret in it, and the secret."""
    none = F.expr("CAST(array() AS array<struct<start: bigint, kind: int, end: bigint, secret: bigint, token: string>>)")

    def step(acc: Column, part: Column) -> Column:
        head = F.substring_index(part, _BETWEEN, 1)
        token = F.substring_index(F.substring_index(part, _CLOSE, 1), _BETWEEN, -1)
        inside = acc["pos"] + F.length(head)
        span = F.struct(acc["pos"].alias("start"), F.lit(kind).alias("kind"), (inside + F.length(token)).alias("end"), inside.alias("secret"), token.alias("token"))
        # the two marks in the part aren't in the text
        return F.struct((acc["pos"] + F.length(part) - 2).alias("pos"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    start = F.struct(F.length(parts[0]).cast("long").alias("pos"), none.alias("spans"))
    found = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), start, step, lambda acc: acc["spans"])
    return F.when(F.size(parts) > 1, found).otherwise(none)


def _normal_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal distribution, to 1.4e-4 (a logistic approximation)."""
    return 1 / (1 + F.exp(F.least(F.greatest(1.5976 * z + 0.07056 * z * z * z, F.lit(-700.0)), F.lit(700.0))))


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _normal_tail(F.abs(z)))


def judged(candidates: Column) -> list[tuple[str, Column]]:
    """Steps that turn candidate spans into array<struct<start, kind, end, secret, enc, n, p>>,
    each over the one before: no expression is written out twice."""
    def inferred(c: Column) -> Column:
        enc, alphabet = F.lit(None).cast("string"), F.lit(None).cast("string")
        for name, pattern, letters in reversed(ENCODINGS):
            enc = F.when(c["token"].rlike(pattern), name).otherwise(enc)
            alphabet = F.when(c["token"].rlike(pattern), letters).otherwise(alphabet)
        return F.struct(c["start"], c["kind"], c["end"], c["secret"], F.rtrim(c["token"], F.lit("=")).alias("body"), enc.alias("enc"), alphabet.alias("alphabet"))

    def numbers(c: Column) -> Column:
        at = F.transform(F.split(c["body"], ""), lambda ch: F.instr(c["alphabet"], ch) - 1)
        return F.struct(c["start"], c["kind"], c["end"], c["secret"], c["enc"], at.alias("x"), F.length(c["body"]).alias("n"), F.length(c["alphabet"]).alias("a"))

    def sums(c: Column) -> Column:
        x, n, a = c["x"], c["n"], c["a"]
        total = F.aggregate(x, F.lit(0), lambda s, i: s + i)
        high = F.size(F.filter(x, lambda i: i * 2 >= a))
        pairs = F.zip_with(F.slice(x, 1, n - 1), F.slice(x, 2, n - 1), lambda i, j: F.struct(i.alias("i"), j.alias("j")))
        return F.struct(c["start"], c["kind"], c["end"], c["secret"], c["enc"], x.alias("x"), n.alias("n"), a.alias("a"),
                        (total / n).alias("mean"), high.alias("high"), pairs.alias("pairs"), F.when(n < 80, 4).otherwise(8).alias("bins"))

    def statistics(c: Column) -> Column:
        x, n, a, mean, bins = c["x"], c["n"], c["a"], c["mean"], c["bins"]
        expected = n / bins
        chi = F.aggregate(F.sequence(F.lit(0), bins - 1), F.lit(0.0),
                          lambda s, b: s + F.pow(F.size(F.filter(x, lambda i: F.floor(i * bins / a) == b)) - expected, F.lit(2.0)) / expected)
        turns = F.size(F.filter(c["pairs"], lambda p: (p["i"] * 2 >= a) != (p["j"] * 2 >= a)))
        spread = F.aggregate(x, F.lit(0.0), lambda s, i: s + (i - mean) * (i - mean))
        serial = F.aggregate(c["pairs"], F.lit(0.0), lambda s, p: s + (p["i"] - mean) * (p["j"] - mean))
        even = 2.0 * c["high"] * (n - c["high"]) / n  # expected turns
        return F.struct(c["start"], c["kind"], c["end"], c["secret"], c["enc"], n.alias("n"), chi.alias("chi"), (bins - 1).cast("double").alias("df"),
                        (turns - even).alias("more_turns"), F.sqrt(F.greatest(even * (even - 1) / (n - 1), F.lit(1e-9))).alias("turns_sd"),
                        F.when(spread > 0, serial / spread).otherwise(1.0).alias("r"))

    def p_values(c: Column) -> Column:
        n, df = c["n"], c["df"]
        cube = F.pow(c["chi"] / df, F.lit(1 / 3))  # Wilson-Hilferty
        logs = (F.ln(F.greatest(_normal_tail((cube - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))), F.lit(1e-30)))
                + F.ln(F.greatest(F.when(F.abs(c["more_turns"]) > 1e-9, _two_sided(c["more_turns"] / c["turns_sd"])).otherwise(1.0), F.lit(1e-30)))
                + F.ln(F.greatest(_two_sided((c["r"] + 1.0 / n) * F.sqrt(n)), F.lit(1e-30))))
        return F.struct(c["start"], c["kind"], c["end"], c["secret"], c["enc"], n.alias("n"), (-logs).alias("h"))

    def fisher(c: Column) -> Column:
        h = c["h"]  # half of Fisher's statistic, chi-squared with six degrees of freedom
        p = F.exp(-h) * (1 + h + h * h / 2)
        return F.struct(c["start"], c["kind"], c["end"], c["secret"], c["enc"], c["n"], F.least(p, F.lit(1.0)).alias("p"))

    out = candidates
    steps = []
    for name, step in (("inferred", inferred), ("numbers", numbers), ("sums", sums), ("statistics", statistics), ("p_values", p_values), ("fisher", fisher)):
        col = F.transform(out, step)
        steps.append((name, F.filter(col, lambda c: c["enc"].isNotNull()) if name == "inferred" else col))
        out = F.col("__candidates")
    return steps


def _length_class(n: Column) -> Column:
    out = F.lit(LENGTHS[0])
    for x in LENGTHS[1:]:
        out = F.when(n >= x, x).otherwise(out)
    return out


def _bin(p: Column) -> Column:
    return F.least(F.floor(-F.ln(F.greatest(p, F.lit(1e-300))) * FINE), F.lit(LAST)).cast("int")


def _long_enough(least: int):
    return lambda span: F.length(span["token"]) >= least  # one parameter: a second one would be the position


def scanned(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``__base`` (base spans by start, then kind) and ``__candidates`` (judged tokens
    that no base span touches)."""
    rows = docs.withColumn("__clean", _clean(F.col("text")))
    for name, pattern, _ in KINDS:
        rows = rows.withColumn(f"__{name}", _parts(F.col("__clean"), pattern))
    rows = rows.withColumn("__tokens", _parts(F.col("__clean"), CANDIDATE)).select(*keep, "__tokens", *[f"__{k}" for k, _, _ in KINDS])
    found = [F.filter(_spans(F.col(f"__{name}"), i), _long_enough(least)) for i, (name, _, least) in enumerate(KINDS)]
    rows = rows.select(*keep, F.array_sort(F.concat(*found)).alias("__base"), _spans(F.col("__tokens"), len(KINDS)).alias("__tokens"))
    free = F.filter(F.col("__tokens"), lambda c: ~F.exists(F.col("__base"), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    rows = rows.withColumn("__candidates", free).drop("__tokens")
    for _, step in judged(F.col("__candidates")):
        rows = rows.withColumn("__candidates", step)
    plain = F.transform(F.col("__base"), lambda s: F.struct(s["start"], s["kind"], s["end"], s["secret"]))
    return rows.withColumn("__base", plain)


def natural_from(rows: DataFrame, alpha: float = ALPHA) -> dict[str, int]:
    """Benjamini-Hochberg per stratum: the least bin of -ln p whose tokens are set aside as natural
    (a stratum that has none isn't listed). At most strata x bins rows are counted."""
    tokens = rows.select(F.explode("__candidates").alias("c")).select(F.concat_ws(":", "c.enc", _length_class(F.col("c.n"))).alias("stratum"), _bin(F.col("c.p")).alias("bin"))
    counts = tokens.groupBy("stratum", "bin").agg(F.count("*").alias("n"))
    up = Window.partitionBy("stratum").orderBy(F.desc("bin"))
    whole = Window.partitionBy("stratum")
    # all tokens of a bin have p <= exp(-bin / FINE)
    cut = (counts.withColumn("below", F.sum("n").over(up)).withColumn("all", F.sum("n").over(whole))
           .where(F.exp(-F.col("bin") / FINE) <= alpha * F.col("below") / F.col("all"))
           .groupBy("stratum").agg(F.min("bin").alias("bin")))
    return {r["stratum"]: r["bin"] for r in cut.collect()}  # one row per encoding and length class


def _added(limits: dict[str, int]) -> Column:
    """The candidates that aren't set aside."""
    pairs = [x for k, v in limits.items() for x in (F.lit(k), F.lit(v))]

    def random(c: Column) -> Column:
        if not pairs:
            return F.lit(True)
        limit = F.create_map(*pairs)[F.concat_ws(":", c["enc"], _length_class(c["n"]))]
        return _bin(c["p"]) < F.coalesce(limit, F.lit(LAST + 1))

    return F.transform(F.filter(F.col("__candidates"), random), lambda c: F.struct(c["start"], c["kind"], c["end"], c["secret"]))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(n) for n in NAMES])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def find(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, counts of base spans, their digest, all spans, number of added ones."""
    rows = cut_lineage(scanned(pick(docs, doc_id="long", text="string")), "secrets")  # spans only, no texts
    limits = natural_from(rows)
    rows = rows.withColumn("__all", F.array_sort(F.concat("__base", _added(limits))))
    count = lambda k: F.size(F.filter(F.col("__base"), lambda s: s["kind"] == k)).cast("long")
    return rows.select("doc_id", *[count(i).alias(f"n_{k}") for i, (k, _, _) in enumerate(KINDS)], F.sha2(_listed(F.col("__base")).cast("binary"), 256).alias("base_sha256"),
                       _listed(F.col("__all")).alias("spans"), (F.size("__all") - F.size("__base")).cast("long").alias("n_added"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every secret replaced by REDACTED (n_chars follows, if there is such a
    column). The texts are scanned twice, once for the control and once for the spans."""
    limits = natural_from(scanned(docs, ()))
    columns = docs.columns
    rows = scanned(docs, tuple(columns)).withColumn("__all", F.array_sort(F.concat("__base", _added(limits))))

    def step(acc: Column, s: Column) -> Column:
        between = F.when(s["secret"] >= acc["pos"], F.concat(F.substring(F.col("text"), (acc["pos"] + 1).cast("int"), (s["secret"] - acc["pos"]).cast("int")), F.lit(REDACTED))).otherwise("")
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), F.concat(acc["out"], F.array(between)).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("pos"), F.expr("CAST(array() AS array<string>)").alias("out"))
    done = F.aggregate(F.col("__all"), start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("text"), (acc["pos"] + 1).cast("int"), F.length("text"))))
    rows = rows.withColumn("text", F.when(F.size("__all") > 0, done).otherwise(F.col("text")))
    if "n_chars" in columns:
        rows = rows.withColumn("n_chars", F.when(F.size("__all") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(*columns)
