"""Document fingerprints by randomised edit embedding.

A walk goes over the characters of a text: at step j it writes down the character under it and goes
on to the next one if a shared random bit of (j, character) is 1, else it stays. All texts share
the bits, so that two walks that are apart after an edit soon meet again and write the same from
there on: edit distance becomes Hamming distance. A character's stay depends only on the step of
arrival, which makes the walk a chain of table look-ups, one per character (STATES steps, then the bits repeat).

The fingerprint samples one step out of every 2**level, over the whole walk, and keeps one bit
for each: a hash of step and character. The level is the least one that leaves at most SAMPLES
of them, and the steps of a level are among those of the level below: two fingerprints are compared
at the coarser level of both. Likeness is agreements minus disagreements over the longer one's length, at
least 0: texts that have nothing to do with each other agree in half of the bits.

For search, bands of sampled bits find candidates, in which likeness is then verified.

Special cases: null counts as empty; empty texts are like each other (1) and unlike any other (0);
equal texts have equal fingerprints; documents with equal ids are in the order of their texts; a null id
comes first; a single document is its own next one; an empty table gives no rows; long texts are walked
through whole, at linear cost; further columns of any name are left out."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import RUN_BYTES, arrow_pass, mix64, pick, runs
from riverbed.llm.neardup import components
from riverbed.session import cut_lineage, ship_package

STATES = 4096
SAMPLES = 512
#: Bands of a segment of a fingerprint, bits in each band, bits in a segment. Every whole segment has bands of its own, so that an edit
#: costs those of the segments that it reaches; a fingerprint above level 0 has at least two segments, a shorter one than SEGMENT is one.
BANDS, BITS, SEGMENT = 24, 16, 128
#: Documents per range of ids that is gone through in order, about.
RANGE_ROWS = 20_000
LIKENESS = 0.8

_CLASS = (mix64(np.arange(1 << 16, dtype=np.uint64)) & np.uint64(255)).astype(np.uint8)
_STEP = np.uint64(0xD1342543DE82EF95)
_WALK: list = []


def _states() -> list:
    """Per step (mod STATES) a list: by class of character, the list of the step at which the
    next character is arrived at; last, the step itself."""
    if not _WALK:
        j, c = np.arange(2 * STATES, dtype=np.uint64) % np.uint64(STATES), np.arange(256, dtype=np.uint64)
        go = (mix64(j[:, None] * np.uint64(256) + c[None] + np.uint64(1 << 40)) >> np.uint64(17)) & np.uint64(1) == 1
        steps = np.where(go, np.arange(2 * STATES)[:, None], 1 << 30)
        leave = np.minimum.accumulate(steps[::-1], axis=0)[::-1][:STATES]  # first step from j on with a 1
        after = ((leave + 1) % STATES).tolist()
        made: list = [[] for _ in range(STATES)]
        for at, row in enumerate(after):
            made[at].extend(map(made.__getitem__, row))
            made[at].append(at)
        _WALK.extend(made)
    return _WALK


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def arrivals(points: np.ndarray, start: int = 0) -> np.ndarray:
    """The step at which the walk arrives at each character, and at the end."""
    classes = _CLASS[points & 0xFFFF].tobytes()
    chain = accumulate(classes, getitem, initial=_states()[start % STATES])
    at = np.fromiter(map(itemgetter(256), chain), np.int64, len(points) + 1)
    stay = np.diff(at) % STATES
    stay[stay == 0] = STATES
    return start + np.concatenate([[0], np.cumsum(stay)])


def _bits(level: int, x: np.ndarray) -> np.ndarray:
    """Which half of block x of this level holds its sampled step."""
    return (mix64(x.astype(np.uint64) * np.uint64(64) + np.uint64(level)) >> np.uint64(23)) & np.uint64(1)


def sampled_steps(level: int, blocks: int) -> np.ndarray:
    x = np.arange(blocks, dtype=np.uint64)
    for k in range(level, 0, -1):
        x = x * np.uint64(2) + _bits(k, x)
    return x.astype(np.int64)


def level_of(steps: int) -> int:
    level = 0
    while -(-steps // (1 << level)) > SAMPLES:
        level += 1
    return level


def embed(points: np.ndarray, at: np.ndarray) -> str:
    """The fingerprint of a text from its walk: level, number of bits, the bits in hexadecimal."""
    total = int(at[-1])
    if not total:
        return "0:0:"
    level = level_of(total)
    steps = sampled_steps(level, -(-total // (1 << level)))
    inside = np.searchsorted(at, steps, side="right") - 1
    char = np.where(inside < len(points), points[np.minimum(inside, len(points) - 1)], 0).astype(np.uint64)
    bits = (mix64(steps.astype(np.uint64) * _STEP + char) >> np.uint64(31)) & np.uint64(1)
    return f"{level}:{len(bits)}:{np.packbits(bits.astype(np.uint8)).tobytes().hex()}"


def fingerprint(text: str | None) -> str:
    points = codes(text or "")
    return embed(points, arrivals(points))


def parse(print_: str) -> tuple[int, np.ndarray]:
    level, n, digits = print_.split(":")
    return int(level), np.unpackbits(np.frombuffer(bytes.fromhex(digits), np.uint8))[:int(n)]


def coarser(level: int, bits: np.ndarray, to: int) -> np.ndarray:
    while level < to:
        level += 1
        x = np.arange(-(-len(bits) // 2), dtype=np.uint64)
        pick_ = (x * np.uint64(2) + _bits(level, x)).astype(np.int64)
        bits = np.append(bits, np.uint8(0))[np.minimum(pick_, len(bits))]  # past the end: padding
    return bits


def likeness(one: str, two: str) -> float:
    if one == two:
        return 1.0
    (la, a), (lb, b) = parse(one), parse(two)
    level = max(la, lb)
    a, b = coarser(la, a, level), coarser(lb, b, level)
    short, long = sorted((len(a), len(b)))
    if not short:
        return 0.0
    agree = int((a[:short] == b[:short]).sum())
    return max(0.0, (2 * agree - short) / long)


_DRAWN = mix64(np.arange(BANDS * BITS, dtype=np.uint64))


def bands(print_: str) -> np.ndarray:
    """Keys of bit-sampled bands, at the fingerprint's level and the next, so that texts on either
    side of a change of level meet."""
    level, bits = parse(print_)
    out = [np.zeros(0, np.int64)]
    for to in (level, level + 1) if len(bits) else ():
        here = coarser(level, bits, to)
        width = min(SEGMENT, len(here))
        parts = here[:len(here) // width * width].reshape(-1, width)
        drawn = parts[:, (_DRAWN % np.uint64(width)).astype(np.int64)].reshape(-1, BITS)
        value = np.packbits(drawn, axis=1).view(">u2").astype(np.uint64).ravel()
        place = np.arange(len(value), dtype=np.uint64)  # segment and band
        out.append(mix64((value << np.uint64(32)) + place * np.uint64(64) + np.uint64(to)).view(np.int64))
    return np.concatenate(out)


def _result(row: tuple, following: tuple) -> dict:
    """A document (doc_id, text, points, walk, fingerprint) and the one after it."""
    doc_id, text, points, at, own = row
    _, next_text, next_points, _, next_own = following
    n = len(points)
    half = n // 2
    stay = n - half
    edited = text[:stay] + next_text[:half]
    # the walk over the part that stays is the document's own
    rest = next_points[:half]
    walk = np.concatenate([at[:stay], arrivals(rest, int(at[stay]))])
    other = embed(np.concatenate([points[:stay], rest]), walk)
    return {"doc_id": doc_id, "n_chars": n, "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), "fingerprint": own,
            "edited_fingerprint": other, "near_edited": likeness(own, other), "near_next": likeness(own, next_own),
            "shared_bands": len(np.intersect1d(bands(own), bands(other)))}


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, shared_bands int"


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows range, head, doc_id, text in order: each document with the one after it in its range,
    the last with the head of the next range, which stands at the end of its own."""
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in RESULT.split(", ")])
    before, of = None, None
    for batch in batches:
        for run in runs(batch, "text", RUN_BYTES // 2):
            out = []
            for r, head, doc_id, text in zip(*(run.column(i).to_pylist() for i in range(4))):
                points = codes(text)
                at = arrivals(points)
                row = (doc_id, text, points, at, embed(points, at))
                if before is not None and of == r:
                    out.append(_result(before, row))
                before, of = (None, None) if head else (row, r)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)


def edited_prints(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its edited text (the second half replaced by the
    beginning of the next document), and likenesses.

    The documents are dealt out by ranges of ids, one to a task, each sorted and gone through once. A range ends
    with a copy of the next range's first document."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = pick(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    keys = rows.select(key.alias("key"))
    n = keys.count()
    if not n:
        return spark.createDataFrame([], RESULT)
    ranges = max(64, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")), min(8192, n // RANGE_ROWS))
    at = [k / ranges for k in range(1, ranges)]
    got = keys.agg(F.min("key").alias("lo"), F.percentile_approx("key", at, 20 * ranges).alias("q")).first()
    # each bound is an id that occurs, so that it is its range's first one
    bounds = np.array(sorted({got["lo"], *got["q"]}), np.int64)

    def ranged(columns: dict[str, list]) -> dict[str, list]:
        ids = np.array([-(1 << 63) if d is None else d for d in columns["doc_id"]], np.int64)
        return {"range": np.searchsorted(bounds, ids, side="right") - 1}

    dealt = arrow_pass(rows, ranged, "range int", keep=("doc_id", "text"), reads=("doc_id",)).select("range", F.lit(False).alias("head"), "doc_id", "text")
    # one row per range
    firsts = spark.createDataFrame([(int(b), (i - 1) % len(bounds)) for i, b in enumerate(bounds)], "key long, range int")
    heads = (rows.withColumn("key", key).join(F.broadcast(firsts), "key").groupBy("range", "key").agg(F.min("text").alias("text"))
             .select("range", F.lit(True).alias("head"), F.when(F.col("key") > -(1 << 63), F.col("key")).alias("doc_id"), "text"))
    ordered = dealt.unionByName(heads).repartitionById(len(bounds), "range").sortWithinPartitions("range", "head", "doc_id", "text")
    return ordered.mapInArrow(_in_order, RESULT)


def prints(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, fingerprint, bands."""
    def work(columns: dict[str, list]) -> dict[str, list]:
        got = [fingerprint(t) for t in columns["text"]]
        return {"fingerprint": got, "bands": [bands(p).tolist() for p in got]}

    return arrow_pass(pick(docs, doc_id="long", text="string"), work, "fingerprint string, bands array<long>", keep=("doc_id",))


def near_classes(docs: DataFrame, least: float = LIKENESS) -> DataFrame:
    """Per document: doc_id, class_id. Equal fingerprints are one node; in a bucket of a band each
    is verified against the bucket's least one, and links make classes (named by the least doc_id)."""
    rows = cut_lineage(prints(docs), "prints")
    nodes = rows.groupBy("fingerprint").agg(F.first("bands").alias("bands"))
    members = nodes.select(F.col("fingerprint").alias("key"), F.explode("bands").alias("band"))
    hubs = cut_lineage(members.groupBy("band").agg(F.min("key").alias("hub"), F.count("*").alias("n")).where("n > 1"), "hubs")
    pairs = members.join(hubs, "band").where("hub <> key").select(F.col("hub").alias("a"), F.col("key").alias("b")).distinct()

    def verified(columns: dict[str, list]) -> dict[str, list]:
        return {"*": [i for i, (a, b) in enumerate(zip(columns["a"], columns["b"])) if likeness(a, b) >= least]}

    labels = components(arrow_pass(pairs, verified, "", keep=("a", "b"), text=None, reads=("a", "b")))
    named = rows.select("doc_id", F.col("fingerprint").alias("key")).join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    firsts = cut_lineage(named.groupBy("label").agg(F.min("doc_id").alias("class_id")), "classes")
    return named.join(firsts, "label").select("doc_id", "class_id")
