"""Best-fit packing by exact-complement hashing.

Documents are cut into pieces of at most ``capacity`` tokens. What matters for packing is how many
pieces there are of each length: at most ``capacity`` numbers, whatever the size of the corpus. The
plan is made from them alone. Length sums of single lengths, pairs and triples are looked up in a
table of the lengths that still have pieces (the exact complement of a gap is one lookup); a
combination that fills a sequence exactly is consumed as often as its counts allow. What is left
over is packed best fit, longest first, into the open sequences with the smallest gap that is large enough.

A plan is a list of patterns: some lengths side by side, and how many sequences look like that.
Pieces find their places by rank: those of a length are numbered 0, 1, 2, ... over the whole corpus
and the plan says which ranks of the length go to which pattern. The numbering is by salted
groups: rank within (length, salt) plus the groups before it, so that a length that a third of
all pieces have isn't one task's work.

Special cases: a null or empty text is one piece that holds only the closing id; repeated rows and ties
are numbered in any order among equals; a long text is cut into pieces, none of it is dropped; an empty table gives an
empty result; columns besides doc_id and text are ignored."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverbed.llm.common import arrow_pass, pick
from riverbed.llm.wordids import RUN_BYTES, word_ids
from riverbed.session import broadcast_checked, cut_lineage

CAPACITY = 2048
#: Pieces that are numbered together, about; sets the number of salts of a length.
GROUP_ROWS = 20_000

def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32."""
    def work(columns: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("*", "piece", "start", "length", "ids_crc32")}
        ids, ends = word_ids(path).encode(columns["text"], 0)
        begin = 0
        for i, end in enumerate(ends.tolist()):
            for k, at in enumerate(range(begin, end, capacity)):
                part = ids[at:min(at + capacity, end)]
                for name, value in zip(out, (i, k, at - begin, len(part), zlib.crc32(part))):
                    out[name].append(value)
            begin = end
        return out

    return arrow_pass(pick(docs, doc_id="long", text="string"), work, "piece int, start long, length long, ids_crc32 long", keep=("doc_id",), run_bytes=RUN_BYTES)


@dataclass(frozen=True)
class Pattern:
    lengths: tuple[int, ...]
    copies: int


def exact_fits(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Consume singles, pairs and triples that sum to the capacity; ``counts`` is changed."""
    out = []

    def consume(combo: tuple[int, ...]) -> None:
        need: dict[int, int] = defaultdict(int)
        for x in combo:
            need[x] += 1
        copies = min(counts.get(x, 0) // k for x, k in need.items())
        if copies:
            out.append(Pattern(combo, copies))
            for x, k in need.items():
                counts[x] -= k * copies
                if not counts[x]:
                    del counts[x]

    if capacity in counts:
        consume((capacity,))
    for a in sorted(counts, reverse=True):  # pairs: the complement is one lookup
        b = capacity - a
        if a >= b and a in counts and b in counts:
            consume((a, b))
    for a in sorted(counts, reverse=True):  # triples: the longest, the next, the complement of both
        for b in sorted((x for x in counts if x <= a), reverse=True):
            c = capacity - a - b
            if a not in counts:
                break
            if c > b:
                break
            if c > 0 and b in counts and c in counts:
                consume((a, b, c))
    return out


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit, longest first, over counts: open sequences of the same lengths are handled as one
    pattern with a number of copies, and a pattern splits when only some of its copies get a piece."""
    gaps: list[int] = []  # sorted gaps that have an open pattern
    by_gap: dict[int, list[list]] = defaultdict(list)  # gap -> [lengths, copies]

    def put(lengths: tuple[int, ...], copies: int, gap: int) -> None:
        if gap not in by_gap or not by_gap[gap]:
            insort(gaps, gap)
        by_gap[gap].append([lengths, copies])

    done: list[Pattern] = []
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):  # none is large enough: open new ones, each with as many as it holds
                each = capacity // length
                full, rest = divmod(left, each)
                for k, copies in ((each, full), (rest, 1)):
                    if k and copies:
                        gap = capacity - k * length
                        if gap:
                            put((length,) * k, copies, gap)
                        else:
                            done.append(Pattern((length,) * k, copies))
                left = 0
                continue
            gap = gaps[at]
            lengths, copies = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps.pop(at)
            taken = min(left, copies)
            left -= taken
            if copies > taken:
                put(lengths, copies - taken, gap)
            if gap > length:
                put((*lengths, length), taken, gap - length)
            else:
                done.append(Pattern((*lengths, length), taken))
    return done + [Pattern(tuple(p), n) for rest in by_gap.values() for p, n in rest]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    left = {x: n for x, n in counts.items() if n > 0}
    return exact_fits(left, capacity) + best_fit(left, capacity)


@dataclass(frozen=True)
class Slots:
    """Per length: ascending first ranks, and the sequence and offset that go with them."""

    first: dict[int, np.ndarray]
    sequence: dict[int, np.ndarray]
    offset: dict[int, np.ndarray]


def slots(patterns: list[Pattern]) -> Slots:
    taken: dict[int, int] = defaultdict(int)
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for p in patterns:
        offset = 0
        for length in p.lengths:
            rows[length].append((taken[length], sequence, offset))
            taken[length] += p.copies
            offset += length
        sequence += p.copies
    cols = {x: np.array(r, np.int64) for x, r in rows.items()}
    return Slots(*({x: c[:, k] for x, c in cols.items()} for k in range(3)))


def numbered(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``rows`` with ``rank``: 0, 1, 2, ... within each length, over the whole frame."""
    spark = rows.sparkSession
    # one row per length, of which there are no more than the capacity
    sizes = spark.createDataFrame([(x, -(-n // GROUP_ROWS)) for x, n in counts.items()], "length long, salts long")
    salted = rows.join(F.broadcast(sizes), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("salts"))).drop("salts")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    # one row per group of GROUP_ROWS pieces
    groups = (salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
              .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    return (salted.withColumn("rank", F.row_number().over(within) - 1)
            .join(broadcast_checked(groups), ["length", "salt"])
            .withColumn("rank", F.col("rank") + F.col("first")).drop("salt", "first"))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = cut_lineage(pieces(docs, path, capacity), "pieces")  # a few numbers per piece; the texts are encoded once
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    place = slots(plan(counts, capacity))

    def work(columns: dict[str, list]) -> dict[str, list]:
        length, rank = np.asarray(columns["length"], np.int64), np.asarray(columns["rank"], np.int64)
        sequence, offset = np.empty_like(rank), np.empty_like(rank)
        for x in np.unique(length).tolist():
            here = np.flatnonzero(length == x)
            at = np.searchsorted(place.first[x], rank[here], side="right") - 1
            sequence[here] = place.sequence[x][at] + rank[here] - place.first[x][at]
            offset[here] = place.offset[x][at]
        return {"sequence_id": sequence, "offset": offset}

    keep = ("doc_id", "piece", "start", "length", "ids_crc32")
    return arrow_pass(numbered(rows, counts).select(*keep, "rank"), work, "sequence_id long, offset long", keep=keep, text=None, reads=("length",))
