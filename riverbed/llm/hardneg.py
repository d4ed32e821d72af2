"""Hard negatives: for each anchor and each of its nearest rows of the same label, the nearest rows
of other labels whose score is not far below.

Components become integers, so that scores are exact. The rows are dealt out in blocks of about
BLOCK_ROWS by a hash; the anchors go to every block in tiles of about TILE_ROWS (a stated query set against all
rows). In a block a tile's scores are one product of integer matrices by Strassen's recursion: seven products
of quarters instead of eight, zeros where a side is odd, and no rounding. From each product only
heaps remain: per anchor the first WANTED positives, in a second pass per anchor and positive the first WANTED rows in the
window below its score. Heaps of different blocks merge by rank, partly before they are shuffled. A task
holds one block, one tile and their scores, whatever the number of rows.

Special cases: rows with a null vec_id, label or vector, or a component that is null or not finite, take no part; a shorter
vector is continued with zeros, an empty one scores 0; scores beyond 64 bits wrap around, components beyond them are
the nearest long; ties are settled by the smaller vec_id; repeated rows are rows of their own (a copy of an anchor is an anchor, and a
positive of the other); an anchor without positives, or a positive whose window is empty, gives no rows; an empty table gives none; columns
besides vec_id, embedding and label are ignored."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverbed.llm.common import pick
from riverbed.session import cut_lineage, ship_package

#: Rows of a block and anchors of a tile, about.
BLOCK_ROWS = 4096
TILE_ROWS = 256
#: Positives of an anchor, and negatives of a positive.
WANTED = 5
#: A side of this length or less isn't halved any more.
LEAF = 16
#: Share of the positive's score that a negative must have: SHARE of 100.
SHARE = 80
ANCHOR_EVERY = 100
SCALE = 256

_LEAST = np.iinfo(np.int64).min


def leaf_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of outer products."""
    out = np.zeros((a.shape[0], b.shape[1]), np.int64)
    step = np.empty_like(out)
    for k in range(a.shape[1]):
        np.multiply(a[:, k, None], b[k], out=step)
        out += step
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two matrices of 64-bit integers."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return leaf_product(a, b)
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
        return strassen(a, b, leaf)[:m, :n]
    i, j, l = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    product = partial(strassen, leaf=leaf)
    out = np.empty((m, n), np.int64)
    c11, c12, c21, c22 = out[:i, :l], out[:i, l:], out[i:, :l], out[i:, l:]
    # each product goes to its places at once, so that one is held at a time beside the result
    p = product(a11 + a22, b11 + b22)
    c11[:], c22[:] = p, p
    p = product(a21 + a22, b11)
    c21[:] = p
    c22 -= p
    p = product(a11, b12 - b22)
    c12[:] = p
    c22 += p
    p = product(a22, b21 - b11)
    c11 += p
    c21 += p
    p = product(a11 + a12, b22)
    c11 -= p
    c12 += p
    c22 += product(a21 - a11, b11 + b12)
    c11 += product(a12 - a22, b21 + b22)
    return out


def first(scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, most: int = WANTED) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the first ``most`` allowed scores of each row; ``ids`` settle ties."""
    masked = np.where(allowed, scores, _LEAST)
    if masked.shape[1] > most:
        limit = np.partition(masked, -most, axis=1)[:, -most, None]
        allowed = allowed & (masked >= limit)
    row, col = np.nonzero(allowed)
    order = np.lexsort((ids[col], -scores[row, col], row))
    row, col = row[order], col[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < most], col[rank < most]


def rows_of(embeddings: DataFrame) -> DataFrame:
    """row (a number of its own), vec_id, label, v (the integers); written once."""
    rows = pick(embeddings, vec_id="long", embedding="array<double>", label="long")
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    v = F.transform("embedding", lambda x: F.floor(x * F.lit(float(SCALE))))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(sound)
    return cut_lineage(kept.select(F.monotonically_increasing_id().alias("row"), "vec_id", label.alias("label"), v.alias("v")), "vectors")


def matrix(lists: pa.Array) -> np.ndarray:
    """Lists as rows; shorter ones are continued with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    width = int(sizes.max()) if len(sizes) else 0
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


class Tile:
    """Rows of one kind as they come: numbers, ids, labels and vectors."""

    def __init__(self) -> None:
        self.parts: list[pa.RecordBatch] = []

    def add(self, part: pa.RecordBatch) -> None:
        self.parts.append(part)

    def ready(self) -> tuple[dict[str, np.ndarray], np.ndarray, list]:
        table = pa.Table.from_batches(self.parts).combine_chunks()
        columns = {c: table.column(c).to_numpy() for c in ("row", "vec_id", "label")}
        return columns, matrix(table.column("v").combine_chunks()), table.column("limits").to_pylist()


def product_of(anchors: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Scores of all anchors with all rows of a block (``block`` is transposed)."""
    width = max(anchors.shape[1], block.shape[0])
    anchors = np.pad(anchors, ((0, 0), (0, width - anchors.shape[1])))
    block = np.pad(block, ((0, width - block.shape[0]), (0, 0)))
    return strassen(anchors, block)


Heap = Callable[[np.ndarray, dict, dict, list], dict[str, np.ndarray]]


def positives_heap(scores: np.ndarray, anchor: dict, other: dict, _: list) -> dict[str, np.ndarray]:
    allowed = (anchor["label"][:, None] == other["label"]) & (anchor["row"][:, None] != other["row"])
    a, b = first(scores, allowed, other["vec_id"])
    return {"row": anchor["row"][a], "positive_id": other["vec_id"][b], "positive_score": scores[a, b]}


def window_heap(scores: np.ndarray, anchor: dict, other: dict, limits: list) -> dict[str, np.ndarray]:
    """``limits``: per anchor the scores of its positives. A score fits when it is at most the positive's and
    SHARE hundredths of it at least, which is a bound on integers."""
    different = anchor["label"][:, None] != other["label"]
    out: dict[str, list] = {"row": [], "place": [], "negative_id": [], "negative_score": []}
    for place in range(WANTED):
        top = np.array([x[place] if x is not None and place < len(x) else _LEAST for x in limits], np.int64)
        have = top != _LEAST
        least = np.array([-(-SHARE * int(t) // 100) if h else 0 for t, h in zip(top, have)], np.int64)
        a, b = first(scores, different & have[:, None] & (scores <= top[:, None]) & (scores >= least[:, None]), other["vec_id"])
        for name, values in zip(out, (anchor["row"][a], np.full(len(a), place, np.int32), other["vec_id"][b], scores[a, b])):
            out[name].append(values)
    return {k: np.concatenate(v) for k, v in out.items()}


def met(rows: DataFrame, anchors: DataFrame, heap: Heap, made: str) -> DataFrame:
    """``heap`` of every tile of ``anchors`` (row, vec_id, label, v, limits) with every block of ``rows``."""
    n, n_anchors = rows.count(), anchors.count()
    blocks, tiles = max(1, -(-n // BLOCK_ROWS)), max(1, -(-n_anchors // TILE_ROWS))
    names = ["row", "vec_id", "label", "v", "limits"]
    ours = rows.withColumn("limits", F.lit(None).cast("array<long>")).select(F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"), F.lit(-1).cast("long").alias("tile"), *names)
    theirs = anchors.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.pmod(F.xxhash64("row"), F.lit(tiles)).alias("tile"), *names)
    # a block's own rows come first, then the tiles one after another
    dealt = ours.unionByName(theirs).repartitionByRange(blocks, "block").sortWithinPartitions("block", "tile")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tile, block = (None, None), Tile(), None

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal block
            if not tile.parts:
                return
            columns, vectors, limits = tile.ready()
            if at[1] == -1:
                block = columns, np.ascontiguousarray(vectors.T)
            elif block is not None:
                got = heap(product_of(vectors, block[1]), columns, block[0], limits)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in got.values()], names=list(got))

        for batch in batches:
            key = np.stack([batch.column("block").to_numpy(), batch.column("tile").to_numpy()])
            cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                here = tuple(key[:, a].tolist())
                if here != at:
                    yield from close()
                    if here[0] != at[0]:
                        block = None
                    at, tile = here, Tile()
                tile.add(batch.slice(a, b - a))
        yield from close()

    ship_package(rows.sparkSession)
    return dealt.mapInArrow(step, made)


def mine(embeddings: DataFrame) -> DataFrame:
    """Per anchor, positive and rank: anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = rows_of(embeddings)
    anchors = rows.where(F.col("vec_id") % ANCHOR_EVERY == 0)
    near = met(rows, anchors.withColumn("limits", F.lit(None).cast("array<long>")), positives_heap, "row long, positive_id long, positive_score long")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.col("positive_score").desc(), "positive_id"))
    positives = cut_lineage(near.withColumn("place", rank - 1).where(F.col("place") < WANTED), "positives")
    limits = positives.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda x: x["positive_score"]).alias("limits"))
    below = met(rows, anchors.join(limits, "row"), window_heap, "row long, place int, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("row", "place").orderBy(F.col("negative_score").desc(), "negative_id"))
    negatives = below.withColumn("rank", rank).where(F.col("rank") <= WANTED)
    named = positives.join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return negatives.join(named, ["row", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


MINE_SQL = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
score AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM sound a JOIN sound b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
positive AS (
  SELECT anchor_id, vec_id, score FROM score WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id, (row_number() OVER w)::INTEGER AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN score n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 5
"""
