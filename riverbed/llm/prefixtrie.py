"""The trie of conversations' prefixes, rolled up in depth bands.

Every conversation c is rebuilt first: it begins with the first h turns of the conversation c - c % 100 (h is a checksum
of c, below PREFIX), then come its own turns after its first h. A node stands for a distinct sequence of first turns; its members
are the conversations that begin with it.

*Keys.* A turn is known by a digest of its role and text. The key of a prefix is the exclusive or of hashes of (place, digest) over its
turns, two times 64 bits: it can be put together from parts of a conversation, so that a conversation of any length is
scanned in chunks, and a parent's key is the node's own without the last turn's hash.

*Owners.* A node belongs to its smallest member. A conversation owns its path from some depth on, so
(owner, depth) names a node as well as the key does, and joins by it have no hot keys.

*Totals of subtrees.* Depths are cut into bands of BAND. Within a band a node's figures go to its ancestors in the
band only (suffix sums along its owner's path). The nodes at the top of bands form a tree of their own, BAND times
as shallow; it is rolled up in the same way, and the completed totals of each top go to its ancestors in the band
above. So a path of D turns takes log(D) / log(BAND) rounds and a node is copied BAND times at most.

*Digests of member lists.* The conversations that end in a node are sorted by range, joined into short strings wherever a task has
neighbours, and one pass over these strings updates the node's digest: memory doesn't follow the number of members.

Special cases: rows without conv_id take no part; null role and text are empty; turns of equal number (or
without one) are in the order of a digest of role and text, repeated rows are repeated turns; a rebuilt conversation without turns
ends in the root; an empty table has no nodes, not even the root; very long texts only count and are hashed where they
are read; columns besides conv_id, turn, role and text are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverbed.llm.common import pick
from riverbed.operators.ordering import positions
from riverbed.session import cut_lineage

#: h is a conversation's checksum modulo this.
PREFIX = 6
#: Conversations that share a beginning: those of the same hundred.
HUNDRED = 100
#: Height of a band.
BAND = 16
#: Turns of a conversation that are scanned together.
CHUNK = 1024
#: Ids joined into one string.
RUN_IDS = 512

_EMPTY = hashlib.sha256(b"").hexdigest()


def _part(digest: Column, at: int) -> Column:
    """Sixty bits of a digest in hexadecimal digits."""
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("long")


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), a and b (the digest), chars."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = (pick(conversations, conv_id="long", turn="long", role="string", text="string").where("conv_id IS NOT NULL")
            .select("conv_id", "turn", digest.alias("digest"), F.length(text).cast("long").alias("chars"))
            .select("conv_id", "turn", _part(F.col("digest"), 1).alias("a"), _part(F.col("digest"), 17).alias("b"), "chars"))
    return positions(rows, ["turn", "a", "b"], ["conv_id"], "pos").drop("turn")


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations: conv_id and size; their turns: conv_id, depth, a, b, chars)."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % PREFIX).alias("h")
    known = numbered.groupBy("conv_id").agg(F.max("pos").alias("n")).select("conv_id", "n", h, (F.col("conv_id") - F.col("conv_id") % HUNDRED).alias("head"))
    heads = known.where("conv_id = head").select(F.col("conv_id").alias("head"), F.col("n").alias("head_n"))
    taken = F.least("h", F.coalesce("head_n", F.lit(0)))
    convs = cut_lineage(known.join(heads, "head", "left")
                        .select("conv_id", "head", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size")), "conversations")
    own = (numbered.join(convs, "conv_id").where("pos > h")
           .select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "a", "b", "chars"))
    # fewer than PREFIX turns of each head, for up to a hundred conversations each
    shared = numbered.where((F.col("conv_id") % HUNDRED == 0) & (F.col("pos") < PREFIX)).withColumnRenamed("conv_id", "head")
    begun = (convs.where("taken > 0").join(shared, "head").where("pos <= taken")
             .select("conv_id", F.col("pos").alias("depth"), "a", "b", "chars"))
    return convs.select("conv_id", "size"), own.unionByName(begun)


def paths(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """Per conversation and depth, the root among them: conv_id, depth, x and y (the key), up_x and up_y (the parent's),
    chars (of the last text), inner (the conversation goes on)."""
    for seed, name in ((1, "hx"), (2, "hy")):
        rows = rows.withColumn(name, F.xxhash64(F.lit(seed), "depth", "a", "b"))
    rows = rows.withColumn("chunk", F.floor((F.col("depth") - 1) / CHUNK))
    within = Window.partitionBy("conv_id", "chunk").orderBy("depth")
    rows = rows.select("conv_id", "depth", "chunk", "chars", "hx", "hy", F.bit_xor("hx").over(within).alias("x"), F.bit_xor("hy").over(within).alias("y"))
    # a row for each chunk that is full
    ends = rows.where(F.col("depth") % CHUNK == 0).select("conv_id", F.col("chunk") + 1, "x", "y").toDF("conv_id", "chunk", "x", "y")
    before = Window.partitionBy("conv_id").orderBy("chunk")
    carried = ends.select("conv_id", "chunk", F.bit_xor("x").over(before).alias("cx"), F.bit_xor("y").over(before).alias("cy"))
    rows = rows.join(carried, ["conv_id", "chunk"], "left")
    x, y = (F.col(k).bitwiseXOR(F.coalesce(F.col(c), F.lit(0))) for k, c in (("x", "cx"), ("y", "cy")))
    keyed = (rows.select("conv_id", "depth", x.alias("x"), y.alias("y"), "hx", "hy", "chars").join(convs, "conv_id")
             .select("conv_id", "depth", "x", "y", F.col("x").bitwiseXOR(F.col("hx")).alias("up_x"), F.col("y").bitwiseXOR(F.col("hy")).alias("up_y"),
                     "chars", (F.col("depth") < F.col("size")).alias("inner")))
    zero = F.lit(0).cast("long")
    root = convs.select("conv_id", zero.alias("depth"), zero.alias("x"), zero.alias("y"), F.lit(None).cast("long").alias("up_x"), F.lit(None).cast("long").alias("up_y"),
                        zero.alias("chars"), (F.col("size") > 0).alias("inner"))
    return keyed.withColumn("depth", F.col("depth").cast("long")).unionByName(root)


def nodes_of(path: DataFrame) -> DataFrame:
    """Per node: its key, owner (conv_id), depth, n_convs, parent's key, leaf and saved."""
    return (path.groupBy("x", "y").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.count("*").alias("n_convs"), F.max("up_x").alias("up_x"),
                                       F.max("up_y").alias("up_y"), F.max("chars").alias("chars"), F.max("inner").alias("inner"))
            .select("x", "y", "conv_id", "depth", "n_convs", "up_x", "up_y", (~F.col("inner")).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")))


def roll_up(rows: DataFrame, band: int = BAND) -> DataFrame:
    """``rows``: conv_id, depth, x, y, own (0 or 1), leaf, saved; the figures stand in rows of owners, others have zeros.
    Per node that has an owner: x, y, leaf and saved summed over its subtree."""
    deepest = rows.agg(F.max("depth").alias("d")).first()["d"]
    rows = rows.withColumn("band", F.floor(F.col("depth") / band))
    sums = [F.sum(c).alias(c) for c in ("own", "leaf", "saved")]
    if deepest is not None and deepest >= band:
        top = F.col("depth") % band == 0
        each = rows.groupBy("conv_id", "band").agg(*sums, F.max(F.when(top, F.col("x"))).alias("x"), F.max(F.when(top, F.col("y"))).alias("y"))
        inside = each.where("own > 0").groupBy("x", "y").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
        tops = rows.where(top).select("conv_id", F.col("band").alias("depth"), "x", "y", "own")
        owned = tops.where("own = 1").join(inside, ["x", "y"], "left")
        tops = cut_lineage(owned.unionByName(tops.where("own = 0").withColumns({"leaf": F.lit(0).cast("long"), "saved": F.lit(0).cast("long")})), "band-tops")
        totals = roll_up(tops, band)
        # the completed total of a top goes to the band above it
        carriers = (tops.where("own = 1 AND depth > 0").select("conv_id", "depth", "x", "y", "own").join(totals, ["x", "y"])
                    .select("conv_id", (F.col("depth") * band).alias("depth"), F.lit(None).cast("long").alias("x"), F.lit(None).cast("long").alias("y"), "own", "leaf", "saved", (F.col("depth") - 1).alias("band")))
        rows = rows.unionByName(carriers)
    below = Window.partitionBy("conv_id", "band").orderBy(F.col("depth").desc())
    gathered = rows.select("x", "y", *[F.sum(c).over(below).alias(c) for c in ("own", "leaf", "saved")])
    return gathered.where("own > 0 AND x IS NOT NULL").groupBy("x", "y").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours of one node as strings of up to RUN_IDS ids."""
    for batch in batches:
        x, y, ids = (batch.column(i).to_numpy() for i in range(3))
        new = np.flatnonzero((x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1
        cuts = [0, *new.tolist(), len(ids)] if len(ids) else [0]
        starts = [k for a, b in zip(cuts, cuts[1:]) for k in range(a, b, RUN_IDS)]
        text = list(map(str, ids.tolist()))
        ends = [*starts[1:], len(ids)]
        yield pa.RecordBatch.from_arrays([pa.array(x[starts]), pa.array(y[starts]), pa.array(ids[starts]), pa.array([",".join(text[a:b]) for a, b in zip(starts, ends)], pa.string())], names=["x", "y", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node over its strings, which come in order."""
    key, state, done = None, None, []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in done], pa.int64()), pa.array([k[1] for k, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())], names=["x", "y", "ends_sha256"])

    for batch in batches:
        for x, y, ids in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), batch.column("ids").to_pylist()):
            if (x, y) != key:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = (x, y), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield out()
        done.clear()
    if key is not None:
        done.append((key, state.hexdigest()))
        yield out()


def end_digests(path: DataFrame) -> DataFrame:
    """x, y, ends_sha256 of the nodes in which a conversation ends."""
    ends = path.where("NOT inner").select("x", "y", "conv_id")
    strings = ends.repartitionByRange("x", "y", "conv_id").sortWithinPartitions("x", "y", "conv_id").mapInArrow(_joined, "x long, y long, first long, ids string")
    return strings.repartition("x", "y").sortWithinPartitions("x", "y", "first").mapInArrow(_digests, "x long, y long, ends_sha256 string")


def trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, rows = rebuilt(turns(conversations))
    path = cut_lineage(paths(convs, rows), "paths")
    nodes = cut_lineage(nodes_of(path), "nodes")
    owners = nodes.select("conv_id", "depth", F.lit(1).alias("own"), "leaf", "saved")
    own = path.select("conv_id", "depth", "x", "y").join(owners, ["conv_id", "depth"], "left").na.fill(0, ["own", "leaf", "saved"])
    totals = roll_up(cut_lineage(own, "owners") if band else own, band).select("x", "y", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    children = nodes.where("depth > 0").groupBy("up_x", "up_y").agg(F.count("*").alias("n_children")).toDF("x", "y", "n_children")
    # a node's parent has the same owner, unless the owner's path branches off there
    above = nodes.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("same"))
    parted = nodes.where("depth > 0").select("conv_id", "depth", "up_x", "up_y").join(above, ["conv_id", "depth"], "left_anti")
    least = nodes.agg(F.min("conv_id").alias("c")).first()["c"]  # the owner of the root
    other = parted.where("depth > 1").join(nodes.select(F.col("x").alias("up_x"), F.col("y").alias("up_y"), F.col("conv_id").alias("parted_conv_id")), ["up_x", "up_y"])
    parents = other.select("conv_id", "depth", "parted_conv_id").unionByName(parted.where("depth = 1").select("conv_id", "depth", F.lit(least).cast("long").alias("parted_conv_id")))
    return (nodes.join(totals, ["x", "y"]).join(children, ["x", "y"], "left").join(end_digests(path), ["x", "y"], "left").join(parents, ["conv_id", "depth"], "left")
            .select("conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parted_conv_id", "conv_id")).alias("parent_conv_id"), "n_convs",
                    F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256")))


#: DuckDB. The checksum is worked out bit by bit (CRC-32 in its reflected form).
TRIE_SQL = """
WITH RECURSIVE ids AS (SELECT DISTINCT conv_id AS c, conv_id::VARCHAR AS s FROM conversations WHERE conv_id IS NOT NULL),
crc AS (
  SELECT c, s, 0 AS bit, 4294967295::BIGINT AS v FROM ids
  UNION ALL
  SELECT c, s, bit + 1, xor(w >> 1, (w & 1) * 3988292384::BIGINT)
  FROM (SELECT c, s, bit, CASE WHEN bit % 8 = 0 THEN xor(v, ascii(s[bit // 8 + 1])::BIGINT) ELSE v END AS w
        FROM crc WHERE bit < 8 * length(s))
),
kept AS (SELECT c, c - c % 100 AS head, xor(v, 4294967295::BIGINT) % 6 AS h FROM crc WHERE bit = 8 * length(s)),
numbered AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
),
turns AS (
  SELECT k.c, n.pos, n.role, n.text FROM kept k JOIN numbered n ON n.c = k.head AND n.pos <= k.h
  UNION ALL
  SELECT k.c, 1000 + n.pos, n.role, n.text FROM kept k JOIN numbered n ON n.c = k.c AND n.pos > k.h
),
steps AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY pos) AS depth, length(text) AS chars,
         list(sha256(length(role) || ':' || role || text)) OVER (PARTITION BY c ORDER BY pos) AS sofar
  FROM turns
),
path AS (
  SELECT c, 0 AS depth, 0 AS chars, '' AS key FROM kept
  UNION ALL SELECT c, depth, chars, sha256(array_to_string(sofar, ',')) FROM steps
),
last AS (SELECT c, max(depth) AS depth FROM path GROUP BY c),
node AS (
  SELECT key, depth, min(c) AS c, count(*) AS n_convs, (count(*) - 1) * max(chars) AS saved,
         coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE depth = size), '') AS ends, max(size) = depth AS leaf
  FROM (SELECT p.*, l.depth AS size FROM path p JOIN last l USING (c)) GROUP BY key, depth
),
total AS (
  SELECT p.key, sum(n.saved) AS saved, count(*) FILTER (WHERE n.leaf) AS leaves
  FROM node n JOIN path p ON p.c = n.c AND p.depth <= n.depth GROUP BY p.key
),
parent AS (
  SELECT n.key, up.key AS up_key, o.c AS up_c
  FROM node n JOIN path up ON up.c = n.c AND up.depth = n.depth - 1 JOIN node o ON o.key = up.key
),
kids AS (SELECT up_key AS key, count(*) AS n FROM parent GROUP BY up_key)
SELECT n.c AS conv_id, n.depth::BIGINT AS depth, u.up_c AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
       t.leaves AS n_leaves, t.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM node n JOIN total t USING (key) LEFT JOIN parent u USING (key) LEFT JOIN kids k USING (key)
"""
