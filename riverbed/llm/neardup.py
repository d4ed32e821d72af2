"""Near-duplicate detection with DartMinHash.

A text is the multiset of its five-word shingles. A shingle that stands there c times is an
element of weight c: c unit regions. Hashed darts are thrown into each region: a Poisson process
over ranks, the same for a region wherever it occurs. Every dart has a coordinate of the signature;
the earliest dart per coordinate is kept. A long text throws each region's darts only as far as the
ranks that its signature needs, so the work grows with the length plus a constant per text.
Two texts keep the same dart in a coordinate with the probability of their weighted Jaccard similarity.

Signatures are banded. Copies count once. In a bucket every text is compared with the bucket's
least text (the hub), exactly, on whole texts: as many pairs as members. Classes are the connected
components of the links found. Where a bucket still holds several classes, its members meet in groups of
GROUP_ROWS at most, about, and are compared there completely, as far as they are of different classes; a
group tells only the links that join classes, fewer than it has members. A larger bucket is dealt out to
groups anew until a turn finds no link, which settles most of it. What is left of the larger buckets is settled exactly: two texts of
the least similarity share one of their rarest regions (prefix filter), so that texts of different classes which
share one are compared, in pairs of chunks where they are more than GROUP_ROWS.

Words are what stands between ASCII white space. A text of fewer than five words is one shingle;
an empty or null text has none and is a copy of the other empty ones only. Repeated rows are copies of each
other. Ties: the class is named after its least doc_id (null if it has no other), which is the one that is kept.
A long text is hashed in segments and compared whole; an empty table has no classes; further columns may have any name."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import arrow_pass, mix64, pick
from riverbed.session import broadcast_checked, cut_lineage

SHINGLE = 5
SIMILARITY = 0.8
#: 26 bands of 5 coordinates miss a pair of similarity 0.8 with probability 3e-5.
BANDS, ROWS = 26, 5
#: Members of a bucket with several classes that are compared with each other in one group, about.
GROUP_ROWS = 256
#: Cells in which regions are counted, so that the rare ones come first.
CELLS = 1 << 16
#: Bytes that are hashed at a time (up to the end of a word).
SEGMENT = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15
_BYTES = mix64(np.arange(256, dtype=np.uint64) + np.uint64(1000))
_MIX = mix64(np.arange(SHINGLE, dtype=np.uint64) + np.uint64(7)) | np.uint64(1)
_DART = np.uint64(0xD1342543DE82EF95)
_REGION = np.uint64(0xA24BAED4963EE407)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _MULTIPLIER), ("down", pow(_MULTIPLIER, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _segment_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash per word, from running sums over the bytes."""
    b = np.frombuffer(data, np.uint8)
    word = ~((b == 32) | ((b >= 9) & (b <= 13)))
    edge = np.diff(word.view(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(b))
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTES[b] * up, out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _DART)


def word_hashes(text: str) -> np.ndarray:
    data = text.encode("utf-8", "surrogatepass")
    if len(data) <= SEGMENT:
        return _segment_hashes(data)
    parts, at = [], 0
    while at < len(data):
        stop = min(len(data), at + SEGMENT)
        while stop < len(data) and data[stop] not in b" \t\n\x0b\x0c\r":
            stop += 1
        parts.append(_segment_hashes(data[at:stop]))
        at = stop
    return np.concatenate(parts)


def regions(text: str | None) -> np.ndarray:
    """The unit regions of a text, sorted: one per shingle and occurrence."""
    w = word_hashes(text or "")
    if not len(w):
        return w
    width = min(SHINGLE, len(w))
    n = len(w) - width + 1
    s = np.zeros(n, np.uint64)
    for k in range(width):
        s += w[k:n + k] * _MIX[k]
    s = np.sort(mix64(s + np.uint64(width)))
    new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    nth = np.arange(n) - np.repeat(new, np.diff(np.append(new, n)))
    return np.sort(mix64(s + nth.astype(np.uint64) * _REGION))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two texts, from their regions."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def darts(units: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Ranks and hashes of all darts in the regions with a rank up to ``reach``."""
    if reach > 2:
        width = int(reach + 8 * np.sqrt(reach) + 20)
        while True:
            h = mix64(units[:, None] + np.arange(width, dtype=np.uint64)[None] * _DART)
            rank = np.cumsum(-np.log(((h >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53), axis=1)
            if rank[:, -1].min() > reach:
                break
            width *= 2
        hit = rank <= reach
        return rank[hit], h[hit]
    ranks, hashes, start, nth = [], [], np.zeros(len(units)), np.zeros(1, np.uint64)
    while len(units):
        h = mix64(units + nth * _DART)
        rank = start - np.log(((h >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53)
        hit = rank <= reach
        units, start = units[hit], rank[hit]
        ranks.append(start)
        hashes.append(h[hit])
        nth += np.uint64(1)
    return np.concatenate(ranks), np.concatenate(hashes)


def signature(units: np.ndarray, k: int = BANDS * ROWS) -> np.ndarray:
    """The earliest dart of each of ``k`` coordinates. Enough ranks are looked at for all
    coordinates to have one; where some are left empty, twice as many."""
    reach = (k * np.log(k) + 2 * k) / len(units)
    while True:
        rank, h = darts(units, reach)
        dart = mix64(h + _REGION)
        at = dart % np.uint64(k)
        order = np.argsort(rank, kind="stable")[::-1]  # the earliest is written last
        out, filled = np.zeros(k, np.uint64), np.zeros(k, bool)
        out[at[order]] = dart[order]
        filled[at] = True
        if filled.all():
            return out
        reach *= 2


def band_keys(units: np.ndarray) -> np.ndarray:
    sig = signature(units).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        key = mix64(key * _DART + sig[:, r])
    return key.view(np.int64)


def _sign(columns: dict[str, list]) -> dict[str, list]:
    keys, bands, seen = [], [], {}
    for t in columns["text"]:
        key = hashlib.md5((t or "").encode("utf-8", "surrogatepass")).digest()
        if key not in seen:
            units = regions(t)
            seen[key] = band_keys(units).tolist() if len(units) else []
        keys.append(key)
        bands.append(seen[key])
    return {"key": keys, "bands": bands}


def signatures(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, key (equal for equal texts), bands."""
    return arrow_pass(pick(docs, doc_id="long", text="string"), _sign, "key binary, bands array<long>", keep=("doc_id",))


def text_key(text="text"):
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _regions(columns: dict[str, list]) -> dict[str, list]:
    return {"regions": [regions(t).tobytes() for t in columns["text"]]}


def _compare(columns: dict[str, list]) -> dict[str, list]:
    known: dict[bytes, np.ndarray] = {}
    out = []
    for a, b, ra, rb in zip(columns["a"], columns["b"], columns["regions_a"], columns["regions_b"]):
        if a not in known:  # pairs of one hub stand together
            known = {a: np.frombuffer(ra, np.uint64)}
        out.append(similarity(known[a], np.frombuffer(rb, np.uint64)))
    return {"similarity": out}


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with their similarity. ``texts``: key and regions of each text, so that a text is
    taken apart once and not for each of its pairs. A hub with many partners is a hot key on the left of
    a plain equi-join, which adaptive execution splits."""
    with_b = pairs.join(texts.select(F.col("key").alias("b"), F.col("regions").alias("regions_b")), "b")
    both = with_b.join(texts.select(F.col("key").alias("a"), F.col("regions").alias("regions_a")), "a")
    return arrow_pass(both.select("a", "b", "regions_a", "regions_b"), _compare, "similarity double", keep=("a", "b"), text="regions_b", reads=("a", "b"))


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a, b): key, label (the least key of its component).
    Labels go along the links and jump to their label's label; each step is a written table. The rows are
    narrow: an eighth of the shuffle's partitions hold them."""
    few = max(16, int(links.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)

    def cut(df: DataFrame, name: str) -> DataFrame:
        return cut_lineage(df.coalesce(few), name)

    both = cut(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = cut(both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        told = (both.join(labels.select(F.col("key").alias("b"), "label"), "b").groupBy(F.col("a").alias("key")).agg(F.min("label").alias("told")))
        near = labels.join(told, "key").select("key", F.col("label").alias("old"), F.least("label", "told").alias("label"))
        jump = labels.select(F.col("key").alias("label"), F.col("label").alias("beyond"))
        new = cut(near.join(jump, "label", "left").select("key", "old", F.least("label", F.coalesce("beyond", "label")).alias("label")), "labels")
        if new.where("label <> old").isEmpty():
            return new.select("key", "label")
        labels = new.select("key", "label")


def _group_links(least: float):
    """The links that join classes within one group of a bucket's members (key, label, regions): each member
    is compared with all that follow it and are of another class by then; what joins no classes isn't told."""
    def work(table: pa.Table) -> pa.Table:
        keys, labels = table.column("key").to_pylist(), table.column("label").to_pylist()
        sets = [np.frombuffer(r, np.uint64) for r in table.column("regions").to_pylist()]
        sizes = np.array([len(x) for x in sets])
        number = {x: i for i, x in enumerate(dict.fromkeys(labels))}
        of = np.array([number[x] for x in labels])
        whole, first = np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)[:-1]])
        found = []
        for i in range(len(keys) - 1):
            fits = np.minimum(sizes[i], sizes[i + 1:]) >= least * np.maximum(sizes[i], sizes[i + 1:])
            if not (fits & (of[i + 1:] != of[i])).any():
                continue
            rest = whole[first[i + 1]:]
            at = np.searchsorted(sets[i], rest)
            both = np.add.reduceat((sets[i][np.minimum(at, sizes[i] - 1)] == rest).astype(np.int64), first[i + 1:] - first[i + 1])
            alike = both >= least * (sizes[i] + sizes[i + 1:] - both)
            for j in np.flatnonzero(alike) + i + 1:
                if of[j] != of[i]:
                    found.append((keys[i], keys[j]))
                    of[of == of[j]] = of[i]
        return pa.table({"a": pa.array([min(f) for f in found], pa.binary()), "b": pa.array([max(f) for f in found], pa.binary())})

    return work


def _several(members: DataFrame, labels: DataFrame, more_than: int) -> tuple[DataFrame, DataFrame]:
    """(``members`` with their label; band and n of the buckets of ``more_than`` members that hold several classes)."""
    named = members.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    several = named.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n")).where("lo <> hi")
    return named, several.where(F.col("n") > more_than).select("band", "n")


def _unsettled(members: DataFrame, texts: DataFrame, labels: DataFrame, turn: int, least: float) -> DataFrame:
    """Links within buckets that hold several classes. ``members``: band, key. A bucket of more than GROUP_ROWS
    members is dealt out to groups of about that size, anew in each turn; after the first turn only these
    are gone through again."""
    named, several = _several(members, labels, GROUP_ROWS if turn > 1 else 1)
    salt = F.pmod(F.xxhash64("key", "band", F.lit(turn)), F.ceil(F.col("n") / GROUP_ROWS))
    rows = named.join(cut_lineage(several, "open"), "band").withColumn("salt", salt).drop("n").join(texts, "key")
    return rows.groupBy("band", "salt").applyInArrow(_group_links(least), "a binary, b binary").distinct()


def _cells(columns: dict[str, list]) -> dict[str, list]:
    cell, n = np.unique(np.concatenate([np.frombuffer(r, np.uint64) for r in columns["regions"]]) % np.uint64(CELLS), return_counts=True)
    return {"cell": cell.astype(np.int64), "n": n}


def rarest(units: np.ndarray, counts: np.ndarray, least: float) -> tuple[np.ndarray, int]:
    """The regions that stand first in the order of ``counts`` (per cell), so many that two texts of similarity ``least``
    share one: they have least * size regions in common at least, and the first of these has so many from it on. For the
    shorter of the two, it stands among fewer, whose number comes second: the other's size is its own at least."""
    order = np.lexsort((units, counts[(units % np.uint64(CELLS)).astype(np.int64)]))
    n, short = len(units), 2 * least / (1 + least)
    return units[order[:n - int(np.ceil(least * n - 1e-9)) + 1]], n - int(np.ceil(short * n - 1e-9)) + 1


def _rare_links(members: DataFrame, texts: DataFrame, labels: DataFrame, least: float) -> DataFrame | None:
    """All links between classes in buckets of more than GROUP_ROWS members, or None if there is no such bucket.

    Members that share one of their rarest regions make a group (groups of the same members count once), where it is
    among the fewer ones (first) of one. A group of more than GROUP_ROWS is dealt into chunks of half of that, which meet in
    pairs, without those that need no comparison: two of its largest class (top), and two that don't have it first."""
    named, several = _several(members, labels, GROUP_ROWS)
    several = cut_lineage(several, "large")
    if several.isEmpty():
        return None
    left = named.join(several.select("band"), "band").select("key", "label").distinct()
    left = cut_lineage(left.join(texts, "key"), "left")
    counts = np.zeros(CELLS, np.int64)
    for r in arrow_pass(left.select("regions"), _cells, "cell long, n long", text="regions").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[r["cell"]] = r["n"]

    def work(columns: dict[str, list]) -> dict[str, list]:
        got = [rarest(np.frombuffer(r, np.uint64), counts, least) for r in columns["regions"]]
        return {"*": np.repeat(np.arange(len(got)), [len(g) for g, _ in got]), "rare": np.concatenate([g.view(np.int64) for g, _ in got]),
                "first": np.concatenate([np.arange(len(g)) < n for g, n in got])}

    rows = cut_lineage(arrow_pass(left, work, "rare long, first boolean", keep=("key", "label"), text="regions"), "rare")
    half = GROUP_ROWS // 2
    xors = [F.bit_xor(F.xxhash64("key", "first", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    of_class = rows.groupBy("rare", "label").agg(F.count("*").alias("n"), F.count_if("first").alias("firsts"), *xors)
    groups = of_class.groupBy("rare").agg(F.count("*").alias("classes"), F.sum("n").alias("n"), F.sum("firsts").alias("firsts"), F.max(F.struct("n", "firsts", "label")).alias("top"),
                                          *[F.bit_xor(x).alias(x) for x in ("x1", "x2")])
    groups = groups.where("classes > 1 AND firsts > 0").groupBy("x1", "x2", "n", "firsts", "top").agg(F.min("rare").alias("rare"))
    # chunks in this order: top without first, top with first, others with first, others without
    sizes = ["top.n - top.firsts", "top.firsts", "firsts - top.firsts", "n - top.n - firsts + top.firsts"]
    ends = [F.expr("+".join(f"ceil(({x}) / {half})" for x in sizes[:k + 1])).alias(f"e{k}") for k in range(4)]
    groups = cut_lineage(groups.select("rare", (F.col("n") <= GROUP_ROWS).alias("small"), F.col("top.label").alias("top"), F.lit(0).cast("long").alias("e"), *ends), "groups")
    top, lot, first = F.col("label") == F.col("top"), F.xxhash64("key", "rare"), F.col("first")

    def by_kind(*of: Column) -> Column:
        return F.when(top & ~first, of[0]).when(top, of[1]).when(first, of[2]).otherwise(of[3])

    start, end = by_kind(*map(F.col, ("e", "e0", "e1", "e2"))), by_kind(*map(F.col, ("e0", "e1", "e2", "e3")))
    lo, hi = by_kind(*map(F.col, ("e1", "e1", "e", "e0"))), by_kind(*map(F.col, ("e2", "e3", "e3", "e2"))) - 1
    me = F.when(F.col("small"), F.lit(-1)).otherwise(start + F.pmod(lot, end - start))
    meets = F.when(F.col("small"), F.array(F.lit(-2).cast("long"))).when(lo <= hi, F.sequence(lo, hi))
    dealt = rows.join(groups, "rare").withColumn("me", me.cast("long")).withColumn("other", F.explode(meets)).where("me <> other")
    dealt = dealt.select("rare", F.least("me", "other").alias("lo"), F.greatest("me", "other").alias("hi"), "key", "label")
    return dealt.join(texts, "key").groupBy("rare", "lo", "hi").applyInArrow(_group_links(least), "a binary, b binary").distinct()


def merged(labels: DataFrame, found: DataFrame) -> DataFrame:
    """``labels`` (key, label) after more links: components of the classes that they join."""
    one, two = (labels.select(F.col("key").alias(c), F.col("label").alias(f"l{c}")) for c in "ab")
    joined = found.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).where("a <> b").distinct()
    classes = components(joined)
    renamed = classes.select(F.col("key").alias("label"), F.col("label").alias("now"))
    old = labels.join(renamed, "label", "left").select("key", F.coalesce("now", "label").alias("label"))
    return cut_lineage(old.unionByName(classes.join(labels.select("key"), "key", "left_anti")), "labels")


def near_classes(docs: DataFrame, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(signature rows: doc_id, key, bands; members of classes of two or more documents: key,
    label, class_id, class_size)."""
    rows = cut_lineage(signatures(docs), "signatures")
    once = rows.groupBy("key").agg(F.first("bands").alias("bands")).select("key", F.explode("bands").alias("band"))
    hubs = cut_lineage(once.groupBy("band").agg(F.min("key").alias("hub"), F.count("*").alias("n")).where("n > 1"), "hubs")
    members = cut_lineage(once.join(hubs, "band"), "members")  # only what shares a bucket
    pairs = cut_lineage(members.where("hub <> key").select(F.col("hub").alias("a"), F.col("key").alias("b")).distinct(), "pairs")
    needed = members.select("key").distinct()
    texts = pick(docs, text="string").select(text_key().alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    texts = cut_lineage(texts.join(broadcast_checked(cut_lineage(needed, "needed")), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
                        .transform(lambda df: arrow_pass(df, _regions, "regions binary", keep=("key",))), "texts")
    members = members.select("band", "key")

    tested = cut_lineage(compared(pairs, texts), "compared")
    labels = components(tested.where(F.col("similarity") >= least).select("a", "b"))
    turn = 0
    while True:
        turn += 1
        found = cut_lineage(_unsettled(members, texts, labels, turn, least), "found")
        if found.isEmpty():
            break
        labels = merged(labels, found)
    found = _rare_links(members, texts, labels, least)
    if found is not None and not (found := cut_lineage(found, "found")).isEmpty():
        labels = merged(labels, found)

    keys = rows.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")).join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    keys = cut_lineage(keys, "keys")
    classes = cut_lineage(keys.groupBy("label").agg(F.min("first").alias("class_id"), F.sum("copies").alias("class_size")).where("class_size > 1"), "classes")
    return rows, cut_lineage(keys.join(classes, "label").select("key", "label", "class_id", "class_size"), "class-members")


def find(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, class_id (the least doc_id of its class), class_size, kept."""
    rows, members = near_classes(docs)
    return (rows.select("doc_id", "key").join(members, "key", "left")
            .select("doc_id", F.when(F.col("class_size").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("class_size", F.lit(1)).alias("class_size"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id"))))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class, with all its columns: the one with the least doc_id."""
    _, members = near_classes(docs)
    mark = "__"
    while any(c.lower().startswith(mark) for c in docs.columns):  # the documents may have columns of any name
        mark += "_"
    key, label, class_id = (mark + n for n in ("key", "label", "class"))
    named = [F.col("key").alias(key), F.col("label").alias(label), F.col("class_id").alias(class_id)]
    marked = docs.withColumn(key, text_key()).join(broadcast_checked(members.select(*named)), key, "left")
    alone = marked.where(F.col(label).isNull()).select(*docs.columns)
    # repeated rows and repeated ids of one class: only one of them stays
    least = marked.where(F.col(label).isNotNull() & F.col("doc_id").eqNullSafe(F.col(class_id))).dropDuplicates([label])
    return alone.unionByName(least.select(*docs.columns))
