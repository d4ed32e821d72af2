"""Byte-level BPE encoding and decoding with recursive queries.

A rank file gives a merge table: (left token, right token) -> merged token, whose number is its
rank. A text is cut into the matches of the tokenizer's pattern; the distinct ones of a run of
documents become token-position rows in a DuckDB table of the Python worker, and one recursive
query joins them to the merge table and contracts each match's leftmost pair of least rank until
no pair is left. A second query decodes: the ids join the vocabulary and an ordered aggregation
puts their bytes together. Arrow puts the texts together from their distinct chunks. Spark deals out the documents; nothing is shuffled.

Matches longer than LONG bytes would take a step for each of their merges. For them a step
contracts all occurrences of the pair that don't overlap, from the left, wherever that must give the
same: when the merged token is no part of a pair of lesser rank, contracting one occurrence can't
put another pair before the remaining ones. Such a query makes a bounded number of steps, and the next one goes on with
what it leaves, so that memory follows the length of a match and not the number of its merges.

Matches that a worker has already encoded are remembered, up to CACHE_ENTRIES of them.

Special cases: a null or empty text has no ids, an empty list's digest and empty bytes; very long
texts are cut match by match, so memory follows the number of their distinct matches; repeated
rows give equal rows; there are no ties (a pair's rank is its own, and the leftmost of equal pairs goes first); an empty
table gives none; columns besides doc_id and text are ignored."""

from __future__ import annotations

import base64
import hashlib
import re

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from riverbed.llm.common import arrow_pass, pick

#: Matches that a Python worker remembers, at most (about 300 bytes each); beyond it, those of the run at hand stay.
CACHE_ENTRIES = 900_000
#: Chunks of text between spaces that it remembers, whose matches are among those.
CACHE_CHUNKS = 400_000
#: Matches encoded by one recursive query, at most.
QUERY_WORDS = 40_000
#: Rows that a query over long matches may gather over its steps: it makes fewer steps the longer they are.
LONG_ROWS = 2_000_000
#: Bytes of a match from which on a step contracts more than one pair of it.
LONG = 64

# White space by the Unicode property, which is what the rank files' own library goes by.
_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# A space at most and letters: one match by most patterns.
_PLAIN = re.compile(" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")

#: One sort by match and position a step: a window a match costs more.
CONTRACT = """
WITH RECURSIVE contracted(step, word, pos, token) AS (
  SELECT 0, word, pos, token FROM start_rows
  UNION ALL
  (WITH p AS MATERIALIZED (SELECT *, CASE WHEN lead(word) OVER w = word THEN lead(token) OVER w END AS following, CASE WHEN lag(word) OVER w = word THEN lag(pos) OVER w END AS before
                           FROM contracted WINDOW w AS (ORDER BY (word::BIGINT << 32) | pos)),
        least_pair AS (SELECT p.word, min((m.merged::BIGINT << 32) | p.pos) AS key
                       FROM p JOIN merges m ON m.lefthand = p.token AND m.righthand = p.following GROUP BY p.word)
   SELECT p.step + 1, p.word, p.pos, CASE WHEN p.pos = (key & 4294967295) THEN (key >> 32)::INTEGER ELSE p.token END
   FROM p JOIN least_pair USING (word) WHERE p.before IS NULL OR p.before <> (key & 4294967295))
)
SELECT c.word, c.pos, c.token
FROM contracted c JOIN (SELECT word, max(step) AS last FROM contracted GROUP BY word) f
  ON c.word = f.word AND c.step = f.last
"""
#: ``{steps}``: as many steps as a query makes; what it leaves off with is the next one's start.
CONTRACT_LONG = """
WITH RECURSIVE contracted(step, word, pos, token) AS (
  SELECT 0, word, pos, token FROM start_rows
  UNION ALL
  SELECT step + 1, word, pos, CASE WHEN chosen THEN least_merged ELSE token END
  FROM (SELECT *, lag(chosen) OVER (PARTITION BY word ORDER BY pos) AS absorbed
        FROM (SELECT *, hit AND CASE WHEN alone THEN nth = 1 ELSE row_number() OVER (PARTITION BY word, hit, place - nth ORDER BY pos) % 2 = 1 END AS chosen
              FROM (SELECT *, row_number() OVER (PARTITION BY word, hit ORDER BY pos) AS nth
                    FROM (SELECT *, coalesce(merged = least_merged, false) AS hit
                          FROM (SELECT p.*, m.merged, m.alone, min(m.merged) OVER (PARTITION BY p.word) AS least_merged
                                FROM (SELECT step, word, pos, token, lead(token) OVER (PARTITION BY word ORDER BY pos) AS following,
                                             row_number() OVER (PARTITION BY word ORDER BY pos) AS place
                                      FROM contracted WHERE step < {steps}) p
                                LEFT JOIN merges m ON m.lefthand = p.token AND m.righthand = p.following) j
                          WHERE least_merged IS NOT NULL) h) n) c) a
  WHERE NOT coalesce(absorbed, false)
)
SELECT c.word, c.pos, c.token, f.last
FROM contracted c JOIN (SELECT word, max(step) AS last FROM contracted GROUP BY word) f
  ON c.word = f.word AND c.step = f.last
"""
ENCODED = "SELECT word, array_to_string(list(token ORDER BY pos), ',') AS ids, count(*) AS n FROM fixpoint GROUP BY word ORDER BY word"
DECODED = "SELECT f.word, array_to_string(list(v.hexed ORDER BY f.pos), '') AS hexed FROM fixpoint f JOIN vocabulary v USING (token) GROUP BY f.word ORDER BY f.word"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """All pairs of tokens whose concatenation is a token. ``alone``: the merged token is part of
    a pair of lesser rank than its own."""
    left, right, merged = [], [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                merged.append(rank)
    early = {part for a, b, rank in zip(left, right, merged) for part in (a, b) if part >= rank}
    kind = pa.int32()
    return pa.table({"lefthand": pa.array(left, kind), "righthand": pa.array(right, kind), "merged": pa.array(merged, kind), "alone": [m in early for m in merged]})


class Codec:
    """One vocabulary in one Python worker."""

    def __init__(self, path: str, pattern: str) -> None:
        ranks = read_ranks(path)
        self.bytes_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        spaces = pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]")
        self.match = regex.compile(spaces)
        # a space before a character that isn't white space always begins a match
        self.cut = regex.compile(f" (?=[^{_SPACE}])")
        self.plain = regex.compile(f" (?=[{_SPACE}])")
        # whether letters with a space at most are one match by this pattern
        self.one = all(self.match.findall(x) == [x] for x in (" a", "A", " abc", "ABcd", "abCD", " \xc9a\xdf", "x\xf8Y"))
        self.db = duckdb.connect()
        self.db.execute("SET threads = 1")
        self.db.execute("SET memory_limit = '400MB'")
        self.db.execute("SET temp_directory = ''")
        merges = merge_table(ranks)
        vocabulary = pa.table({"token": pa.array(list(ranks.values()), pa.int32()), "hexed": [t.hex() for t in ranks]})
        for name, rows in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("given", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")
        #: By match, and by chunk (a run of matches between spaces).
        self.coded: dict[str, tuple[str, int, bytes]] = {}
        self.known: dict[str, tuple[str, int, bytes]] = {}

    def chunks(self, text: str) -> list[str]:
        """The text cut where a match begins anyway: before each space that a character other
        than white space follows."""
        starts = [0, *(m.start() for m in self.cut.finditer(text) if m.start()), len(text)]
        return [text[a:b] for a, b in zip(starts, starts[1:])] if text else []

    def distinct_chunks(self, texts: list[str], plain: bool) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct chunks of the texts, the number of each chunk among them in the texts' order, and
        where each text's chunks begin there (and the last one's end). ``plain``: some space stands before white space."""
        if plain:
            cut = [self.chunks(t) for t in texts]
            bounds = np.cumsum([0, *map(len, cut)])
            flat = pa.array([c for chunks in cut for c in chunks], pa.large_string()).dictionary_encode()
            return flat.dictionary.to_pylist(), flat.indices.to_numpy(), bounds
        # every space begins a chunk: Arrow cuts there, and the chunk gets its space back
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        bounds = cut.offsets.to_numpy().astype(np.int64)
        flat = cut.flatten().dictionary_encode()
        parts = flat.dictionary.to_pylist()
        at = flat.indices.to_numpy().astype(np.int64) + len(parts)
        first = bounds[:-1]
        empty = np.zeros(len(at), bool)
        at[first] -= len(parts)
        empty[first] = [not t or t[0] == " " for t in texts]
        gone = np.concatenate([[0], np.cumsum(empty)])
        used, numbers = np.unique(at[~empty], return_inverse=True)
        return [parts[i] if i < len(parts) else " " + parts[i - len(parts)] for i in used.tolist()], numbers, bounds - gone[bounds]

    def contract(self, words: list[str]) -> list[tuple[str, int, bytes]]:
        """Per match: ids joined by commas, their number, the decoded bytes."""
        coded = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, coded), np.int32, len(coded))
        word = np.repeat(np.arange(len(coded), dtype=np.int32), sizes)
        pos = np.arange(len(word), dtype=np.int32) - np.repeat(np.cumsum(sizes, dtype=np.int32) - sizes, sizes)
        token = self.bytes_ids[np.frombuffer(b"".join(coded), np.uint8)]
        self.db.register("start_rows", pa.table({"word": word, "pos": pos, "token": token}))
        if max(map(len, words)) > LONG:
            self.contract_long(max(1, LONG_ROWS // len(token)))
        else:
            self.db.execute(f"CREATE OR REPLACE TEMP TABLE fixpoint AS {CONTRACT}")
        ids = self.db.execute(ENCODED).fetchall()
        decoded = self.db.execute(DECODED).fetchall()
        self.db.unregister("start_rows")
        return [(a, n, bytes.fromhex(d)) for (_, a, n), (_, d) in zip(ids, decoded, strict=True)]

    def contract_long(self, steps: int) -> None:
        """From ``start_rows`` to the fixpoint, ``steps`` steps at a time."""
        query = CONTRACT_LONG.format(steps=steps)
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE fixpoint AS {query}")
        while self.db.execute("SELECT coalesce(max(last), 0) FROM fixpoint").fetchall()[0][0] >= steps:
            self.db.unregister("start_rows")
            self.db.execute("CREATE OR REPLACE TEMP TABLE reached AS SELECT word, pos, token FROM fixpoint")
            self.db.execute("CREATE OR REPLACE TEMP VIEW start_rows AS SELECT * FROM reached")
            self.db.execute(f"CREATE OR REPLACE TEMP TABLE fixpoint AS {query}")
        self.db.execute("DROP VIEW IF EXISTS start_rows")

    def learn(self, here: set[str]) -> None:
        """Make every chunk known: encode the distinct matches of those that aren't yet."""
        missing = sorted(here.difference(self.known))
        plain = _PLAIN.fullmatch
        matches = {c: [c] if self.one and plain(c) else self.match.findall(c) for c in missing}
        distinct = {m for ms in matches.values() for m in ms}
        if len(self.known) + len(missing) > CACHE_CHUNKS:
            self.known = {c: v for c, v in self.known.items() if c in here}
        if len(self.coded) + len(distinct) > CACHE_ENTRIES:
            self.coded = {m: v for m, v in self.coded.items() if m in distinct}
        new = sorted(distinct.difference(self.coded), key=len)
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        ends, short, at = np.cumsum(sizes), int(np.searchsorted(sizes, LONG, side="right")), 0
        while at < len(new):  # few matches together when they are long, and long ones by themselves
            fit = int(np.searchsorted(ends, ends[at] - sizes[at] + 300_000, side="right"))
            stop = max(at + 1, min(at + QUERY_WORDS, fit, short if at < short else len(new)))
            self.coded.update(zip(new[at:stop], self.contract(new[at:stop]), strict=True))
            at = stop
        for c, ms in matches.items():
            got = [self.coded[m] for m in ms]
            self.known[c] = got[0] if len(got) == 1 else (",".join(g[0] for g in got), sum(g[1] for g in got), b"".join(g[2] for g in got))

    def encode(self, texts: list[str | None]) -> list[tuple[int, str, bytes]]:
        """Per text: number of ids, ids joined by commas, decoded bytes."""
        out = [(0, "", b"")] * len(texts)
        groups: tuple[list[int], list[int]] = ([], [])
        for i, t in enumerate(texts):
            groups[self.plain.search(t or "") is not None].append(i)
        for plain, rows in enumerate(groups):
            distinct, numbers, bounds = self.distinct_chunks([texts[i] or "" for i in rows], bool(plain))
            self.learn(set(distinct))
            ids, counts, decoded = zip(*map(self.known.__getitem__, distinct)) if distinct else ((), (), ())
            total = np.concatenate([[0], np.cumsum(np.array(counts, np.int64)[numbers])])[bounds]
            joined = [pc.binary_join(pa.LargeListArray.from_arrays(bounds, pa.array(x, t).take(pa.array(numbers))), pa.scalar(by, t)).to_pylist()
                      for x, t, by in ((ids, pa.large_string(), ","), (decoded, pa.large_binary(), b""))]
            for i, *got in zip(rows, np.diff(total).tolist(), *joined):
                out[i] = tuple(got)
        return out


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, ids: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if ``ids``, the ids themselves
    and the decoded text. ``path`` must be readable on every executor, or be a name that was given
    to ``SparkContext.addFile``."""
    def work(columns: dict[str, list]) -> dict[str, list]:
        got = codec(path if "/" in path else SparkFiles.get(path), pattern).encode(columns["text"])
        out = {
            "n_tokens": [n for n, *_ in got],
            "ids_sha256": [hashlib.sha256(i.encode()).hexdigest() for _, i, _ in got],
            "decoded_sha256": [hashlib.sha256(d).hexdigest() for *_, d in got],
        }
        if ids:
            out |= {"ids": [list(map(int, i.split(","))) if i else [] for _, i, _ in got], "decoded": [d.decode("utf-8", "replace") for *_, d in got]}
        return out

    made = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if ids else "")
    return arrow_pass(pick(docs, doc_id="long", text="string"), work, made, keep=("doc_id",))
