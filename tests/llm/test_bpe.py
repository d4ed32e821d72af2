import base64
import hashlib
import random

import public_tokenizers
import tiktoken
from riverbed.llm import bpe
from tests.llm.fixtures import empty, frame, rows

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_library_and_exact_round_trip(spark):
    lib = library()
    got = {r.doc_id: r for r in bpe.encode(frame(spark, extra=True), PATH, public_tokenizers.PATTERN, ids=True).collect()}
    for i, t, *_ in rows():
        ids = lib.encode_ordinary(t or "")
        assert got[i].ids == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded == (t or "") and got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_random_strings():
    lib, own = library(), bpe.codec(PATH, public_tokenizers.PATTERN)
    r = random.Random(4)
    alphabet = list("abcdeéß's 're'll  \t\n\r\x0b\x1c\x1f\x85   　​0123٣½。,.!?-_😀中文字")
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(3000)]
    for t, (n, ids, decoded) in zip(texts, own.encode(texts)):
        want = lib.encode_ordinary(t)
        assert ids == ",".join(map(str, want)) and n == len(want) and decoded == t.encode()


def test_texts_are_put_together_from_distinct_chunks():
    """A run's chunks are told apart once for all its texts, cut by Arrow or, where a space stands before white space, by the pattern."""
    own = bpe.codec(PATH, public_tokenizers.PATTERN)
    r = random.Random(6)
    plain = ["", " ", "a", " a", "a ", "a b a", "x\ny z", *("".join(r.choice(["ab", " é", "c", "\n", " 7"]) for _ in range(r.randrange(40))) for _ in range(300))]
    assert not any(map(own.plain.search, plain))
    for texts, spaces in ((plain, False), ([t.replace("c", "  ") + " \n" for t in plain], True), ([], False), ([], True)):
        distinct, numbers, bounds = own.distinct_chunks(texts, spaces)
        assert len(set(distinct)) == len(distinct) and len(bounds) == len(texts) + 1
        cut = [[distinct[n] for n in numbers[a:b]] for a, b in zip(bounds, bounds[1:])]
        assert [[m for c in chunks for m in own.match.findall(c)] for chunks in cut] == [own.match.findall(t) for t in texts]
    lib = library()
    mixed = [None, *plain, "a  b", *plain[:9]]
    assert [ids for _, ids, _ in own.encode(mixed)] == [",".join(map(str, lib.encode_ordinary(t or ""))) for t in mixed]


def test_long_matches():
    """One match, on both sides of the length from which a step contracts more; and more letters than one query's steps settle."""
    lib, own = library(), bpe.Codec(PATH, public_tokenizers.PATTERN)
    r = random.Random(8)
    texts = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(n)) for n in (1, 63, 64, 65, 66, 500, 4_000)] + ["ab" * 3000, "a" * 5000, "é" * 777, "!" * 2000 + "?" * 3]
    for t, (n, ids, decoded) in zip(texts, own.encode(texts)):
        want = lib.encode_ordinary(t)
        assert ids == ",".join(map(str, want)) and n == len(want) and decoded == t.encode()


def test_steps_of_a_query_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "LONG_ROWS", 300)
    lib, own = library(), bpe.Codec(PATH, public_tokenizers.PATTERN)
    r = random.Random(9)
    texts = ["".join(r.choice("abcde") for _ in range(n)) for n in (70, 90, 150, 200)] + ["short ones too"]
    assert [ids for _, ids, _ in own.encode(texts)] == [",".join(map(str, lib.encode_ordinary(t))) for t in texts]


def test_small_cache_gives_the_same(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 10)
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 7)
    own = bpe.Codec(PATH, public_tokenizers.PATTERN)
    texts = [t for _, t, *_ in rows()]
    whole = own.encode(texts)
    assert [own.encode([t])[0] for t in texts] == whole


def test_empty_table(spark):
    assert bpe.encode(empty(spark), PATH, public_tokenizers.PATTERN).count() == 0
