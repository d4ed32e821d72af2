import random

import numpy as np
import public_tokenizers
from riverbed.llm import wordids
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def split(got):
    ids, ends = got
    return [part.tolist() for part in np.split(ids, ends[:-1])]


def test_words_part_as_whole_texts_do():
    t = Tokenizer.from_file(PATH)
    own = wordids.WordIds(PATH)
    r = random.Random(3)
    alphabet = [*"aBcdEéÀßÿµªº's.,!|#$&*-\"<>0123½ \n\t\x1c\xa0İſΣσ中😀e\u0301", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "endoftext|>"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(80))) for _ in range(3000)]
    texts += ["<|endoftext|> a", "x<|endoftext|>y <|startoftext|>", "ÇA va!", "don't", None, "", " \n ", "a" * 5000, ("word " * 3000)]
    for _ in range(2):  # the second time from memory
        for text, ids in zip(texts, split(own.encode(texts, 7)), strict=True):
            assert ids == [*t.encode(text or "", add_special_tokens=False).ids, 7]


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(wordids, "MEMORY_WORDS", 50)
    t, own, r = Tokenizer.from_file(PATH), wordids.WordIds(PATH), random.Random(5)
    for _ in range(20):
        texts = [" ".join("".join(r.choice("abcdé") for _ in range(r.randrange(1, 5))) for _ in range(r.randrange(60))) for _ in range(4)] + ["b" * 200]
        assert split(own.encode(texts, 2)) == [[*t.encode(x, add_special_tokens=False).ids, 2] for x in texts]
        assert len(own.known) <= 50


def test_no_texts():
    ids, ends = wordids.WordIds(PATH).encode([], 2)
    assert len(ids) == 0 and len(ends) == 0
