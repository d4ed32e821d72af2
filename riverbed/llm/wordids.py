"""Token ids of whole texts by a tokenizer that drops white space, word by word.

None of such a tokenizer's matches spans white space, so that a text's ids are its words' ids one
after another. A run of texts is cut into words and made distinct by Arrow; only the distinct words are
looked at in Python, and the ids of all occurrences are gathered by index.

Most words are letters with some marks behind them. There the letters, in lower case, are one
match and the marks another one, so that words that differ in case or marks share their letters'
ids, and the letters need none of the tokenizer's own preparation. New ones are given to the tokenizer many in
a text: each ends in an id that closes a word. Every other word goes to the tokenizer as it is; the strings of
special tokens get their ids, as ``encode(..., add_special_tokens=False)`` has it.

A worker remembers the ids of letters, up to MEMORY_WORDS of them; what it remembers is dropped as a
whole beyond that and for another file. Special cases: a null text is an empty one; an empty text has no ids."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Runs of letters that a Python worker remembers, at most (about 150 bytes each), and the longest of them.
MEMORY_WORDS = 400_000
MEMORY_LENGTH = 64
#: Bytes of text that are cut into words together; what is held beside them is about forty times as much.
RUN_BYTES = 2 << 20
#: Words given to the tokenizer as one text.
TOGETHER = 64

# Letters that lower-casing and composition treat alike everywhere, and marks that aren't letters, digits or white space.
_LETTERS = "^[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+$"
_MARKS = ".,;:!?#$%&*|)(\"/-"
_TRIMMED = "".join(chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xc0, 0x100)) if c not in (0xd7, 0xf7))

_READY: dict = {}


def gather(values: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``values[first[i] : first[i] + sizes[i]]`` for each i, one after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(first - ends + sizes, sizes) + np.arange(total)]


def strings(column: pa.Array) -> list[str]:
    """As Python strings; several times as fast as ``to_pylist``."""
    return column.to_numpy(zero_copy_only=False).tolist()


class WordIds:
    """One tokenizer file in one Python worker."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.bare = Tokenizer.from_file(path)
        self.bare.encode_special_tokens = True
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = json.loads(self.whole.to_str())["model"]["end_of_word_suffix"]
        vocabulary = self.whole.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def bare_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of runs of letters, one after another, and how many each has."""
        texts = [" ".join(words[at:at + TOGETHER]) for at in range(0, len(words), TOGETHER)]
        parts = [np.asarray(e.ids, np.uint32) for at in range(0, len(texts), 512) for e in self.bare.encode_batch_fast(texts[at:at + 512], add_special_tokens=False)]
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        ends = np.flatnonzero(self.closes[ids]) + 1
        return ids, np.diff(ends, prepend=0)

    def letters_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per run of letters its first place and size in the ids that come first."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > MEMORY_WORDS:
            self.forget()
            new = words
        ids, size = self.bare_ids(new)
        at, base = len(self.first), len(self.ids)
        every, first, sizes = np.concatenate([self.ids, ids]), np.concatenate([self.first, base + np.cumsum(size) - size]), np.concatenate([self.size, size])
        places = dict(zip(new, range(at, at + len(new))))
        known = self.known
        rows = np.fromiter((places[w] if w in places else known[w] for w in words), np.int64, len(words))
        if at + len(new) <= MEMORY_WORDS and not any(map(MEMORY_LENGTH.__lt__, map(len, new))):
            self.ids, self.first, self.size = every, first, sizes
            known.update(places)
        return every, first[rows], sizes[rows]

    def word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``words`` are distinct: all their ids, and each word's first place and size there."""
        head = pc.utf8_rtrim(words, _MARKS)
        plain = np.asarray(pc.match_substring_regex(head, _LETTERS))
        low = pc.utf8_lower(head.filter(pa.array(plain))).dictionary_encode()
        tail = pc.utf8_ltrim(words.filter(pa.array(plain)), _TRIMMED).dictionary_encode()
        ids, first, size = self.letters_ids(strings(low.dictionary))
        rest = [*strings(tail.dictionary), *strings(words.filter(pa.array(~plain)))]
        rest_ids = [np.asarray(e.ids, np.uint32) for at in range(0, len(rest), 10_000) for e in self.whole.encode_batch_fast(rest[at:at + 10_000], add_special_tokens=False)]
        rest_size = np.fromiter(map(len, rest_ids), np.int64, len(rest_ids))
        values = np.concatenate([ids, *rest_ids])
        rest_first = len(ids) + np.cumsum(rest_size) - rest_size
        # letters and marks are two parts of a word, any other word is one
        a, b = low.indices.to_numpy(), tail.indices.to_numpy()
        parts = np.zeros((len(words), 2, 2), np.int64)
        parts[plain, 0, 0], parts[plain, 0, 1] = first[a], size[a]
        parts[plain, 1, 0], parts[plain, 1, 1] = rest_first[b], rest_size[b]
        n = len(tail.dictionary)
        parts[~plain, 0, 0], parts[~plain, 0, 1] = rest_first[n:], rest_size[n:]
        flat = gather(values, parts[:, :, 0].ravel(), parts[:, :, 1].ravel())
        sizes = parts[:, :, 1].sum(axis=1)
        return flat, np.cumsum(sizes) - sizes, sizes

    def encode(self, texts: list[str | None], closing: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another (little-endian unsigned 32-bit), ``closing`` behind each, and
        where each text's ids end."""
        cut = pc.split_pattern(pc.replace_substring(pa.array([t or "" for t in texts], pa.large_string()), "\n", " "), " ")
        words = cut.flatten().cast(pa.string() if cut.values.nbytes < 1 << 30 else pa.large_string()).dictionary_encode()
        flat, first, sizes = self.word_ids(words.dictionary)
        # the closing id is one more word behind each text's
        first, sizes, flat = np.append(first, len(flat)), np.append(sizes, 1), np.append(flat, np.uint32(closing))
        ends = cut.offsets.to_numpy()[1:] - cut.offsets[0].as_py()
        occurrences = np.insert(words.indices.to_numpy(), ends, len(sizes) - 1)
        counts = sizes[occurrences]
        return gather(flat, first[occurrences], counts).astype("<u4", copy=False), np.cumsum(counts)[ends + np.arange(len(ends))]


def word_ids(path: str) -> WordIds:
    """The encoder of a file; a worker keeps the last one that it used."""
    if _READY.get("path") != path:
        _READY.update(path=path, of=WordIds(path))
    return _READY["of"]
