"""Language identification by compression.

For each language a zstandard dictionary of raw content is put together from a bounded sample of
labelled texts. A text, in lower case, is cut into blocks; each block is compressed once per language with that
dictionary, and the language with the fewest bytes over all blocks wins. Blocks keep the
dictionary's part in the result the same for long texts, whose own history would take its place.

Special cases: a null text, and one without a letter, is ``und`` with score 0; texts without any
learned language (no labelled text at all) are ``und`` as well; equal sizes are settled by the
smaller size at a higher level, then by the languages' names. Repeated rows are judged alike. A long text is compressed
block by block, whole; an empty table gives none; further columns may have any name and are ignored."""

from __future__ import annotations

from dataclasses import dataclass

import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import arrow_pass, pick, sampled

#: Labelled texts taken per language, at most (the bound of the sample that is fitted on).
SAMPLE_DOCS = 400
#: Bytes of a language's dictionary, at most.
DICTIONARY_BYTES = 112 * 1024
BLOCK_BYTES = 2048
LEVEL = 9
#: Level that settles equal sizes.
FINE_LEVEL = 16
#: Least saving over the second best language, as a share of its size.
MARGIN = 0.004
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")


def assemble(texts: list[str], size: int = DICTIONARY_BYTES) -> bytes:
    """Raw dictionary content: the texts one after another, each with no more than an eighth of
    the whole, until it is full."""
    out, total = [], 0
    for t in texts:
        piece = t.lower().encode("utf-8", "replace")[:size // 8]
        if total + len(piece) > size:
            piece = piece[:size - total]
        if piece:
            out.append(piece)
            total += len(piece) + 1
        if total >= size:
            break
    return b"\n".join(out)


@dataclass(frozen=True)
class Compressors:
    """The model: one dictionary per language, in the order of their names."""

    dictionaries: tuple[tuple[str, bytes], ...]

    def ready(self) -> list[tuple[str, zstandard.ZstdCompressor, zstandard.ZstdCompressor]]:
        """The compressors, made once per Python worker."""
        if _READY.get("of") != self.dictionaries:
            made = []
            for name, content in self.dictionaries:
                pair = []
                for level in (LEVEL, FINE_LEVEL):
                    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                    d.precompute_compress(level=level)
                    pair.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
                made.append((name, *pair))
            _READY.update(of=self.dictionaries, made=made)
        return _READY["made"]

    def sizes(self, text: str, fine: bool = False) -> list[tuple[int, str]]:
        data = text.lower().encode("utf-8", "replace")
        blocks = [data[i:i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        return sorted((sum(len((slow if fine else quick).compress(b)) for b in blocks), name) for name, quick, slow in self.ready())

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """The language, a score from 0 to 1, and whether the margin is wide enough."""
        if text is None or not self.dictionaries or not _LETTER.search(text):
            return UNKNOWN, 0.0, False
        sizes = self.sizes(text)
        if len(sizes) > 1 and sizes[0][0] == sizes[1][0]:
            sizes = self.sizes(text, fine=True)
        if len(sizes) == 1:
            return sizes[0][1], 1.0, True
        (best, name), (second, _) = sizes[:2]
        margin = (second - best) / max(1, second)
        return name, margin / (margin + 0.02), margin >= MARGIN


_READY: dict = {}


def learn(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Compressors:
    """``labelled``: doc_id, text, lang. Rows without text or lang are left out."""
    rows = pick(labelled, doc_id="long", text="string", lang="string").where("text IS NOT NULL AND lang IS NOT NULL AND length(trim(text)) > 0")
    # a few hundred texts per language, of an eighth of a dictionary each at most
    few = sampled(rows, "lang", "doc_id", sample_docs).select("lang", "doc_id", F.substring("text", 1, DICTIONARY_BYTES // 8).alias("text"))
    texts: dict[str, list] = {}
    for r in few.collect():
        texts.setdefault(r["lang"], []).append((r["doc_id"] is None, r["doc_id"], r["text"]))
    return Compressors(tuple((name, assemble([t for *_, t in sorted(rows)])) for name, rows in sorted(texts.items())))


def training_rows(docs: DataFrame) -> DataFrame:
    """The rows that may be learned from: checksum of the id not divisible by five."""
    return docs.where(~held_out())


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def predict(docs: DataFrame, model: Compressors, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    def work(columns: dict[str, list]) -> dict[str, list]:
        got = [model.predict(t) for t in columns["text"]]
        return {"lang_pred": [g[0] for g in got], "score": [g[1] for g in got], "accepted": [g[2] for g in got]}

    return arrow_pass(docs, work, "lang_pred string, score double, accepted boolean", keep=keep)


def identify(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, accepted."""
    rows = pick(docs, doc_id="long", text="string", lang="string")
    model = learn(training_rows(rows))
    return predict(rows.select("doc_id", "text"), model).withColumn("held_out", held_out())


def keep_known(docs: DataFrame) -> DataFrame:
    """The documents whose language is told with a wide enough margin, with all their columns."""
    model = learn(training_rows(docs))

    def work(columns: dict[str, list]) -> dict[str, list]:
        return {"*": [i for i, t in enumerate(columns["text"]) if model.predict(t)[2]]}

    return arrow_pass(docs, work, "", keep=docs.columns)
