"""Language identification by compression.

Each language has a zstandard raw-content dictionary cut from its own texts. A text is
compressed with every dictionary, and the one that makes it smallest names the language.
The margin, the share of bytes the best saves over the second best, says how sure that
is; narrow margins are rejected.
"""

from __future__ import annotations

import re

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.storage import filter_batches, map_batches

UNKNOWN = "und"
DICTIONARY_BYTES = 96 * 1024
PRIMER_BYTES = 2048
BLOCK_BYTES = 4000
SHORT_BYTES = 300
LEVEL = 9
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters_only(text: str | None) -> str:
    """Lower-cased words parted by single spaces; empty if the text has no letter."""
    plain = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    return plain if any(map(str.isalpha, plain)) else ""


class CompressionClassifier:
    """Compares compressed sizes under the dictionaries of several languages.

    `sources` maps a language to sample text: (dictionary, primer). Texts are compressed
    in blocks, so that every part of a long one is held against the dictionary. A short
    text is compressed behind the language's primer, whose size is taken off, because
    alone it would be stored as it is.
    """

    def __init__(self, sources: dict[str, tuple[bytes, bytes]]):
        self.languages = sorted(sources)
        self._tools = []
        for language in self.languages:
            content, primer = sources[language]
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=LEVEL)
            compressor = zstandard.ZstdCompressor(
                level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            self._tools.append((compressor, primer, len(compressor.compress(primer))))

    def sizes(self, plain: bytes) -> list[int]:
        if len(plain) < SHORT_BYTES:
            return [len(c.compress(primer + plain)) - alone for c, primer, alone in self._tools]
        blocks = [plain[at : at + BLOCK_BYTES] for at in range(0, len(plain), BLOCK_BYTES)]
        return [sum(len(c.compress(block)) for block in blocks) for c, _, _ in self._tools]

    def classify(self, text: str | None) -> tuple[str, float]:
        """(language, margin from 0 to 1); ties go to the first language by name."""
        plain = letters_only(text)
        if not plain or not self.languages:
            return UNKNOWN, 0.0
        sizes = self.sizes(plain.encode("utf-8", "replace"))
        if len(sizes) == 1:
            return self.languages[0], 1.0
        best = int(np.argmin(sizes))
        second = min(size for i, size in enumerate(sizes) if i != best)
        return self.languages[best], min(1.0, max(0.0, (second - sizes[best]) / max(second, 1)))


def share_of_each(sizes: list[int], budget: int) -> int:
    """The largest length to which all parts can be cut so that together they fit a budget."""
    left = budget
    for place, size in enumerate(sorted(sizes)):
        share = left // (len(sizes) - place)
        if size > share:
            return share
        left -= size
    return max(sizes, default=0)


def fit(
    docs: DataFrame,
    texts_per_language: int = 400,
    chars_per_text: int = 2000,
    id_col="doc_id",
    text_col="text",
    lang_col="lang",
) -> dict[str, tuple[bytes, bytes]]:
    """Dictionary and primer of every language, from a bounded sample.

    Of the distinct texts with a language whose crc32(id as text) mod 5 is not 0, the
    `texts_per_language` with the smallest hashes of each language are sampled. Each gives
    an excerpt of `chars_per_text` characters, from a place its hash names, and all
    excerpts have the same share of `DICTIONARY_BYTES` and `PRIMER_BYTES` together; what
    short ones leave goes to the others. Null texts, languages and ids teach nothing,
    repeated rows count once, and an empty table gives no language.
    """
    text = F.col(f"`{text_col}`")
    learn = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"), text.alias("text")
    ).where("crc32(cast(id as string)) % 5 != 0 and lang is not null and text is not null")
    learn = learn.withColumn("hash", F.xxhash64("text"))
    counts = learn.select("lang", "hash").distinct().groupBy("lang").agg(F.count("*").alias("texts"))
    place = F.pmod("hash", F.lit(1 << 30)) / (1 << 30)
    start = F.pmod(F.shiftright("hash", 30), F.greatest(F.length("text") - chars_per_text, F.lit(0)) + 1).cast("int") + 1
    # One row per language.
    sample = learn.join(F.broadcast(counts), "lang").where(place * F.col("texts") < max(2 * texts_per_language, 64))
    sample = sample.select("lang", "hash", F.substr("text", start, F.lit(chars_per_text)).alias("text"))
    # About twice the texts wanted of each language, each once.
    sample = sample.groupBy("lang", "hash").agg(F.min("text").alias("text"))
    texts: dict[str, list[bytes]] = {}
    for row in sorted(sample.collect(), key=lambda r: (r["lang"], r["hash"] % (1 << 30), r["hash"])):
        own = texts.setdefault(row["lang"], [])
        if len(own) < texts_per_language and (plain := letters_only(row["text"])):
            own.append(plain.encode("utf-8", "replace"))
    sources = {}
    for lang, own in texts.items():
        share = share_of_each([len(t) + 1 for t in own], DICTIONARY_BYTES + PRIMER_BYTES)
        whole = b"".join(t[: share - 1] + b" " for t in own)
        cut = min(DICTIONARY_BYTES, max(len(whole) - PRIMER_BYTES, len(whole) // 2))
        if own:
            sources[lang] = whole[:cut], whole[cut : cut + PRIMER_BYTES]
    return sources


def identify(docs: DataFrame, sources: dict, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, whole texts; the score is the margin.

    A text that is null or has no letter is `und` with score 0. Rows without an id count
    as held out. Repeated rows get the same answer; an empty table gives an empty result.
    """
    columns = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(sources)

    def start():
        classifier = CompressionClassifier(shared.value)

        def convert(ids, texts):
            found = [classifier.classify(text) for text in texts]
            return {"doc_id": ids, "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

        return convert

    found = map_batches(columns, ["doc_id", "text"], "doc_id long, lang_pred string, score double", start)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def with_clear_language(docs: DataFrame, sources: dict, min_margin: float = 0.005, text_col="text") -> DataFrame:
    """The rows of `docs` whose language is clear, columns unchanged.

    Rejected are texts without letters and those whose margin is under `min_margin`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sources)

    def start():
        classifier = CompressionClassifier(shared.value)

        def accept(texts):
            found = map(classifier.classify, texts)
            return [lang != UNKNOWN and margin >= min_margin for lang, margin in found]

        return accept

    return filter_batches(docs, text_col, start)
