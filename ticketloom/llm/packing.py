"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

A plan needs only how many pieces of each length there are, at most `capacity` numbers,
so it is made on the driver at any corpus size: take the longest piece left, fill its gap
exactly with one, two or three available lengths, else put the best-fitting length in and
try again. Whatever the plan, piece number r of a length finds its place by looking r up
in the plan's ranges; numbers are given without bringing pieces of a length together.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ticketloom.llm.storage import map_batches, stored

WORD_END = "</w>"
WORDS_KEPT = 600_000
TOKENS_KEPT = 8_000_000
# The library takes longer for a word, the longer the text it stands in.
WORDS_AT_ONCE = 50
CHARS_AT_ONCE = 1_000_000
ROWS_AT_ONCE = 1000
REINDEX_AFTER = 32


_LETTERS = re.compile("[a-zªµºß-öø-ÿ]+")
# Kinds of bytes: words are runs of one kind, 0 parts them.
_LOWER = bytes(ord(chr(c).lower()) for c in range(256))
_IN_LATIN = np.array([2 if not _LETTERS.fullmatch(chr(c)) else 1 for c in range(256)], np.uint8)
_IN_OTHERS = np.ones(256, np.uint8)
for _kinds in (_IN_LATIN, _IN_OTHERS):
    _kinds[list(b" \t\n\v\f\r")] = 0


def _in_latin(text: str) -> bytes | None:
    """Latin-1 is lower-cased here as by the tokenizer and parted into runs of letters and
    of other characters, which it never joins, for fewer distinct words. Not so texts with
    an apostrophe, which it may take together with letters, texts that may hold special
    tokens, which are found before lower-casing, and other scripts: these are parted at
    spaces alone.
    """
    if "'" in text or "<|" in text:
        return None
    try:
        return text.encode("latin-1").translate(_LOWER)
    except UnicodeEncodeError:
        return None


def _words(texts: list[bytes], kinds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Parts of texts whose ids, in turn, are the texts', and how many each text has."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    kind = kinds[data]
    # Bytes throughout: beside a plain 0 each would become eight.
    starts = np.flatnonzero(np.diff(kind, prepend=np.uint8(0)))
    lengths = np.diff(starts, append=len(data))
    real = kind[starts] > 0
    starts, lengths = starts[real], lengths[real]
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[kind > 0])]
    words = pa.Array.from_buffers(pa.large_binary(), len(lengths), buffers)
    ends = np.cumsum([len(text) + 1 for text in texts])
    return words, np.diff(np.searchsorted(starts, ends), prepend=0)


def _as_text(words: pa.Array, encoding: str) -> list[str]:
    if encoding != "latin-1":
        return [word.decode(encoding) for word in words.to_pylist()]
    # A byte is a character, so all words are decoded at once.
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1].tolist()
    text = data.to_pybytes().decode(encoding)
    return [text[start:end] for start, end in zip(ends, ends[1:])]


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class WordCachingEncoder:
    """Token ids of whole texts, encoding each distinct word once while it is kept.

    For tokenizers that drop white space and never make a token across it: a text's ids
    are then those of its words in turn. Words not seen before are encoded together. Where
    a word of letters ends is told by the tokenizer's end-of-word ids; other words are
    parted by a character that it turns into one id of its own.
    """

    def __init__(self, path: str):
        # One task has one core; the library's thread pool would only cost memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(path)
        self._mark, self._mark_id = next(
            (mark, ids[0])
            for mark in map(chr, range(1, 9))
            if len(ids := self._ids(mark)) == 1
        )
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values()) + 1
        self._last, self._is_mark = np.zeros(size, bool), np.zeros(size, bool)
        self._last[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self._is_mark[self._mark_id] = True
        self._forget()

    def _forget(self) -> None:
        self._slots = _Numbers()
        self._starts = np.zeros(0, np.int64)
        self._lengths = np.zeros(0, np.int64)
        self._pool = np.zeros(0, np.uint32)

    def _ids(self, text: str) -> list[int]:
        return self._tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, words: list[str]) -> None:
        """Put the ids of newly numbered words into the pool."""
        ends_told = self._last.any()
        kinds = [2 if self._mark in w else 0 if ends_told and _LETTERS.fullmatch(w) else 1 for w in words]
        order = np.argsort(kinds, kind="stable")
        letters, plain, odd = ([w for w, k in zip(words, kinds) if k == kind] for kind in range(3))
        parts = [
            self._encode_together(letters, " ", self._last, keep_ends=True),
            self._encode_together(plain, f" {self._mark} ", self._is_mark, keep_ends=False),
            *(self._encode_alone(w) for w in odd),
        ]
        lengths = np.concatenate([lengths for _, lengths in parts])
        starts = len(self._pool) + np.cumsum(lengths) - lengths
        own = np.argsort(order)
        self._starts = np.concatenate([self._starts, starts[own]])
        self._lengths = np.concatenate([self._lengths, lengths[own]])
        self._pool = np.concatenate([self._pool, *(ids for ids, _ in parts)])

    def _encode_together(self, words, after: str, ends: np.ndarray, keep_ends: bool):
        """Ids of all words, and how many each has, told by the ids that end a word."""
        groups = [
            after.join(words[at : at + WORDS_AT_ONCE]) + after for at in range(0, len(words), WORDS_AT_ONCE)
        ]
        found = self._tokenizer.encode_batch_fast(groups, add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, np.uint32), *(np.array(e.ids, np.uint32) for e in found)])
        last = ends[ids]
        lengths = np.diff(np.flatnonzero(last), prepend=-1)
        return (ids, lengths) if keep_ends else (ids[~last], lengths - 1)

    def _encode_alone(self, word: str):
        ids = np.array(self._ids(word), np.uint32)
        return ids, np.array([len(ids)])

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text, a bounded stretch of text at a time."""
        some, size = [], 0
        for text in texts:
            some.append(text or "")
            size += len(some[-1])
            if size > CHARS_AT_ONCE:
                yield from self._encode(some)
                some, size = [], 0
        if some:
            yield from self._encode(some)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self._slots) > WORDS_KEPT or len(self._pool) > TOKENS_KEPT:
            self._forget()
        latin = [_in_latin(text) for text in texts]
        if None not in latin:
            return self._encode_alike(latin, _IN_LATIN, "latin-1")
        others = [text.encode() for text, own in zip(texts, latin) if own is None]
        others = iter(self._encode_alike(others, _IN_OTHERS, "utf-8"))
        in_latin = iter(self._encode_alike([own for own in latin if own is not None], _IN_LATIN, "latin-1"))
        return [next(others if own is None else in_latin) for own in latin]

    def _encode_alike(self, texts: list[bytes], kinds: np.ndarray, encoding: str) -> list[np.ndarray]:
        if not texts:
            return []
        words, counts = _words(texts, kinds)
        coded = words.dictionary_encode()
        distinct = _as_text(coded.dictionary, encoding)
        slots = np.fromiter(map(self._slots.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        if self._slots.new:
            self._learn(self._slots.new)
            self._slots.new = []
        lengths = self._lengths[slots]
        ends = np.cumsum(lengths)
        at = np.repeat(self._starts[slots] - (ends - lengths), lengths) + np.arange(lengths.sum())
        bounds = np.append(0, ends)[np.cumsum(counts)]
        return np.split(self._pool[at], bounds[:-1])


@functools.lru_cache(maxsize=1)
def kept_encoder(tokenizer_path: str) -> WordCachingEncoder:
    """One encoder for all tasks that a Python worker runs: they share their words."""
    return WordCachingEncoder(tokenizer_path)


def tokenized_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 1,
    id_col="doc_id",
    text_col="text",
    keep_ids: bool = False,
) -> DataFrame:
    """Every document as pieces of at most `capacity` ids, its end id included.

    Columns: doc_id, piece, start, length, ids_crc32, `part` and `place` (the piece is the
    `place`-th of its length in its part), with `keep_ids` also ids. Only documents longer
    than `capacity` have more than one piece. Null and empty texts are the end id alone.
    """

    def start():
        encoder = kept_encoder(tokenizer_path)
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        seen = np.zeros(capacity + 1, np.int64)

        def convert(doc_ids, texts):
            out = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32", "place", "ids")}
            for doc_id, ids in zip(doc_ids, encoder.encode(texts)):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for piece, first in enumerate(range(0, len(ids), capacity)):
                    own = ids[first : first + capacity]
                    row = (doc_id, piece, first, len(own), zlib.crc32(own.tobytes()), seen[len(own)])
                    for column, value in zip(out.values(), (*row, own if keep_ids else None)):
                        column.append(value)
                    seen[len(own)] += 1
            return out | {"part": [part] * len(out["piece"])}

        return convert

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"
    if keep_ids:
        schema += ", ids array<int>"
    columns = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(columns, ["doc_id", "text"], schema, start, ROWS_AT_ONCE)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Sequences as (lengths, how many alike), using up all `counts` of piece lengths."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    there, sums, stale, made = left > 0, None, 0, []
    longest = capacity
    while True:
        while longest and not left[longest]:
            longest -= 1
        if not longest:
            return made
        if sums is None or stale >= REINDEX_AFTER:
            sums, stale = _pair_sums(there, capacity), 0
        lengths, gap = [longest], capacity - longest
        while gap:
            fill = _exact_fill(gap, left, there, sums, Counter(lengths))
            if not fill:
                free = there[: gap + 1].copy()
                for length, used in Counter(lengths).items():
                    if length <= gap and left[length] <= used:
                        free[length] = False
                fits = np.flatnonzero(free)
                if not len(fits):
                    break
                fill = [int(fits[-1])]
            lengths += fill
            gap -= sum(fill)
        used = Counter(lengths)
        alike = min(int(left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= alike * n
            if not left[length]:
                there[length] = False
                stale += 1
        made.append((lengths, alike))


def _pair_sums(there: np.ndarray, capacity: int) -> np.ndarray:
    """Which sums two available lengths make. May name too many later, never too few."""
    hits = np.fft.irfft(np.fft.rfft(there.astype(float), 2 * capacity + 2) ** 2, 2 * capacity + 2)
    return hits[: capacity + 1] > 0.5


def _exact_fill(gap, left, there, sums, used: Counter) -> list[int] | None:
    """One, two or three available lengths that fill the gap, the largest first."""

    def available(lengths) -> bool:
        return all(left[x] >= n + used[x] for x, n in Counter(lengths).items())

    def pair(total, most, beside=()):
        first = np.arange(min(total - 1, most), (total - 1) // 2, -1)
        for a in first[there[first] & there[total - first]]:
            if available([*beside, int(a), total - int(a)]):
                return [int(a), total - int(a)]
        return None

    if there[gap] and available([gap]):
        return [gap]
    if gap > 1 and sums[gap] and (found := pair(gap, gap)):
        return found
    first = np.arange(gap - 2, (gap + 2) // 3 - 1, -1)
    for a in first[there[first] & sums[gap - first]] if gap > 2 else ():
        if found := pair(gap - int(a), int(a), [int(a)]):
            return [int(a), *found]
    return None


def plan_ranges(sequences: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """The plan as ranges of piece numbers, ordered by length and first number."""
    taken: Counter = Counter()
    rows, base = [], 0
    for lengths, alike in sequences:
        offset = 0
        for length in lengths:
            rows.append((length, taken[length], base, offset))
            taken[length] += alike
            offset += length
        base += alike
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return dict(zip(("length", "first", "sequence", "offset"), table.T))


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 1,
    id_col="doc_id",
    text_col="text",
    keep_ids: bool = False,
) -> DataFrame:
    """Tokenize and pack: one row per piece with its sequence and the offset in it.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset and, with
    `keep_ids`, ids. Offsets are gapless from 0 in each sequence. Repeated rows and rows
    without an id are packed like others; an empty table gives an empty result.
    """
    pieces = stored(
        tokenized_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, keep_ids), "pieces"
    )
    per_part = stored(pieces.groupBy("length", "part").agg(F.count("*").alias("pieces")), "parts")
    # One row per length at most: `capacity` rows.
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("pieces").alias("n")).collect()}
    ranges = plan_ranges(plan(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select(
        "length", "part", F.coalesce(F.sum("pieces").over(earlier), F.lit(0)).alias("before")
    )
    numbered = pieces.join(before, ["length", "part"]).select(
        *(c for c in pieces.columns if c not in ("part", "place")),
        (F.col("before") + F.col("place")).alias("number"),
    )
    step = 1 << 44
    keys = ranges["length"] * step + ranges["first"]

    def place(frames):
        for frame in frames:
            number = frame.pop("number").to_numpy()
            at = np.searchsorted(keys, frame["length"].to_numpy() * step + number, side="right") - 1
            frame["sequence_id"] = ranges["sequence"][at] + number - ranges["first"][at]
            frame["offset"] = ranges["offset"][at]
            yield frame

    kinds = {**dict(numbered.dtypes), "sequence_id": "bigint", "offset": "bigint"}
    schema = ", ".join(f"`{name}` {kind}" for name, kind in kinds.items() if name != "number")
    return numbered.mapInPandas(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, from `pack(keep_ids=True)`.

    A group is one sequence, so at most `capacity` ids.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    packed = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return packed.select("sequence_id", F.flatten("parts.ids").alias("ids"))
