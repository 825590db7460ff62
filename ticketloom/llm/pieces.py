"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

The text is cut where no piece of the vocabulary can reach across: before each run of
space marks. All distinct words of a batch lie in flat symbol arrays. In a round every
word finds its pair of least rank and merges its occurrences from the left; words without
a pair are taken out and the arrays compacted, until none is left. Ids of the words are
kept for the task, and a text's ids are gathered from them.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from sentencepiece import sentencepiece_model_pb2 as model_format

from ticketloom.llm.storage import map_batches

SPACE = "▁"
_WORD = re.compile("[ ▁]+[^ ▁]*")
WORDS_KEPT = 400_000
IDS_KEPT = 8_000_000
CHARS_AT_ONCE = 1_000_000
_NONE = np.int32(np.iinfo(np.int32).max)


class PieceModel:
    """Vocabulary tables of a BPE model with byte fallback and identity normalisation."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = model_format.ModelProto()
        spec.ParseFromString(model.serialized_model_proto())
        normal, trainer = spec.normalizer_spec, spec.trainer_spec
        if (
            trainer.model_type != trainer.BPE
            or not trainer.byte_fallback
            or normal.precompiled_charsmap
            or normal.remove_extra_whitespaces
            or not (normal.add_dummy_prefix and normal.escape_whitespaces)
            or trainer.treat_whitespace_as_suffix
            or any(p.type not in (p.NORMAL, p.UNKNOWN, p.CONTROL, p.BYTE) for p in spec.pieces)
        ):
            raise ValueError("only plain byte-fallback BPE models without normalisation are supported")
        self.end_id = model.eos_id()
        text = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == p.NORMAL}
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in text):
            raise ValueError("the model has pieces that reach across words")
        self.byte_ids = np.zeros(256, np.int32)
        self.bytes_of: list[bytes] = [b""] * len(spec.pieces)
        for i, p in enumerate(spec.pieces):
            if p.type == p.BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(p.piece[3:5], 16)])
            elif p.type == p.NORMAL:
                self.bytes_of[i] = p.piece.replace(SPACE, " ").encode()
            elif p.type == p.UNKNOWN:
                self.bytes_of[i] = trainer.unk_surface.encode()
        self.begins_spaced = np.array([p.type == p.NORMAL and p.piece.startswith(SPACE) for p in spec.pieces])
        self.is_byte = np.array([p.type == p.BYTE for p in spec.pieces])
        self.is_control = np.array([p.type == p.CONTROL for p in spec.pieces])
        # Single characters that occur in pieces only are symbols too, numbered after them.
        inner = sorted({char for piece in text for char in piece} - text.keys())
        symbols = text | {char: len(spec.pieces) + i for i, char in enumerate(inner)}
        self.size = len(spec.pieces) + len(inner)
        self.char_id = np.full(0x110000, -1, np.int32)
        for symbol, i in symbols.items():
            if len(symbol) == 1:
                self.char_id[ord(symbol)] = i
        self.real = np.arange(self.size) < len(spec.pieces)
        scores = np.array([p.score for p in spec.pieces], dtype=np.float64)
        rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.rank_of = np.append(rank, np.full(len(inner), _NONE)).astype(np.int32)
        # Of equal rank go the leftmost first, one at a time.
        shared = np.bincount(rank[list(text.values())], minlength=rank.max() + 1) > 1
        self.tied = shared
        pairs = [
            (symbols[piece[:cut]], symbols[piece[cut:]], i)
            for piece, i in text.items()
            for cut in range(1, len(piece))
            if piece[:cut] in symbols and piece[cut:] in symbols
        ]
        self._index_pairs(np.array(pairs, dtype=np.int64).reshape(-1, 3))

    def _index_pairs(self, pairs: np.ndarray) -> None:
        """Merges by (left, right) in one sparse table: row `left` begins at its own base."""
        rng = np.random.default_rng(5)
        left, right, merged = pairs[np.argsort(pairs[:, 0], kind="stable")].T
        room = 1 << max(12, int(len(pairs) * 16 - 1).bit_length())
        self._owner = np.full(room + self.size, -1, np.int32)
        self._merged = np.full(room + self.size, -1, np.int32)
        self._base = np.zeros(self.size, np.int64)
        firsts, starts = np.unique(left, return_index=True)
        ends = np.append(starts[1:], len(left))
        for i in np.argsort(starts - ends):
            row = right[starts[i] : ends[i]]
            base = next(b for b in iter(lambda: int(rng.integers(room)), None) if (self._owner[b + row] < 0).all())
            self._base[firsts[i]] = base
            self._owner[base + row] = firsts[i]
            self._merged[base + row] = merged[starts[i] : ends[i]]

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece two symbols make, -1 where they make none."""
        known = (left >= 0) & (right >= 0)
        left, right = np.where(known, left, 0), np.where(known, right, 0)
        at = self._base[left] + right
        return np.where(known & (self._owner[at] == left), self._merged[at], -1)

    def rank(self, piece: np.ndarray) -> np.ndarray:
        return np.where(piece >= 0, self.rank_of[piece], _NONE)


def encode_words(model: PieceModel, words: list[str]) -> list[np.ndarray]:
    """Ids of each word, a run of space marks and what follows."""
    chars = np.frombuffer("".join(words).encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    symbol = model.char_id[chars]
    first = np.arange(len(chars))  # where in `chars` each symbol begins
    word = np.repeat(np.arange(len(words)), lengths)
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(symbol):
        same = word[:-1] == word[1:]
        pair = np.append(np.where(same, model.merge(symbol[:-1], symbol[1:]), -1), -1)
        rank = model.rank(pair)
        start = np.flatnonzero(np.append(True, ~same))
        least = np.minimum.reduceat(rank, start)
        sizes = np.diff(np.append(start, len(symbol)))
        active = np.repeat(least != _NONE, sizes)
        if not active.all():
            done.append((word[~active], first[~active], symbol[~active]))
            symbol, first, word, pair, rank = (a[active] for a in (symbol, first, word, pair, rank))
            sizes, least = sizes[least != _NONE], least[least != _NONE]
            if not len(symbol):
                break
        hit = rank == np.repeat(least, sizes)
        merging = _leftmost(hit)
        # Merging all occurrences at once equals one after the other unless a new pair
        # would go first; such words, and equal ranks of several pieces, merge one.
        one = model.tied[least]
        at = np.flatnonzero(merging)
        new = pair[at]
        before = np.where(at > 0, symbol[at - 1], -1)
        earlier = np.append(False, at[1:] - at[:-1] == 2)
        before[earlier] = new[np.flatnonzero(earlier) - 1]
        after = symbol[np.minimum(at + 2, len(symbol) - 1)]
        near_left = (at > 0) & (word[at - 1] == word[at])
        near_right = (at + 2 < len(symbol)) & (word[np.minimum(at + 2, len(word) - 1)] == word[at])
        sooner = np.where(near_left, model.rank(model.merge(before, new)), _NONE) <= rank[at]
        sooner |= np.where(near_right, model.rank(model.merge(new, after)), _NONE) <= rank[at]
        nth = np.cumsum(np.append(True, word[1:] != word[:-1])) - 1
        one = one | (np.bincount(nth[at[sooner]], minlength=len(one)) > 0)
        if one.any():
            lead = np.append(True, nth[at][1:] != nth[at][:-1])
            at = at[lead | ~one[nth[at]]]
        symbol[at] = pair[at]
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        symbol, first, word = symbol[keep], first[keep], word[keep]
    word, first, symbol = (np.concatenate(part) for part in zip(*done))
    order = np.argsort(first, kind="stable")
    return _with_bytes(model, chars, word[order], symbol[order], first[order], len(words))


def _leftmost(hit: np.ndarray) -> np.ndarray:
    """Of neighbouring hits every other one, from the left."""
    at = np.arange(len(hit))
    opening = hit & ~np.append(False, hit[:-1])
    run = np.maximum.accumulate(np.where(opening, at, 0))
    return hit & ((at - run) % 2 == 0)


def _with_bytes(model, chars, word, symbol, first, words) -> list[np.ndarray]:
    """Symbols that are no pieces become the ids of their UTF-8 bytes."""
    odd = np.flatnonzero((symbol < 0) | ~model.real[symbol])
    if len(odd):
        spelled = [chr(c).encode("utf-8", "replace") for c in chars[first[odd]]]
        widths = np.ones(len(symbol), np.int64)
        widths[odd] = [len(b) for b in spelled]
        place = np.repeat(np.cumsum(widths)[odd] - widths[odd], widths[odd])
        inside = np.arange(len(place)) - np.repeat(np.cumsum(widths[odd]) - widths[odd], widths[odd])
        symbol, word = np.repeat(symbol, widths), np.repeat(word, widths)
        symbol[place + inside] = model.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
    counts = np.bincount(word, minlength=words)
    return np.split(symbol.astype(np.int32), np.cumsum(counts)[:-1])


class PieceEncoder:
    """Ids of whole texts, each distinct word of a task encoded once."""

    def __init__(self, model: PieceModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self._slots: dict[str, int] = {}
        self._starts = np.zeros(0, np.int64)
        self._lengths = np.zeros(0, np.int64)
        self._pool = np.zeros(0, np.int32)

    def _learn(self, words: list[str]) -> None:
        pieces = encode_words(self.model, [w.replace(" ", SPACE) for w in words])
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        starts = len(self._pool) + np.cumsum(lengths) - lengths
        self._slots.update(zip(words, range(len(self._starts), len(self._starts) + len(words))))
        self._starts = np.concatenate([self._starts, starts])
        self._lengths = np.concatenate([self._lengths, lengths])
        self._pool = np.concatenate([self._pool, *pieces])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        some, size = [], 0
        for text in texts:
            some.append(text or "")
            size += len(some[-1])
            if size > CHARS_AT_ONCE:
                out += self._encode(some)
                some, size = [], 0
        return out + (self._encode(some) if some else [])

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [_WORD.findall(" " + text) if text else [] for text in texts]
        words = [word for own in split for word in own]
        end = np.array([self.model.end_id], np.int32)
        if not words:
            return [end for _ in texts]
        if len(self._slots) > WORDS_KEPT or len(self._pool) > IDS_KEPT:
            self._forget()
        slots = self._find(words)
        new = np.flatnonzero(slots < 0)
        if len(new):
            unseen = [words[i] for i in new]
            self._learn(list(dict.fromkeys(unseen)))
            slots[new] = self._find(unseen)
        lengths = self._lengths[slots]
        ends = np.cumsum(lengths)
        at = np.repeat(self._starts[slots] - (ends - lengths), lengths) + np.arange(ends[-1])
        bounds = np.append(0, ends)[np.cumsum([len(own) for own in split])]
        return [np.append(ids, end) for ids in np.split(self._pool[at], bounds[:-1])]

    def _find(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self._slots.get, words, itertools.repeat(-1)), np.int64, len(words))


def decode_ids(model: PieceModel, ids: np.ndarray) -> str:
    """The text of one list of ids: control ids say nothing, the first space mark is a prefix."""
    ids = ids[~model.is_control[ids]]
    if not len(ids):
        return ""
    spelled = b"".join(map(model.bytes_of.__getitem__, ids.tolist()))
    text = _valid_utf8(model, ids, spelled)
    return text[1:] if model.begins_spaced[ids[0]] else text


def _valid_utf8(model: PieceModel, ids: np.ndarray, spelled: bytes) -> str:
    try:
        return spelled.decode()
    except UnicodeDecodeError:
        pass
    # Ids that no text has: bytes that are not UTF-8 become U+FFFD, each by itself.
    out, run = [], b""
    for i in [*ids.tolist(), None]:
        if i is not None and model.is_byte[i]:
            run += model.bytes_of[i]
            continue
        while run:
            for width in range(min(4, len(run)), 0, -1):
                try:
                    char = run[:width].decode()
                except UnicodeDecodeError:
                    continue
                if len(char) == 1:
                    break
            else:
                char, width = "�", 1
            out.append(char)
            run = run[width:]
        if i is not None:
            out.append(model.bytes_of[i].decode())
    return "".join(out)


def encode(docs: DataFrame, model_path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, ids): the ids of each whole text, an end id last.

    Equal to the sentencepiece library's own. Null and empty texts are the end id alone.
    Repeated rows and rows without an id are encoded like others.
    """
    columns = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def start():
        encoder = PieceEncoder(PieceModel(model_path))
        return lambda ids, texts: {"doc_id": ids, "ids": encoder.encode(texts)}

    return map_batches(columns, ["doc_id", "text"], "doc_id long, ids array<int>", start)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, text): the text that each list of ids stands for; null ids give an empty one."""
    schema = StructType(encoded.select("doc_id", "ids").schema.fields + [StructField("text", StringType())])

    def run(batches):
        model = PieceModel(model_path)
        for batch in batches:
            lists = batch.column(1)
            bounds, ids = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            texts = [decode_ids(model, ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
            arrays = [batch.column(0), lists, pa.array(texts, type=pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return encoded.select("doc_id", "ids").mapInArrow(run, schema)
