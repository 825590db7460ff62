"""How document filters interact, from a sparse document-term matrix.

Words are numbered in two steps. Every shard of about 8 MB of text numbers its own
words, sorted by hash; equal ranges of the hash are then brought together, a few million
words at a time, and numbered for the whole table. With these numbers each shard becomes
a CSR matrix: row sums and nonzero counts give the words and distinct words of a document.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.storage import stored
from ticketloom.llm.text_shards import binary_column, coded_words, in_shards, one_array, totals

SHARD_BYTES = 8 << 20
#: Words, counted once per shard, that one task numbers together.
WORDS_AT_ONCE = 1_000_000

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in itertools.permutations(FILTERS)]

_DOCS = (
    "doc_ids array<bigint>, langs array<string>, texts array<binary>, points array<bigint>, "
    "capitals array<bigint>, symbols array<bigint>, row_ends array<int>"
)
_ARROW_DOCS = [
    ("doc_ids", pa.list_(pa.int64())),
    ("langs", pa.list_(pa.string())),
    ("texts", pa.list_(pa.binary())),
    ("points", pa.list_(pa.int64())),
    ("capitals", pa.list_(pa.int64())),
    ("symbols", pa.list_(pa.int64())),
    ("row_ends", pa.list_(pa.int32())),
]
_DOC_NAMES = [name for name, _ in _ARROW_DOCS]


# -- matrix ----------------------------------------------------------------------------


def shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Stored shards of `docs` (doc_id long, text, lang), each with numbers of its own for
    its words: `words`, parted by line feeds and sorted by hash, `codes` (each less the one
    before) and `counts` of the matrix entries, compressed, and per document its id, lang, SHA-256 of the text, code points,
    capitals A-Z, symbols `#$%&*|` and the end of its row of entries."""
    schema = f"shard string, n_words int, words string, codes binary, counts binary, {_DOCS}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for nth, some in enumerate(in_shards(batches, "text", shard_bytes)):
            yield _shard(f"{task}-{nth}", some)

    return stored(docs.select("doc_id", "text", "lang").mapInArrow(run, schema), "shards")


def _shard(name: str, docs: pa.Table) -> pa.RecordBatch:
    texts = pc.fill_null(one_array(docs["text"]), "")
    rows, codes, words = coded_words(texts)
    hashes = word_hashes(words)
    order = np.argsort(hashes, kind="stable")
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    size = max(1, len(words))
    pairs, counts = np.unique(rows * size + place[codes], return_counts=True)
    row_ends = np.cumsum(np.bincount(pairs // size, minlength=len(texts)))
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data, ends = data[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]
    values = {
        "shard": [name],
        "n_words": pa.array([len(words)], pa.int32()),
        "words": _lines(words.take(pa.array(order)), np.array([len(words)])),
        "codes": [_packed(np.diff(pairs % size, prepend=0))],
        "counts": [_packed(counts)],
        "doc_ids": one_array(docs["doc_id"]),
        "langs": one_array(docs["lang"]),
        "texts": pa.array([hashlib.sha256(text.as_buffer()).digest() for text in texts], pa.binary()),
        "points": totals((data & 0xC0) != 0x80, ends),
        "capitals": totals((data >= 65) & (data <= 90), ends),
        "symbols": totals(_SYMBOLS[data], ends),
        "row_ends": row_ends.astype(np.int32),
    }
    for column, kind in _ARROW_DOCS:
        array = values[column] if isinstance(values[column], pa.Array) else pa.array(values[column])
        values[column] = pa.ListArray.from_arrays(pa.array([0, len(array)], pa.int32()), array.cast(kind.value_type))
    return pa.RecordBatch.from_pydict(values)


_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#$%&*|")] = True


def _packed(numbers: np.ndarray) -> bytes:
    return pa.compress(numbers.astype("<i4").tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), "<i4")


def _lines(words: pa.Array, ends: np.ndarray) -> pa.Array:
    """Words parted by line feeds, one text up to each end."""
    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, words), "\n")


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes that spread words evenly; equal words have equal hashes."""
    if not len(words):
        return np.empty(0, np.uint64)
    words = pa.concat_arrays([words])
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    starts = offsets[:-1] - offsets[0]
    place = np.arange(len(data)) - np.repeat(starts, np.diff(offsets))
    factors = np.random.default_rng(1).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    mixed = np.add.reduceat((data + np.uint64(1)) * factors[place & 255], starts)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


def dictionary(matrix: DataFrame, words_at_once: int = WORDS_AT_ONCE) -> DataFrame:
    """Numbers for the distinct words of all shards, from 0 without gaps. Stored rows
    (range, shard, ids, words, base): for every shard the ids, counted from `base`, of
    its words in a range of hashes; with a null shard the distinct words of the range."""
    n = matrix.agg(F.sum(F.col("n_words").cast("long"))).first()[0] or 0
    ranges = -(-max(n, 1) // words_at_once)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, n_words, joined in zip(*(c.to_pylist() for c in batch.columns)):
                words = pc.split_pattern(pa.array([joined]), "\n").flatten().slice(0, n_words)
                bounds = np.array([(at << 64) // ranges for at in range(1, ranges)], np.uint64)
                ends = np.append(np.searchsorted(word_hashes(words), bounds), n_words)
                sizes = np.diff(ends, prepend=0)
                some = np.flatnonzero(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), pa.array([shard] * len(some), pa.string()),
                     _lines(words, ends[some]), pa.array(sizes[some])],
                    names=["range", "shard", "words", "size"],
                )

    def number(table: pa.Table) -> pa.Table:
        flat = pc.split_pattern(one_array(table["words"]), "\n").flatten()
        coded = flat.dictionary_encode()
        ids = binary_column(coded.indices.to_numpy().astype("<i4"), np.cumsum(table["size"].to_numpy()))
        whole = _lines(coded.dictionary, np.array([len(coded.dictionary)]))
        return pa.table(
            {
                "range": pa.concat_arrays([one_array(table["range"]), one_array(table["range"][:1])]),
                "shard": pa.concat_arrays([one_array(table["shard"]), pa.nulls(1, pa.string())]),
                "ids": pa.concat_arrays([ids, pa.nulls(1, pa.binary())]),
                "words": pa.concat_arrays([pa.nulls(len(table), pa.string()), whole]),
                "size": pa.concat_arrays([one_array(table["size"]), pa.array([len(coded.dictionary)], pa.int64())]),
            }
        )

    cuts = matrix.select("shard", "n_words", "words").mapInArrow(cut, "range long, shard string, words string, size long")
    numbered = cuts.groupBy("range").applyInArrow(number, "range long, shard string, ids binary, words string, size long")
    numbered = stored(numbered, "dictionary")
    # One row per range: so many as the words of all shards fill.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = numbered.where("shard is null").select("range", "size")
    bases = sizes.select("range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    return numbered.drop("size").join(bases, "range")


def csr_shards(matrix: DataFrame, numbers: DataFrame) -> DataFrame:
    """The matrix as CSR shards: `indices`, the words' numbers for the whole table, and
    `counts` of the entries of all rows, which end at `row_ends`; and the documents."""
    schema = f"shard string, indices array<bigint>, counts array<int>, {_DOCS}"

    def encode(own: pa.Table, ids: pa.Table) -> pa.Table:
        ids = ids.sort_by("range")
        parts = [base + np.frombuffer(some, "<i4") for base, some in zip(ids["base"].to_pylist(), ids["ids"].to_pylist())]
        to_all = np.concatenate([np.empty(0, np.int64), *parts])  # words of a shard are sorted by hash, so by range
        n = int(own["row_ends"][0].values[-1].as_py())
        entries = to_all[np.cumsum(_unpacked(own["codes"][0].as_py(), n))]
        counts = _unpacked(own["counts"][0].as_py(), n)
        ends = pa.array([0, len(entries)], pa.int32())
        columns = {"shard": own["shard"], "indices": pa.ListArray.from_arrays(ends, pa.array(entries, pa.int64()))}
        columns["counts"] = pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32()))
        return pa.table(columns | {name: own[name] for name in _DOC_NAMES})

    own = matrix.drop("words", "n_words").groupBy("shard")
    return own.cogroup(numbers.where("shard is not null").groupBy("shard")).applyInArrow(encode, schema)


def row_sums(csr: DataFrame) -> DataFrame:
    """(doc_id, lang, text_key, n_words, n_distinct, points, capitals, symbols) per document."""
    schema = (
        "doc_id long, lang string, text_key binary, n_words long, n_distinct long, "
        "points long, capitals long, symbols long"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nth in range(batch.num_rows):
                cell = {name: batch.column(name)[nth].values for name in ("counts", *_DOC_NAMES)}
                ends = cell["row_ends"].to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [cell["doc_ids"], cell["langs"], cell["texts"],
                     pa.array(totals(cell["counts"].to_numpy(), ends), pa.int64()),
                     pa.array(np.diff(ends, prepend=0), pa.int64()),
                     cell["points"], cell["capitals"], cell["symbols"]],
                    names=["doc_id", "lang", "text_key", "n_words", "n_distinct", "points", "capitals", "symbols"],
                )

    return csr.select("counts", *_DOC_NAMES).mapInArrow(run, schema)


# -- audit -----------------------------------------------------------------------------


def failed_filters(sums: DataFrame) -> DataFrame:
    """(doc_id, lang, text_key, fails): bits 1, 2, 4, 8 for the filters A, B, C, D."""
    conditions = ["n_words < 200", "100 * n_distinct < 50 * n_words", "100 * capitals > 3 * points", "symbols > 0"]
    bits = " + ".join(f"if({condition}, {1 << nth}, 0)" for nth, condition in enumerate(conditions))
    return sums.select("doc_id", "lang", "text_key", F.expr(bits).alias("fails"))


def patterns(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, good, toxic, n): documents by the set of filters they fail, E (16)
    included, and by their labels. Copies of a text are counted before they meet, so a
    text that a third of the rows share sends a few rows per task."""
    marks = labels.groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    part = F.coalesce("lang", F.lit("")).alias("part")
    rows = flagged.groupBy("doc_id", part, "text_key", "fails").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(marks, "doc_id", "left").fillna(False, ["good", "toxic"])
    # A document without an id has no smaller one, nor is it smaller than another.
    known = F.col("doc_id").isNotNull().alias("known")
    groups = rows.groupBy("text_key", "part", "fails", "good", "toxic", known).agg(
        F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("first")
    )
    smallest = F.min(F.when(F.col("known"), F.col("first.doc_id"))).over(Window.partitionBy("text_key"))
    first = F.when(F.col("first.doc_id") == smallest, F.col("first.n")).otherwise(0)
    kept = F.when(F.col("known"), first).otherwise(F.col("n"))
    split = groups.withColumn("kept", kept).select(
        "part", "good", "toxic",
        F.inline(
            F.array(
                F.struct(F.col("fails"), F.col("kept").alias("n")),
                F.struct((F.col("fails") + 16).alias("fails"), (F.col("n") - F.col("kept")).alias("n")),
            )
        ),
    )
    return split.groupBy("part", "fails", "good", "toxic").agg(F.sum("n").alias("n"))


def by_order(counted: DataFrame) -> DataFrame:
    """What every filter removes at every step of every order of the filters, per part.

    `shapley` is what the step's filter removes, summed over all orders."""
    steps = [
        F.struct(
            F.lit(order).alias("filter_order"),
            F.lit(step).alias("step"),
            F.lit(1 << FILTERS.index(letter)).alias("own"),
            F.lit(sum(1 << FILTERS.index(other) for other in order[: step - 1])).alias("before"),
        )
        for order in ORDERS
        for step, letter in enumerate(order, 1)
    ]
    rows = counted.select("*", F.inline(F.array(*steps)))
    measures = {
        "kept": "fails & (own | before) = 0",
        "removed": "fails & own > 0 AND fails & before = 0",
        "redundant": "fails & own > 0 AND fails & before > 0",
        "unique_fails": "fails = own",
        "good_lost": "fails & own > 0 AND fails & before = 0 AND good",
        "toxic_lost": "fails & own > 0 AND fails & before = 0 AND toxic",
    }
    sums = [F.expr(f"sum(if({condition}, n, 0))").alias(name) for name, condition in measures.items()]
    summed = rows.groupBy("part", "filter_order", "step", "own").agg(*sums)
    every_order = Window.partitionBy("part", "own")
    return summed.withColumn("shapley", F.sum("removed").over(every_order)).drop("own")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley) of five filters on whole texts, for all 120 orders of them.

    A document fails A with under 200 words, B if less than half of its words are
    distinct, C if over 3 % of its code points are A-Z, D if it holds any of `#$%&*|`, E if
    a smaller doc_id has the same text. `docs` has doc_id, text and lang, `labels` doc_id,
    quality and toxic.

    A null text is empty (it fails A); a null lang is the part of the empty string. Rows
    without an id fail no E and have no label; rows that repeat an id and a text do not
    fail E for each other; an id with several labels counts as good or toxic if any of them
    says so. Extra columns are not read. An empty table gives no rows.
    """
    matrix = shards(docs)
    sums = row_sums(csr_shards(matrix, dictionary(matrix)))
    return by_order(patterns(stored(failed_filters(sums), "flagged"), labels))
