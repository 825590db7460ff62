"""Ranked lexical search by Block-Max MaxScore over index shards.

A shard holds the documents of about 8 MB of text, in the order of their ids, and for
every term a list of postings (document, occurrences) in compressed blocks of 128. Each
block keeps its non-dominated pairs (occurrences, document length): whatever the number
and mean length of all documents become, they give the exact largest gain in the block.

A search joins the lists with the terms asked for; every shard then answers all queries
of a group by itself. The bounds of whole lists split a query's lists: documents that
occur only in the lists whose bounds together stay below the current k-th score are
never looked at. For those found in the other, essential lists, the bounds of the rest
and then the maximum of the block they would lie in reject candidates before that block
is decompressed. The best k of the shards are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.storage import stored
from ticketloom.llm.text_shards import binary_column, coded_words, in_shards, one_array

SHARD_BYTES = 8 << 20
BLOCK = 128
#: Documents of a shard that are scored at once.
WINDOW = 2048
#: Queries that a task answers together.
QUERIES_AT_ONCE = 1000
LISTS_AT_ONCE = 50_000

#: A-Z lower-cased; ASCII other than letters and digits separates; all else as it is.
TERMS = bytes(
    c if c >= 0x80 or chr(c).isdigit() or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)

_INDEX = (
    "shard string, term string, df int, blocks binary, tops binary, postings binary, "
    "doc_ids array<bigint>, lengths array<bigint>, documents bigint, words bigint"
)


# -- index ---------------------------------------------------------------------------


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES, block: int = BLOCK) -> DataFrame:
    """The stored index of `docs` (doc_id long, text): every term of every whole text.

    One row per shard and term, and one per shard without a term that holds its documents
    (ids, numbers of terms). A null text has no terms; rows that repeat an id are
    documents of their own; a null id is kept and stands last. Extra columns, whatever
    their names, are not read. An empty table gives an empty index.
    """
    out = docs.sparkSession.createDataFrame([], _INDEX).schema
    arrow = pa.schema(
        [("shard", pa.string()), ("term", pa.string()), ("df", pa.int32())]
        + [(name, pa.binary()) for name in ("blocks", "tops", "postings")]
        + [(name, pa.list_(pa.int64())) for name in ("doc_ids", "lengths")]
        + [("documents", pa.int64()), ("words", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for nth, some in enumerate(in_shards(batches, "text", shard_bytes)):
            lists, own = _index_shard(one_array(some["doc_id"]), one_array(some["text"]), block)
            name = f"{task}-{nth}"
            for at in range(0, lists.num_rows, LISTS_AT_ONCE):
                yield _filled(lists.slice(at, LISTS_AT_ONCE), name, arrow)
            yield _filled(own, name, arrow)

    return stored(docs.select("doc_id", "text").mapInArrow(run, out), "index")


def _filled(table: pa.Table, shard: str, schema: pa.Schema) -> pa.RecordBatch:
    table = table.append_column("shard", pa.array([shard] * table.num_rows, pa.string()))
    columns = [
        table[f.name].combine_chunks() if f.name in table.column_names else pa.nulls(table.num_rows, f.type)
        for f in schema
    ]
    return pa.Table.from_arrays(columns, schema=schema).combine_chunks().to_batches()[0]


def _index_shard(ids: pa.Array, texts: pa.Array, block: int) -> tuple[pa.Table, pa.Table]:
    n_docs = len(ids)
    # Documents are numbered by id, nulls last, so that an earlier number wins a tie.
    order = np.lexsort((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))
    number = np.empty(n_docs, np.int64)
    number[order] = np.arange(n_docs)
    rows, codes, terms = coded_words(texts, TERMS)
    docs = number[rows]
    lengths = np.bincount(docs, minlength=n_docs)
    pairs, tf = np.unique(codes.astype(np.int64) * n_docs + docs, return_counts=True)
    of, docs = pairs // n_docs, pairs % n_docs
    df = np.bincount(of, minlength=len(terms))
    ends = np.cumsum(df)
    place = np.arange(len(of)) - np.repeat(ends - df, df)

    gaps = np.diff(docs, prepend=-1)
    first = place == 0
    gaps[first] = docs[first] + 1
    values = np.empty(2 * len(docs), np.int64)
    values[0::2], values[1::2] = gaps, tf
    coded, value_ends = _varints(values)

    begins = np.flatnonzero(place % block == 0)
    closes = np.append(begins[1:], len(of)) - 1 if len(of) else begins
    block_of = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(of))))
    top_at, top_blocks = _tops(block_of, tf, lengths[docs])
    top_ends = np.cumsum(np.bincount(top_blocks, minlength=len(begins)))
    byte_ends = value_ends[1::2]
    list_of = of[begins]
    list_blocks = np.cumsum(np.bincount(list_of, minlength=len(terms)))
    list_bytes, list_tops = byte_ends[ends - 1], top_ends[list_blocks - 1]

    def within(values, list_values):  # counted from the start of the list
        return values - np.concatenate([[0], list_values])[list_of]

    table = np.stack(
        [docs[closes], within(byte_ends[closes], list_bytes), within(top_ends, list_tops)], axis=1
    ).astype("<i4")
    tops = np.stack([tf[top_at], lengths[docs[top_at]]], axis=1).astype("<i4")
    lists = pa.table(
        {
            "term": terms,
            "df": pa.array(df, pa.int32()),
            "blocks": binary_column(table.reshape(-1), list_blocks * 3),
            "tops": binary_column(tops.reshape(-1), list_tops * 2),
            "postings": binary_column(coded, list_bytes),
        }
    )
    own = pa.table(
        {
            "doc_ids": pa.array([ids.take(pa.array(order)).to_pylist()], pa.list_(pa.int64())),
            "lengths": pa.array([lengths], pa.list_(pa.int64())),
            "documents": [int((lengths > 0).sum())],
            "words": [int(lengths.sum())],
        }
    )
    return lists, own


def _varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes of seven bits, lowest first, and where each number ends."""
    sizes = np.ones(len(values), np.int64)
    for bits in range(7, 63, 7):
        more = values >> bits > 0
        if not more.any():
            break
        sizes += more
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for nth in range(int(sizes.max()) if len(sizes) else 0):
        some = np.flatnonzero(sizes > nth)
        byte = (values[some] >> (7 * nth)) & 127
        out[ends[some] - sizes[some] + nth] = byte | np.where(sizes[some] > nth + 1, 128, 0)
    return out, ends


def _from_varints(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data < 128)
    begins = np.concatenate([[0], last[:-1] + 1])
    nth = np.arange(len(data)) - np.repeat(begins, last - begins + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * nth), begins)


def _tops(block_of: np.ndarray, tf: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Postings that no other of their block beats in both occurrences and shortness."""
    order = np.lexsort((lengths, -tf, block_of))
    far = int(lengths.max(initial=0)) + 1
    # Each block lies lower than the one before, so the running least starts anew in it.
    height = lengths[order] + (block_of.max(initial=0) - block_of[order]) * far
    least = np.minimum.accumulate(height)
    kept = np.ones(len(order), bool)
    kept[1:] = height[1:] < least[:-1]
    return order[kept], block_of[order[kept]]


# -- search --------------------------------------------------------------------------


def search(index: DataFrame, queries: DataFrame, k: int, key: str = "item_id") -> DataFrame:
    """(key, rank, doc_id, score): the `k` documents with the highest score above zero for
    every row of `queries` (key, text), equal scores by ascending doc_id, null ids last.

    N documents hold at least one term, L is all their terms, n one document's, df the
    documents holding a term, tf its occurrences in one. The weight of a term is
    floor(1000 ln((2N+2)/(2df+1))), m = 75 + 25nN div L, and each occurrence of the term
    in the query adds weight * (1000000000 tf div (1000 tf + 12 m)).

    A query without a known term has no rows. Rows that repeat a query, or its key, are
    queries of their own. A query's text is read whole.
    """
    spark = index.sparkSession
    shards = index.where("term is null")
    n, words = shards.agg(F.sum("documents"), F.sum("words")).first()
    asked = stored(_query_terms(queries.select(F.col(key).alias("key"), "text")), "asked")
    parts = -(-max(1, asked.agg(F.count_distinct("query")).first()[0]) // QUERIES_AT_ONCE)
    part = F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int").alias("part")
    lists = index.where("term is not null")
    # Who asks for a term, per group of at most about QUERIES_AT_ONCE queries.
    askers = asked.groupBy(part, "term").agg(F.collect_list(F.struct("query", "times")).alias("askers"))
    found = lists.join(askers.select("term").distinct(), "term", "left_semi")
    weight = F.floor(F.log((2.0 * F.lit(n) + 2) / (2 * F.sum("df") + 1)) * 1000).cast("long")
    weights = found.groupBy("term").agg(weight.alias("weight"))
    wanted = askers.join(weights, "term")
    rows = found.join(wanted, "term").select("shard", "part", "weight", "askers", "blocks", "tops", "postings")
    own = shards.select("shard", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "doc_ids", "lengths")
    answers = (
        rows.unionByName(own, allowMissingColumns=True)
        .groupBy("shard", "part")
        .applyInArrow(_answer(n or 0, words or 0, k), "query long, doc_id long, score long")
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    merged = answers.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    keys = asked.select("query", F.col("key").alias(key)).distinct()
    return merged.join(keys, "query").select(key, "rank", "doc_id", "score")


def _query_terms(queries: DataFrame) -> DataFrame:
    """(query, key, term, times): the terms of every query, numbered apart."""
    numbered = stored(queries.withColumn("query", F.monotonically_increasing_id()), "queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in in_shards(batches, "text", SHARD_BYTES):
            rows, codes, terms = coded_words(one_array(some["text"]), TERMS)
            size = max(1, len(terms))
            pairs, times = np.unique(rows * size + codes, return_counts=True)
            query = one_array(some["query"]).take(pa.array(pairs // size))
            columns = [query, terms.take(pa.array(pairs % size)), pa.array(times, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["query", "term", "times"])

    terms = numbered.select("query", "text").mapInArrow(run, "query long, term string, times long")
    return terms.join(numbered.select("query", "key"), "query")


def _answer(n: int, words: int, k: int):
    def answer(table: pa.Table) -> pa.Table:
        lists, (own,) = (table.filter(some).to_pylist() for some in (pc.is_null(table["doc_ids"]), pc.is_valid(table["doc_ids"])))
        ids, shard = own["doc_ids"], Shard(np.array(own["lengths"], np.int64), n, words)
        asked: dict[int, list] = {}
        for row in lists:
            held = Postings(shard, row["weight"], row["blocks"], row["tops"], row["postings"])
            for asker in row["askers"]:
                asked.setdefault(asker["query"], []).append((held, asker["times"]))
        out = {"query": [], "doc_id": [], "score": []}
        for query, lists in asked.items():
            for score, doc in shard.best(lists, k):
                out["query"].append(query)
                out["doc_id"].append(ids[doc])
                out["score"].append(score)
        return pa.table({name: pa.array(values, pa.int64()) for name, values in out.items()})

    return answer


class Postings:
    """One term's list in a shard; its blocks are decompressed when they are first read."""

    def __init__(self, shard: Shard, weight: int, blocks: bytes, tops: bytes, data: bytes) -> None:
        self.shard, self.weight = shard, weight
        self.last, self.ends, top_ends = np.frombuffer(blocks, "<i4").reshape(-1, 3).T.astype(np.int64)
        tf, lengths = np.frombuffer(tops, "<i4").reshape(-1, 2).T.astype(np.int64)
        begins = np.concatenate([[0], top_ends[:-1]])
        self.block_max = np.maximum.reduceat(self._gain(tf, shard.m(lengths)), begins)
        self.bound = int(self.block_max.max())
        self.data = np.frombuffer(data, np.uint8)
        self.read: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _gain(self, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return self.weight * (1_000_000_000 * tf // (1000 * tf + 12 * m))

    def block(self, nth: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block and what the term adds to their scores."""
        if nth not in self.read:
            begin, before = (int(self.ends[nth - 1]), int(self.last[nth - 1])) if nth else (0, -1)
            values = _from_varints(self.data[begin : self.ends[nth]])
            docs = before + np.cumsum(values[0::2])
            self.read[nth] = docs, self._gain(values[1::2], self.shard.doc_m[docs])
        return self.read[nth]


class Shard:
    def __init__(self, lengths: np.ndarray, n: int, words: int) -> None:
        self.n, self.words, self.size = n, words, len(lengths)
        self.doc_m = self.m(lengths)

    def m(self, lengths: np.ndarray) -> np.ndarray:
        return 75 + 25 * lengths * self.n // self.words if self.words else 75 + 0 * lengths

    def best(self, asked: list[tuple[Postings, int]], k: int) -> list[tuple[int, int]]:
        """The k best (score, document) of a query given as (list, times asked)."""
        asked = sorted(asked, key=lambda one: one[0].bound * one[1])
        reach = np.cumsum([held.bound * times for held, times in asked])
        scores, docs, floor = np.empty(0, np.int64), np.empty(0, np.int64), 1
        for start in range(0, self.size, WINDOW):
            essential = int(np.searchsorted(reach, floor))
            if essential == len(asked):
                break  # all lists together do not reach the k-th score
            stop = min(start + WINDOW, self.size)
            found, score = self._essential(asked[essential:], start, stop)
            for nth in range(essential - 1, -1, -1):
                held, times = asked[nth]
                alive = score + reach[nth] >= floor
                found, score = found[alive], score[alive]
                if not len(found):
                    break
                found, score = self._refine(held, times, found, score, floor - (reach[nth - 1] if nth else 0))
            alive = score >= floor
            if alive.any():
                scores, docs = np.append(scores, score[alive]), np.append(docs, found[alive])
                first = np.lexsort((docs, -scores))[:k]
                scores, docs = scores[first], docs[first]
                if len(scores) == k:
                    floor = int(scores[-1])
        return list(zip(scores.tolist(), docs.tolist()))

    @staticmethod
    def _essential(asked, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a window that occur in any of some lists, with what these add."""
        total = np.zeros(stop - start, np.int64)
        for held, times in asked:
            for nth in range(int(np.searchsorted(held.last, start)), len(held.last)):
                docs, gains = held.block(nth)
                low, high = np.searchsorted(docs, (start, stop))
                total[docs[low:high] - start] += times * gains[low:high]
                if held.last[nth] >= stop - 1:
                    break
        found = np.flatnonzero(total)
        return found + start, total[found]

    @staticmethod
    def _refine(held: Postings, times: int, found, score, needed) -> tuple[np.ndarray, np.ndarray]:
        """Add a non-essential list; candidates that even the maximum of their block
        leaves below `needed` go before it is decompressed."""
        nth = np.searchsorted(held.last, found)
        in_list = nth < len(held.last)
        most = np.where(in_list, held.block_max[np.minimum(nth, len(held.last) - 1)], 0)
        alive = score + times * most >= needed
        found, score, nth = found[alive], score[alive].copy(), nth[alive]
        for block in np.unique(nth[in_list[alive]]):
            docs, gains = held.block(int(block))
            low, high = np.searchsorted(nth, (block, block + 1))
            place = np.minimum(np.searchsorted(docs, found[low:high]), len(docs) - 1)
            score[low:high] += np.where(docs[place] == found[low:high], times * gains[place], 0)
        return found, score
