"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 2h bits share a variant: a value within h bits of
both. So every distinct fingerprint stands for all its variants within h bits, and
fingerprints that meet at a variant are linked.

The variants are dealt out by their leading bits. All variants of a fingerprint that begin
alike travel as one row (fingerprint, prefix, flips left) and are listed only where they
meet, so a fingerprint costs 56 rows in the shuffle instead of 2,081. A prefix that holds
too many variants is dealt out again by more bits, which splits groups of near copies too.
Fingerprints meeting at one variant are linked along a chain, never as all pairs.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.components import connected_components
from ticketloom.llm.storage import map_batches, stored

BITS = 64
HASH_SEED = 42
VARIANTS_PER_TASK_GROUP = 4_000_000
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def text_fingerprint(text: str | None, shingle_words: int) -> int:
    """Unsigned SimHash of a text's word shingles; 0 for a text without words or null."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        hashes = [xxhash.xxh64_intdigest(joined, HASH_SEED)]
    else:
        ends = list(itertools.accumulate(map((1).__add__, map(len, words))))
        starts = [0, *ends[:-shingle_words]]
        hashes = [
            xxhash.xxh64_intdigest(joined[start : end - 1], HASH_SEED)
            for start, end in zip(starts, ends[shingle_words - 1 :])
        ]
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    seen = np.bincount((octets + np.arange(8) * 256).ravel(), minlength=2048).reshape(8, 256)
    ones = (seen @ _BYTE_BITS.astype(np.int64)).ravel()
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 4, id_col="doc_id", text_col="text"):
    """(doc_id, fingerprint): the fingerprint's 64 bits as a signed long."""

    def start():
        def convert(ids, texts):
            prints = np.array([text_fingerprint(t, shingle_words) for t in texts], dtype=np.uint64)
            return {"doc_id": ids, "fingerprint": prints.view(np.int64)}

        return convert

    columns = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(columns, ["doc_id", "text"], "doc_id long, fingerprint long", start)


def flips(bits: int, most: int) -> list[tuple[int, int]]:
    """(mask, bits set) of every way to flip up to `most` of the low `bits` bits."""
    return [
        (sum(1 << i for i in chosen), size)
        for size in range(min(most, bits) + 1)
        for chosen in itertools.combinations(range(bits), size)
    ]


def linked_fingerprints(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """(a, b): links that join all distinct fingerprints at most `max_bits` bits apart.

    `prints` has one distinct long `fingerprint` per row. Every pair within the distance
    is connected through the links returned, and every link is within it. `max_bits` is
    even.
    """
    if max_bits < 0 or max_bits % 2:
        raise ValueError("the largest bit distance must be even")
    half = max_bits // 2
    rows = prints.count()
    lead = min(BITS - 16, max(10, math.ceil(math.log2(max(rows, 1) / 512))))
    pending = prints.select(
        F.col("fingerprint").alias("print"),
        F.lit(0).cast("long").alias("prefix"),
        F.lit(half).alias("flips_left"),
    )
    depth, parts = 0, []
    while True:
        pending = stored(_deal(pending, depth, lead, half), "slices")
        depth, lead = depth + lead, 8
        sizes = [sum(math.comb(BITS - depth, j) for j in range(f + 1)) for f in range(half + 1)]
        size = F.element_at(F.array(*map(F.lit, sizes)), F.col("flips_left") + 1)
        large = pending.groupBy("prefix").agg(F.sum(size).alias("variants"))
        large = stored(large.where(F.col("variants") > VARIANTS_PER_TASK_GROUP), "large")
        last = depth + lead > BITS - 8 or large.isEmpty()
        ready = pending if last else pending.join(large, "prefix", "left_anti")
        parts.append(ready.select("print", "prefix", "flips_left", F.lit(depth).alias("depth")))
        if last:
            break
        pending = pending.join(large, "prefix", "left_semi").select(*pending.columns)
    slices = parts[0]
    for part in parts[1:]:
        slices = slices.unionByName(part)

    def meet(key, group):
        return _meetings(group, BITS - int(key[0]), max_bits)

    return slices.groupBy("depth", "prefix").applyInPandas(meet, "a long, b long")


def _deal(pending: DataFrame, depth: int, lead: int, half: int) -> DataFrame:
    """Move each fingerprint to every prefix, `lead` bits longer, its variants can have."""
    ways = F.array(
        *(F.struct(F.lit(m).cast("long").alias("mask"), F.lit(n).alias("cost")) for m, n in flips(lead, half))
    )
    own = F.shiftrightunsigned("print", BITS - depth - lead).bitwiseAND(F.lit((1 << lead) - 1))
    return (
        pending.select("*", F.explode(ways).alias("way"))
        .where(F.col("way.cost") <= F.col("flips_left"))
        .select(
            "print",
            F.shiftleft("prefix", lead).bitwiseOR(own.bitwiseXOR(F.col("way.mask"))).alias("prefix"),
            (F.col("flips_left") - F.col("way.cost")).alias("flips_left"),
        )
    )


def _meetings(group: pd.DataFrame, bits: int, max_bits: int) -> pd.DataFrame:
    """Links among the fingerprints of one prefix that share a variant of its low bits."""
    prints = group["print"].to_numpy().view(np.uint64)
    left = group["flips_left"].to_numpy()
    low = prints & np.uint64((1 << bits) - 1)
    values, owners = [], []
    for flip in np.unique(left):
        who = np.flatnonzero(left == flip)
        masks = np.array([m for m, _ in flips(bits, int(flip))], dtype=np.uint64)
        values.append((low[who][:, None] ^ masks).ravel())
        owners.append(np.repeat(who, len(masks)))
    values, owners = np.concatenate(values), np.concatenate(owners)
    # The owner fits below a hash of the variant, so that one plain sort brings equal
    # variants together; a false meeting shows when the pair is verified.
    room = max(int(len(prints) - 1).bit_length(), 1)
    mixed = (values ^ (values >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    packed = (mixed >> np.uint64(room) << np.uint64(room)) | owners.astype(np.uint64)
    packed.sort()
    code, owner = packed >> np.uint64(room), (packed & np.uint64((1 << room) - 1)).astype(np.int64)
    same = code[1:] == code[:-1]
    pairs = np.unique(np.stack([owner[:-1][same], owner[1:][same]], axis=1), axis=0)
    if not len(pairs):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    near = np.bitwise_count(prints[pairs[:, 0]] ^ prints[pairs[:, 1]]) <= max_bits
    if not near.all():  # two variants share a hash: group by the variants themselves
        order = np.lexsort((owners, values))
        same = values[order][1:] == values[order][:-1]
        pairs = np.stack([owners[order][:-1][same], owners[order][1:][same]], axis=1)
        near = np.bitwise_count(prints[pairs[:, 0]] ^ prints[pairs[:, 1]]) <= max_bits
    root = local_roots(len(prints), *pairs[near].T)
    moved = np.flatnonzero(root != np.arange(len(prints)))
    signed = prints.view(np.int64)
    return pd.DataFrame({"a": signed[moved], "b": signed[root[moved]]})


def local_roots(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of `size` indices over links a-b."""
    root = np.arange(size)
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (low == high).all():
            return root
        np.minimum.at(root, high, low)
        while (root != root[root]).any():
            root = root[root]


def near_duplicates(
    docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, id_col="doc_id", text_col="text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of `docs`.

    `fingerprint` is a signed long; `component_id` is the smallest id reachable over
    fingerprints at most `max_bits` bits apart, the row's own included. Null, empty and
    blank texts have fingerprint zero and are linked like any other. Rows without an id
    keep a row; their component is that of their fingerprint, null if it holds no id.
    Repeated rows stay repeated; an empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, shingle_words, id_col, text_col), "prints")
    rooted = _rooted(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), max_bits)
    least = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    named = stored(rooted.join(least, "root").select("fingerprint", "component_id"), "named")
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def _rooted(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Rows of distinct fingerprints with `root`, the same within a component."""
    distinct = stored(distinct, "distinct")
    roots = connected_components(linked_fingerprints(distinct, max_bits))
    rooted = distinct.join(roots.toDF("fingerprint", "root"), "fingerprint", "left")
    return stored(rooted.withColumn("root", F.coalesce("root", "fingerprint")), "rooted")


def without_near_duplicates(
    docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, id_col="doc_id", text_col="text"
) -> DataFrame:
    """The rows of `docs`, columns unchanged, that stand for their group of near-duplicates.

    Exactly one row of each component stays: that with the smallest id, a null id coming
    last; of rows alike in that the one whose text, then whose whole row, has the smallest
    hash; of wholly equal rows one. An empty table gives an empty result. The columns may
    have any names.
    """
    key = next(f"_key{n}" for n in itertools.count() if f"_key{n}".lower() not in map(str.lower, docs.columns))
    others = [F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(docs.columns) if c != text_col]
    text_hash = F.coalesce(F.md5(F.col(f"`{text_col}`")), F.lit(""))
    row_hash = F.md5(F.concat(text_hash, F.to_json(F.struct(*others)))) if others else text_hash
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), text_hash.alias("text_hash"), row_hash.alias("row_hash"),
        F.col(f"`{text_col}`").alias("text"),
    )

    def start():
        def convert(ids, text_hashes, row_hashes, texts):
            prints = np.array([text_fingerprint(t, shingle_words) for t in texts], dtype=np.uint64)
            return {"id": ids, "text_hash": text_hashes, "row_hash": row_hashes, "fingerprint": prints.view(np.int64)}

        return convert

    schema = "id long, text_hash string, row_hash string, fingerprint long"
    prints = map_batches(rows, rows.columns, schema, start)
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash", "row_hash")
    rooted = _rooted(prints.groupBy("fingerprint").agg(F.min(order).alias("best")), max_bits)
    best = stored(rooted.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row_hash").alias(key)), "best")
    return docs.withColumn(key, row_hash).join(best, key, "left_semi").dropDuplicates([key]).drop(key)
