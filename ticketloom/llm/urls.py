"""URL filtering: host and path rules first, a character language model for the rest.

Two smoothed variable-order Markov models over bytes are learned from all distinct URLs
that the rules allow and block. A URL that no rule fits is allowed if its log-likelihood
difference per byte reaches a cut calibrated on URLs the models have not seen: on some
that are left out, or on all of them, each scored by what the other folds have counted.

The models are a table of n-grams, counted and looked up in Spark, so neither the driver
nor a task holds them. URLs are scored in blocks of bounded size: a block asks once for
each n-gram it has, however many of its URLs share it.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ticketloom.llm.storage import stored

ORDER = 5
FOLDS = 5
# An n-gram's fold stands above its order.
FOLD_BIT = 51
# URLs of a verdict with fewer than so many are dealt evenly over the folds.
FEW_URLS = 1000
SEEN_AT_LEAST = 3
BLOCK_BYTES = 1 << 16
BYTES_AT_ONCE = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits `host` and its subdomains where the URL's path starts with `path`."""

    verdict: str
    host: str
    path: str = ""

    @property
    def name(self) -> str:
        return self.host + self.path


class MarkovModel:
    """Bytes given up to `ORDER` bytes before them, with Witten-Bell smoothing.

    Longer contexts are kept only where seen `SEEN_AT_LEAST` times; elsewhere the model
    falls back to the longest shorter one it has. This is the definition for a few URLs in
    memory; `gram_differences` gives the same chances for a table of counts.
    """

    def __init__(self, urls: list[bytes]):
        counts: dict[bytes, Counter] = defaultdict(Counter)
        for url in urls:
            for at in range(len(url)):
                for order in range(min(ORDER, at) + 1):
                    counts[url[at - order : at]][url[at]] += 1
        self._table: dict[bytes, tuple[float, dict[int, float]]] = {}
        for context in sorted(counts, key=len):
            seen = counts[context]
            total, kinds = sum(seen.values()), len(seen)
            if context and total < SEEN_AT_LEAST:
                continue
            own = {c: (n + kinds * self._chance(context[1:], c, bool(context))) / (total + kinds) for c, n in seen.items()}
            self._table[context] = (kinds / (total + kinds), own)

    def _chance(self, context: bytes, char: int, any_context: bool = True) -> float:
        weight = 1.0
        while any_context:
            known = self._table.get(context)
            if known:
                if (own := known[1].get(char)) is not None:
                    return weight * own
                weight *= known[0]
            if not context:
                break
            context = context[1:]
        return weight / 256

    def log_likelihood(self, url: bytes) -> float:
        return sum(math.log(self._chance(url[max(0, at - ORDER) : at], url[at])) for at in range(len(url)))


@dataclass
class UrlModel:
    """Counted n-grams of the two models and the cut; without them everything is allowed."""

    counts: DataFrame | None
    cut: float = 0.0


def flat_bytes(urls: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all URLs end to end, each byte's place in its URL, and the lengths."""
    sizes = pc.fill_null(pc.binary_length(urls), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(b"".join(v for v in urls.cast(pa.binary()).to_pylist() if v), np.uint8)
    return data, np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes), sizes


def fold_bits(folds: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """For every byte of some URLs, its URL's fold as it stands in n-grams."""
    return np.repeat(folds.to_numpy(zero_copy_only=False).astype(np.int64) << FOLD_BIT, sizes)


def grams_by_order(data: np.ndarray, at: np.ndarray, fold: np.ndarray):
    """For some stretches of bytes: the n-grams that end at each, one array per order.

    An n-gram is one long: its order (bytes before the last) above 48 bits of bytes, and
    above that its fold. Bytes without so many before them in their URL have -1.
    """
    for start in range(0, len(data), BYTES_AT_ONCE):
        first = max(0, start - ORDER)
        some, place = data[first : start + BYTES_AT_ONCE].astype(np.int64), at[start : start + BYTES_AT_ONCE]
        value, above, orders = some.copy(), fold[start : start + BYTES_AT_ONCE], []
        for order in range(ORDER + 1):
            if order:
                value[order:] += some[:-order] << 8 * order
            orders.append(np.where(place >= order, value[start - first :] | order << 48 | above, -1))
        yield orders


def longest_grams(data: np.ndarray, at: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """The n-gram of the highest order that ends at each byte."""
    return np.concatenate([np.zeros(0, np.int64), *(np.max(orders, axis=0) for orders in grams_by_order(data, at, fold))])


def count_grams(ruled: DataFrame, fold: str = "0") -> DataFrame:
    """(gram, allow, block): how often each n-gram of any order is in URLs of a verdict."""

    def run(batches):
        for batch in batches:
            for verdict in ("allow", "block"):
                own = batch.filter(pc.equal(batch.column(0), verdict))
                data, at, sizes = flat_bytes(own.column(1))
                for orders in grams_by_order(data, at, fold_bits(own.column(2), sizes)):
                    for found in orders:
                        grams, n = np.unique(found[found >= 0], return_counts=True)
                        n, none = n.astype(np.int64), np.zeros(len(n), np.int64)
                        pair = (n, none) if verdict == "allow" else (none, n)
                        yield pa.RecordBatch.from_arrays([*map(pa.array, (grams, *pair))], names=["gram", "allow", "block"])

    found = ruled.select("rule_verdict", "url", F.expr(fold).cast("long").alias("fold")).mapInArrow(run, "gram long, allow long, block long")
    return found.groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))


def gram_differences(asked: DataFrame, counts: DataFrame) -> DataFrame:
    """(gram, difference): log chance of the last byte when allowed less that when blocked.

    With n-gram and context counted, the chance is (n + kinds * c) / (total + kinds), where
    c is that of the n-gram without its first byte; with an unknown context it is c.
    N-grams of different folds have nothing to do with each other.
    """

    def cut_to(order: int) -> Column:
        return F.col("gram").bitwiseAND((1 << 8 * (order + 1)) - 1).bitwiseOR(F.lit(order << 48)).bitwiseOR(fold)

    fold = F.col("gram").bitwiseAND(F.lit(-1 << FOLD_BIT))
    order = F.shiftright("gram", 48).bitwiseAND((1 << FOLD_BIT - 48) - 1)
    cuts = [F.when(order > k, cut_to(k)) for k in range(ORDER)]
    # An n-gram asked for needs all its shorter ones.
    needed = asked.select("gram").distinct().select(F.explode(F.array("gram", *cuts)).alias("gram")).where("gram is not null")
    rows = counts.withColumn("asked", F.lit(0)).unionByName(
        needed.distinct().select("gram", F.lit(0).cast("long").alias("allow"), F.lit(0).cast("long").alias("block"), F.lit(1).alias("asked"))
    )
    rows = rows.groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"), F.max("asked").alias("asked"))
    # At most 256 rows a context.
    context, columns = Window.partitionBy(F.shiftright("gram", 8)), {}
    for verdict in ("allow", "block"):
        n, total = F.col(verdict), F.sum(verdict).over(context)
        kinds = F.sum((F.col(verdict) > 0).cast("long")).over(context)
        known = (total >= SEEN_AT_LEAST) | ((order == 0) & (total > 0))
        columns[f"{verdict}_own"] = F.when(known, n / (total + kinds)).otherwise(0.0)
        columns[f"{verdict}_back"] = F.when(known, kinds / (total + kinds)).otherwise(1.0)
    rows = stored(rows.select("gram", "asked", *(c.alias(name) for name, c in columns.items())).where("asked = 1"), "grams")
    below, parts = None, []
    for k in range(ORDER + 1):
        own = rows.where(order == k)
        if below is None:
            own = own.withColumns({"allow_c": F.lit(1 / 256), "block_c": F.lit(1 / 256)})
        else:
            shorter_ones = below.select(F.col("gram").alias("shorter"), F.col("allow").alias("allow_c"), F.col("block").alias("block_c"))
            own = own.withColumn("shorter", cut_to(k - 1)).join(shorter_ones, "shorter")
        chances = [(F.col(f"{v}_own") + F.col(f"{v}_back") * F.col(f"{v}_c")).alias(v) for v in ("allow", "block")]
        below = stored(own.select("gram", *chances), f"order{k}")
        parts.append(below)
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.select("gram", (F.log("allow") - F.log("block")).alias("difference"))


def with_differences(urls: DataFrame, counts: DataFrame, fold: str = "0") -> DataFrame:
    """`urls`, whose column `url` is neither null nor empty, with the difference per byte
    by the counts of each URL's fold.

    Rows are numbered into blocks of about `BLOCK_BYTES` of URLs where they lie, so a URL
    in very many rows is dealt over many blocks.
    """
    at, schema = urls.columns.index("url"), urls.schema
    in_blocks = StructType([*schema.fields, StructField("_fold", LongType()), StructField("_block", LongType())])

    def number(batches):
        done = 0
        first = TaskContext.get().partitionId() << 32
        for batch in batches:
            ends = done + np.cumsum(pc.binary_length(batch.column(at)).to_numpy(zero_copy_only=False).astype(np.int64))
            done = int(ends[-1]) if len(ends) else done
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first + ends // BLOCK_BYTES)], names=in_blocks.names)

    def ask(batches):
        for batch in batches:
            block = batch.column(0).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.diff(block, prepend=-1))
            for start, end in zip(starts, [*starts[1:], len(block)]):
                some = batch.slice(start, end - start)
                data, places, sizes = flat_bytes(some.column(1))
                grams = np.unique(longest_grams(data, places, fold_bits(some.column(2), sizes)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), block[start])), pa.array(grams)], names=["_block", "gram"])

    def add_up(rows: pa.Table, known: pa.Table) -> pa.Table:
        data, places, sizes = flat_bytes(rows.column("url").combine_chunks())
        grams = known.column("gram").to_numpy()
        by_gram = np.argsort(grams)
        asked_for = longest_grams(data, places, fold_bits(rows.column("_fold").combine_chunks(), sizes))
        own = known.column("difference").to_numpy()[by_gram][np.searchsorted(grams[by_gram], asked_for)]
        found = np.add.reduceat(own, np.cumsum(sizes) - sizes) / sizes
        return rows.drop_columns(["_fold", "_block"]).append_column("difference", pa.array(found))

    blocks = stored(urls.withColumn("_fold", F.expr(fold).cast("long")).mapInArrow(number, in_blocks), "blocks")
    asked = stored(blocks.select("_block", "url", "_fold").mapInArrow(ask, "_block long, gram long").distinct(), "asked")
    known = asked.join(gram_differences(asked, counts), "gram").select("_block", "gram", "difference")
    out = StructType([*schema.fields, StructField("difference", DoubleType())])
    return blocks.groupBy("_block").cogroup(known.groupBy("_block")).applyInArrow(add_up, out)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for null and without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def with_rules(pages: DataFrame, rules: list[Rule], url_col="url") -> DataFrame:
    """Add host, path, rule and rule_verdict; the longest rule that fits wins."""
    host, path = host_and_path(F.col(url_col))
    pages = pages.withColumns({"host": host, "path": path})
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        same = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        fits = same & F.col("path").startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return pages.withColumns({"rule": name, "rule_verdict": verdict})


def fit(pages: DataFrame, rules: list[Rule], cut_urls_per_class: int | None = 2_000, url_col="url") -> UrlModel:
    """Learn from the distinct URLs of either verdict and set the cut.

    The cut is the one with the best balanced accuracy on URLs the counts do not hold.
    With `cut_urls_per_class` these are left out of the model: a fifth of the distinct URLs
    of each verdict, at most so many, taken by a hash. With None every URL is counted and
    every URL sets the cut, scored by the counts of all folds but its own.
    """
    ruled = with_rules(pages.select(F.col(url_col).alias("url")), rules).where("url is not null and url <> ''")
    ruled = ruled.where("rule_verdict is not null").select("rule_verdict", "url").distinct()
    ruled = stored(ruled.withColumn("hash", F.xxhash64("url")), "ruled")
    sizes = {r["rule_verdict"]: r["count"] for r in ruled.groupBy("rule_verdict").count().collect()}
    if min(sizes.get(v, 0) for v in ("allow", "block")) < 2:
        return UrlModel(None)
    if cut_urls_per_class is None:
        return _cross_fitted(ruled, sizes)
    for_cut, learned = [], F.lit(False)
    for verdict in ("allow", "block"):
        own, taken = ruled.where(F.col("rule_verdict") == verdict), min(cut_urls_per_class, -(-sizes[verdict] // 5))
        # Bounded: `cut_urls_per_class` URLs.
        rows = own.orderBy("hash", "url").limit(taken).collect()
        last = F.struct(F.lit(rows[-1]["hash"]).alias("hash"), F.lit(rows[-1]["url"]).alias("url"))
        for_cut += [(verdict, r["url"]) for r in rows]
        learned = learned | ((F.col("rule_verdict") == verdict) & (F.struct("hash", "url") > last))
    counts = stored(count_grams(ruled.where(learned)), "counts")
    sample = pages.sparkSession.createDataFrame(for_cut, "rule_verdict string, url string")
    found = {"allow": [], "block": []}
    for row in with_differences(sample, counts).select("rule_verdict", "difference").collect():
        found[row["rule_verdict"]].append(row["difference"])
    return UrlModel(counts, best_cut(np.array(found["allow"]), np.array(found["block"])))


def _cross_fitted(ruled: DataFrame, sizes: dict[str, int]) -> UrlModel:
    folded = stored(in_folds(ruled, sizes).sortWithinPartitions("fold"), "folds")
    by_fold = stored(count_grams(folded, "fold"), "fold_counts")
    sums = [F.sum(v).alias(v) for v in ("allow", "block")]
    bare = F.col("gram").bitwiseAND((1 << FOLD_BIT) - 1)
    counts = stored(by_fold.groupBy(bare.alias("gram")).agg(*sums), "counts")
    # All folds' counts less a fold's own are those of the others.
    folds = F.explode(F.array(*(F.lit(f << FOLD_BIT) for f in range(1, FOLDS + 1))))
    every = counts.select("allow", "block", "gram", folds.alias("fold"))
    every = every.select(F.col("gram").bitwiseOR(F.col("fold")).alias("gram"), "allow", "block")
    others = every.unionByName(by_fold.select("gram", *((-F.col(v)).alias(v) for v in ("allow", "block"))))
    scored = with_differences(folded, others, "fold")
    return UrlModel(counts, best_cut_of(scored, sizes))


def in_folds(ruled: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """(rule_verdict, url, fold): folds from 1 on by hash; in turn for a verdict of few URLs,
    so that no fold has them all."""
    few = [verdict for verdict, size in sizes.items() if size < FEW_URLS]
    rank = F.row_number().over(Window.partitionBy("rule_verdict").orderBy("hash", "url"))
    are_few = F.col("rule_verdict").isin(few)
    parts = [
        ruled.where(some).select("rule_verdict", "url", (F.pmod(number, F.lit(FOLDS)) + 1).cast("long").alias("fold"))
        for some, number in ((~are_few, F.col("hash")), (are_few, rank))
    ]
    return parts[0].unionByName(parts[1])


def best_cut_of(scored: DataFrame, sizes: dict[str, int]) -> float:
    """`best_cut` of any number of rows (rule_verdict, difference): differences are brought
    into ranges, and the driver gets one row per range."""
    counted = [F.count_if(F.col("rule_verdict") == v).alias(v) for v in ("allow", "block")]
    counts = scored.groupBy("difference").agg(*counted)
    counts = stored(counts.repartitionByRange("difference").withColumn("range", F.spark_partition_id()), "cuts")
    totals = counts.groupBy("range").agg(F.min("difference").alias("first"), F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    before, allow, block = [], 0, 0
    ranges = sorted(totals.collect(), key=lambda r: r["first"])
    for own, after in zip(ranges, [*ranges[1:], None]):
        before.append((own["range"], after and after["first"], allow, block))
        allow, block = allow + own["allow"], block + own["block"]
    before = scored.sparkSession.createDataFrame(before, "range int, after double, allow_before long, block_before long")
    in_order = Window.partitionBy("range").orderBy("difference")
    up_to_here = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = counts.join(F.broadcast(before), "range").select(
        "difference",
        F.coalesce(F.lead("difference").over(in_order), "after").alias("next"),
        *(F.col(v).alias(v) for v in ("allow", "block")),
        *((F.col(f"{v}_before") + F.sum(v).over(up_to_here)).alias(f"{v}_sum") for v in ("allow", "block")),
    )
    # Equal neighbours have themselves half-way between.
    same = F.when(F.col("allow") + F.col("block") > 1, F.col("difference"))
    rows = rows.withColumn("cut", F.explode(F.array((F.col("difference") + F.col("next")) / 2, same))).where("cut is not null")
    below = {v: F.col(f"{v}_sum") - F.when(F.col("cut") > F.col("difference"), 0).otherwise(F.col(v)) for v in ("allow", "block")}
    good = (1 - below["allow"] / F.lit(sizes["allow"])) + below["block"] / F.lit(sizes["block"])
    return rows.orderBy(good.desc(), F.abs("cut"), "cut").first()["cut"]


def best_cut(allow: np.ndarray, block: np.ndarray) -> float:
    """The cut with the best balanced accuracy of all that lie half-way between two
    neighbouring differences; of equally good ones the nearest to zero, then the smaller."""
    every = np.sort(np.concatenate([allow, block]))
    cuts = (every[1:] + every[:-1]) / 2
    allowed = 1 - np.searchsorted(np.sort(allow), cuts) / len(allow)
    blocked = np.searchsorted(np.sort(block), cuts) / len(block)
    return float(cuts[np.lexsort((cuts, np.abs(cuts), -(allowed + blocked)))[0]])


def judge(pages: DataFrame, rules: list[Rule], model: UrlModel, id_col="page_id", url_col="url") -> DataFrame:
    """(page_id, host, path, rule, verdict, difference) of every row.

    `difference` is the log-likelihood difference per byte, null where a rule decides.
    Null and empty URLs that no rule fits have the cut itself and are allowed. Repeated
    rows get the same verdict.
    """
    columns = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    ruled = with_rules(columns, rules).select("page_id", "host", "path", "rule", "rule_verdict", "url")
    scored = F.col("rule").isNull() & (F.coalesce("url", F.lit("")) != "") & F.lit(model.counts is not None)
    judged = ruled.where(~scored).withColumn("difference", F.when(F.col("rule").isNull(), F.lit(float(model.cut))))
    if model.counts is not None:
        judged = judged.unionByName(with_differences(ruled.where(scored), model.counts))
    by_model = F.when(F.col("difference") >= model.cut, "allow").otherwise("block")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", by_model).alias("verdict"), "difference"
    )
