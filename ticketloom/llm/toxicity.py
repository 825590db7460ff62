"""Toxicity scores from subword-bag embeddings averaged into a linear softmax.

A text is read in windows of a few words. A window is the bag of the hashed character
n-grams of its words; the mean of their embeddings goes into a softmax over clean and
toxic. Embeddings and softmax are trained together in numpy. A text is as toxic as its
most toxic window, so a few words are found in a text of any length, and a misspelling or
an unseen form is judged by the n-grams it shares.
"""

from __future__ import annotations

import functools
from dataclasses import astuple, dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.storage import filter_batches, map_batches, stored

WINDOW_WORDS = 4
NGRAMS = (3, 4, 5)
BUCKET_BITS = 17
CHARS_AT_ONCE = 400_000
GRAMS_AT_ONCE = 1_000_000
MIN_TEXTS = 3
STEP = 200.0


@dataclass(frozen=True)
class ToxicityModel:
    """Per-bucket logits (embedding times softmax weights), bias, and the text-level cut."""

    logits: np.ndarray
    bias: float
    cut: float

    def best(self, texts: list[str | None]) -> np.ndarray:
        """Logit of each text's most toxic window, very small for one without words."""
        best = np.full(len(texts), -1e9)
        for rows, windows in _windows_of(texts):
            np.maximum.at(best, rows, windows.means(self.logits) + self.bias)
        return best

    def scores(self, texts: list[str | None]) -> np.ndarray:
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(self.cut - self.best(texts)))


@dataclass
class Windows:
    """Hashed n-grams of consecutive windows, laid out by position."""

    buckets: list[np.ndarray]
    valid: list[np.ndarray]
    starts: np.ndarray

    def means(self, logits: np.ndarray) -> np.ndarray:
        total, count = 0.0, 0
        for bucket, valid in zip(self.buckets, self.valid):
            total = total + np.add.reduceat(np.where(valid, logits[bucket], np.float32(0)), self.starts, dtype=np.float64)
            count = count + np.add.reduceat(valid, self.starts, dtype=np.int64)
        return total / np.maximum(count, 1)

    def bags(self) -> list[np.ndarray]:
        ends = np.append(self.starts[1:], len(self.buckets[0]))
        return [
            np.concatenate([b[s:e][v[s:e]] for b, v in zip(self.buckets, self.valid)])
            for s, e in zip(self.starts, ends)
        ]


def _segments(text: str):
    """A long text in parts that end at a space, so memory does not grow with it."""
    first = 0
    while first < len(text):
        end = text.find(" ", first + CHARS_AT_ONCE)
        end = len(text) if end < 0 else end
        yield text[first:end]
        first = end


def _windows_of(texts: list[str | None]):
    """(row of each window, windows) over all texts, a bounded stretch at a time."""
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        for segment in _segments(text or ""):
            part = b" " + segment.lower().encode("utf-8", "replace") + b" "
            rows.append(row)
            parts.append(part)
            size += len(part)
            if size >= CHARS_AT_ONCE:
                yield from _windows(rows, parts)
                rows, parts, size = [], [], 0
    if rows:
        yield from _windows(rows, parts)


def _windows(rows: list[int], parts: list[bytes]):
    data = np.frombuffer(b"".join(parts) + b" " * max(NGRAMS), dtype=np.uint8)
    size = len(data) - max(NGRAMS)
    space = data <= 32
    words = np.flatnonzero(~space[1:size] & space[: size - 1])  # the space before each word
    if not len(words):
        return
    ends = np.cumsum([len(part) for part in parts])
    part = np.searchsorted(ends, words, side="right")
    nth = np.arange(len(words)) - np.searchsorted(part, part)
    opening = nth % WINDOW_WORDS == 0
    spaces = np.cumsum(space, dtype=np.int32)
    buckets, valid = [], []
    code = data[:size].astype(np.uint32)
    for n in range(2, max(NGRAMS) + 1):
        code = code * np.uint32(0x01000193) + data[n - 1 : size + n - 1]
        if n in NGRAMS:
            mixed = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(n)
            buckets.append(mixed >> np.uint32(32 - BUCKET_BITS))
            valid.append(spaces[n - 2 : size + n - 2] == spaces[:size])
    # Nothing before the first word: its space may follow other spaces.
    for ok in valid:
        ok[: words[0]] = False
    yield np.array(rows)[part[opening]], Windows(buckets, valid, words[opening])


def training_sample(
    docs: DataFrame, labels: DataFrame, clean: int, toxic: int, id_col, text_col, label_col
) -> DataFrame:
    """(id, label, text) of a bounded sample of labelled texts that may be learned from.

    At most `clean` and `toxic` ids with that label, the smallest by a hash, of those whose
    crc32(id as text) mod 5 is not 0. Ids labelled both ways are left out.
    """
    ids = labels.where(F.crc32(F.col(id_col).cast("string")) % 5 != 0).groupBy(F.col(id_col).alias("id"))
    ids = ids.agg(F.min(label_col).alias("label"), F.max(label_col).alias("most")).where("label = most")
    rows = []
    for label, most in ((0, clean), (1, toxic)):
        some = ids.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(most)
        rows += [(r["id"], label) for r in some.collect()]
    sample = docs.sparkSession.createDataFrame(rows, "id long, label int")
    # Bounded: `clean` plus `toxic` ids.
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(sample), "id")


@dataclass
class Bags:
    """Windows of sampled texts, end to end: their n-grams, sizes and the text of each."""

    grams: np.ndarray
    sizes: np.ndarray
    text: np.ndarray
    label: np.ndarray

    @functools.cached_property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    def grams_of(self, windows: np.ndarray) -> np.ndarray:
        size = self.sizes[windows]
        ends = np.cumsum(size)
        return self.grams[np.repeat(self.starts[windows] - (ends - size), size) + np.arange(size.sum())]

    def means(self, logits: np.ndarray) -> np.ndarray:
        """Mean logit of each window, a bounded stretch of n-grams at a time."""
        sums, first = np.empty(len(self.sizes)), 0
        while first < len(sums):
            start = self.starts[first]
            stop = max(first + 1, int(np.searchsorted(self.starts, start + GRAMS_AT_ONCE)))
            end = self.starts[stop] if stop < len(sums) else len(self.grams)
            some = logits[self.grams[start:end]]
            sums[first:stop] = np.add.reduceat(some, self.starts[first:stop] - start, dtype=np.float64)
            first = stop
        return sums / self.sizes

    def texts_with(self) -> np.ndarray:
        """In how many texts each bucket occurs."""
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        bounds = np.append(self.starts[np.flatnonzero(np.diff(self.text, prepend=-1))], len(self.grams))
        for start, end in zip(bounds[:-1], bounds[1:]):
            counts[np.unique(self.grams[start:end])] += 1
        return counts


def _too_many(texts: DataFrame, toxic_windows: int) -> list[int]:
    """Sampled toxic ids to leave out, so that the others have at most so many windows.

    Ids are taken in the order of a hash, each whole; the shortest one always is.
    """

    def start():
        def convert(ids, texts):
            return {"id": ids, "windows": [sum(len(rows.starts) for _, rows in _windows_of([text])) for text in texts]}

        return convert

    sizes = map_batches(texts.where("label = 1"), ["id", "text"], "id long, windows long", start)
    sizes = sizes.groupBy("id").agg(F.max("windows").alias("windows"), F.xxhash64("id").alias("hash")).collect()
    if sizes and min(row["windows"] for row in sizes) > toxic_windows:
        shortest = min(sizes, key=lambda row: (row["windows"], row["hash"]))
        return [row["id"] for row in sizes if row != shortest]
    total, out = 0, []
    for row in sorted(sizes, key=lambda row: (row["hash"], row["id"])):
        if total + row["windows"] <= toxic_windows:
            total += row["windows"]
        else:
            out.append(row["id"])
    return out


def _bags(texts: DataFrame, windows_per_text: int, toxic_windows: int) -> Bags:
    """Windows of each sampled id: all of toxic texts, of which any may be the toxic one,
    and at most `windows_per_text`, evenly spread, of clean texts.
    """
    if out := _too_many(texts, toxic_windows):
        texts = texts.where(~((F.col("label") == 1) & F.col("id").isin(out)))

    def start():
        def convert(ids, labels, texts):
            out = []
            for label, text in zip(labels, texts):
                own = [bag for _, windows in _windows_of([text]) for bag in windows.bags()]
                step = 1 if label else max(1, -(-len(own) // windows_per_text))
                own = [bag for bag in own[::step] if len(bag)]
                sizes = np.array([len(own), *map(len, own)], dtype="<u4")
                out.append(np.concatenate([sizes, *own]).astype("<u4").tobytes())
            return {"id": ids, "label": labels, "bags": out}

        return convert

    got = map_batches(texts, ["id", "label", "text"], "id long, label int, bags binary", start)
    got = got.groupBy("id", "label").agg(F.min("bags").alias("bags"))
    # A partition at a time: the driver's JVM never holds all of them.
    got = sorted(got.toLocalIterator(), key=lambda row: row["id"])
    labels = np.array([row["label"] for row in got], dtype=np.int64)
    values = [np.frombuffer(row["bags"], dtype="<u4") for row in got]
    del got
    counts = np.array([v[0] for v in values], dtype=np.int64)
    sizes = np.concatenate([np.zeros(0, np.uint32), *(v[1 : 1 + v[0]] for v in values)]).astype(np.int64)
    end = int(sizes.sum())
    grams = np.empty(end, np.uint32)
    while values:  # each goes as soon as it is copied
        own = values.pop()
        own = own[1 + own[0] :]
        grams[end - len(own) : end] = own
        end -= len(own)
    return Bags(grams, sizes, np.repeat(np.arange(len(labels)), counts), np.repeat(labels, counts))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    clean: int = 4000,
    toxic: int = 2000,
    windows_per_text: int = 40,
    toxic_windows: int = 500_000,
    dimensions: int = 8,
    steps: int = 1500,
    id_col="doc_id",
    text_col="text",
    label_col="toxic",
) -> ToxicityModel:
    """Learn from a bounded sample of labelled texts whose crc32(id as text) mod 5 is not 0.

    A clean text gives at most `windows_per_text` windows, a toxic one all it has; all
    toxic texts together give at most `toxic_windows`, by taking fewer texts.

    Of a toxic text not every window is toxic, so training runs twice: first every window
    takes its text's label, then toxic texts keep only the windows the first model finds
    toxic, the best one at least. Then the sampled texts are scored whole, and the cut
    between them becomes score 0.5. Without labelled texts of both kinds every score is
    0, or 1 if all are toxic.
    """
    sample = stored(training_sample(docs, labels, clean, toxic, id_col, text_col, label_col), "sample")
    bags = _bags(sample, windows_per_text, toxic_windows)
    kinds = {*bags.label.tolist()}
    if len(kinds) < 2:
        never = -np.inf if kinds == {1} else np.inf
        return ToxicityModel(np.zeros(1 << BUCKET_BITS, np.float32), 0.0, never)
    known = bags.texts_with() >= MIN_TEXTS
    logits, bias = _train(bags, np.arange(len(bags.label)), known, dimensions, steps)
    found = bags.means(logits) + bias
    top = np.full(bags.text.max() + 1, -np.inf)
    np.maximum.at(top, bags.text, found)
    best = top[bags.text]
    keep = np.flatnonzero((bags.label == 0) | (found >= np.minimum(best, np.maximum(0.0, best / 2))))
    logits, bias = _train(bags, keep, known, dimensions, steps)
    model = ToxicityModel(logits, bias, 0.0)

    def start():
        return lambda labels, texts: {"label": labels, "best": model.best(texts)}

    got = map_batches(sample, ["label", "text"], "label int, best double", start).collect()
    cut = _cut(np.array([r["best"] for r in got]), np.array([r["label"] for r in got]))
    return ToxicityModel(logits, bias, cut)


def _train(bags: Bags, windows: np.ndarray, known: np.ndarray, dimensions: int, steps: int):
    """Embeddings by gradient steps, softmax by Adagrad; each bucket's logit, and the bias.

    Only `known` buckets learn; the others keep a zero embedding, so that n-grams of one
    or two texts cannot learn those texts' labels by heart.
    """
    rng = np.random.default_rng(7)
    size = 1 << BUCKET_BITS
    embedding = rng.normal(0, 0.1, (dimensions, size)).astype(np.float32) * known
    weight = rng.normal(0, 0.5, (dimensions, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen = [np.full_like(weight, 1e-8), np.full_like(bias, 1e-8)]
    label = bags.label[windows]
    share = np.where(label == 1, 0.5 / (label == 1).sum(), 0.5 / (label == 0).sum()) * len(label)
    batch = max(32, min(1024, len(windows) // 16))
    step = 0
    while step < steps:
        order = rng.permutation(len(windows))
        for some in np.split(order, range(batch, len(order), batch))[: steps - step]:
            rate = STEP * (1 - step / steps)
            step += 1
            index, own = bags.grams_of(windows[some]), bags.sizes[windows[some]]
            at = np.cumsum(own) - own
            mean = np.stack([np.add.reduceat(e[index], at) for e in embedding]) / own
            z = mean.T @ weight + bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            error = z / z.sum(axis=1, keepdims=True)
            error[np.arange(len(some)), label[some]] -= 1
            error *= (share[some] / len(some))[:, None]
            back = np.repeat((weight @ error.T) / own, own, axis=1)
            for param, squares, grad in zip((weight, bias), seen, (mean @ error, error.sum(axis=0))):
                squares += grad**2
                param -= 0.05 * grad / np.sqrt(squares)
            for param, values in zip(embedding, back):
                param -= (rate * np.bincount(index, values, size)).astype(np.float32) * known
    difference = weight[:, 1] - weight[:, 0]
    return (difference @ embedding).astype(np.float32), float(bias[1] - bias[0])


def _cut(best: np.ndarray, truth: np.ndarray) -> float:
    """The middle of the widest gap among the cuts with the best balanced accuracy."""
    order = np.argsort(best)
    value, toxic = best[order], truth[order] == 1
    right = np.cumsum(~toxic) / max((~toxic).sum(), 1) + 1 - np.cumsum(toxic) / max(toxic.sum(), 1)
    gap = np.append(np.diff(value), 0.0)
    good = np.flatnonzero(right >= right.max() - 1e-9)
    at = good[np.argmax(gap[good])]
    return float(value[at] + gap[at] / 2)


def score(docs: DataFrame, model: ToxicityModel, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, whole texts.

    Null and empty texts score 0. A row without an id counts as held out. Repeated rows
    get the same score; an empty table gives an empty result.
    """
    columns = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))

    def start():
        model = ToxicityModel(*shared.value)

        def convert(ids, texts):
            return {"doc_id": ids, "score": model.scores(texts)}

        return convert

    scored = map_batches(columns, ["doc_id", "text"], "doc_id long, score double", start)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, model: ToxicityModel, text_col="text") -> DataFrame:
    """The rows of `docs` that score under 0.5, columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))

    def start():
        model = ToxicityModel(*shared.value)
        return lambda texts: model.scores(texts) < 0.5

    return filter_batches(docs, text_col, start)
