import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ticketloom.llm import queries, search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
WORDS = ["the", "The", "of", "a", "b1", "Éa", "éa", "naïve", "x-y", "q", "r", "s", "t_u", "1,2", "日本", "rare"]


def terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def brute(docs, items, k):
    """Every document scored against every item by the stated formula."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in counted]
    n, words = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for _, c in counted for t in c)
    out = defaultdict(list)
    for item, text in items:
        scored = []
        for (i, c), own in zip(counted, lengths):
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + ((25 * own * n) // words)
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out[item] += [(rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return {item: sorted(rows, key=str) for item, rows in out.items() if rows}


def searched(spark, docs, items, k, **how):
    docs = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS term", "1 AS shard", "'y' AS rank")
    items = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS query", "2 AS score")
    out = defaultdict(list)
    for row in search.search(search.build_index(docs, **how), items, k).collect():
        out[row.item_id].append((row["rank"], row.doc_id, row.score))
    return {item: sorted(rows, key=str) for item, rows in out.items()}


def random_docs(rng, n):
    out = []
    for i in range(n):
        size = rng.choice([0, 1, 3, 20, 200])
        text = " ".join(rng.choices(WORDS, weights=range(len(WORDS), 0, -1), k=size))
        out.append((None if rng.random() < 0.05 else rng.randrange(-n, n), rng.choice([text, text, text, None, "the of a"])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_ranks_equal_scoring_everything(spark, seed, monkeypatch):
    monkeypatch.setattr(search, "WINDOW", 16)
    rng = random.Random(seed)
    docs = random_docs(rng, 250)
    items = [(nth, " ".join(rng.choices(WORDS, k=rng.randint(0, 9)))) for nth in range(12)]
    items += [(50, None), (51, "unknown words"), (52, "rare rare the"), (None, "rare q")]
    for k in (3, 400):
        got = searched(spark, docs, items, k, shard_bytes=6000, block=4)
        assert got == brute(docs, items, k)


def test_repeated_queries_and_empty_tables(spark):
    docs = [(1, "the cat"), (2, "the dog the"), (2, "the dog the"), (3, "…")]
    items = [(7, "dog cat"), (7, "dog cat"), (8, "")]
    assert searched(spark, docs, items, 2) == brute(docs, items, 2)
    assert searched(spark, [], items, 2) == {}
    assert searched(spark, docs, [], 2) == {}
    assert searched(spark, [(1, None), (None, "")], items, 2) == {}


def test_a_very_long_text_is_searched_to_its_end(spark):
    docs = [(i, "the of " * 40) for i in range(30)] + [(99, "the of " * 300_000 + "needle")]
    assert searched(spark, docs, [(1, "needle of")], 3, shard_bytes=4000) == brute(docs, [(1, "needle of")], 3)


def test_shards_need_no_more_than_a_few_blocks():
    """Rejected candidates leave the blocks of common terms compressed."""
    rng = random.Random(9)
    texts = ["common " * rng.randint(1, 3) + "filler " * rng.randint(1, 60) for _ in range(4000)]
    for at in range(0, 4000, 400):
        texts[at] += " seldom seldom"
    ids = pa.array(range(4000), pa.int64())
    lists, own = search._index_shard(ids, pa.array(texts), 32)
    lengths = np.array(own["lengths"][0].as_py())
    shard = search.Shard(lengths, 4000, int(lengths.sum()))
    held = {
        row["term"]: search.Postings(
            shard, math.floor(1000 * math.log(8002 / (2 * row["df"] + 1))), row["blocks"], row["tops"], row["postings"]
        )
        for row in lists.to_pylist()
    }
    for term, found in held.items():  # blocks hold the postings, and their maxima are exact
        read = [found.block(nth) for nth in range(len(found.last))]
        assert np.concatenate([docs for docs, _ in read]).tolist() == [i for i, t in enumerate(texts) if term in t.split()]
        assert [int(gains.max()) for _, gains in read] == found.block_max.tolist()
        found.read.clear()
    best = shard.best([(held["common"], 1), (held["seldom"], 1)], 5)
    assert [doc % 400 for _, doc in best] == [0] * 5
    assert len(held["common"].read) < len(held["common"].last) / 4


def test_varints_round_trip():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**31 - 1, 5, 2**40])
    data, ends = search._varints(values)
    assert search._from_varints(data).tolist() == values.tolist()
    assert ends[-1] == len(data)


def test_the_registered_query(spark, tmp_path):
    rng = random.Random(4)
    docs, items = random_docs(rng, 80), [(i, " ".join(rng.choices(WORDS, k=6))) for i in range(5)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = defaultdict(list)
    for row in queries.op11_lexical_search(spark, str(tmp_path)).collect():
        out[row.item_id].append((row["rank"], row.doc_id, row.score))
    assert {item: sorted(rows, key=str) for item, rows in out.items()} == brute(docs, items, 20)
