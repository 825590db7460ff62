import itertools
import random
import re
from collections import Counter

from ticketloom.llm import audit, queries

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(docs, labels):
    """Every filter in every order, document by document."""
    flagged = []
    for i, text, lang in docs:
        text = text or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs),
        }
        mine = [(q, t) for j, q, t in labels if i is not None and j == i]
        flagged.append((lang or "", {f for f in fails if fails[f]}, any(q == 1 for q, _ in mine), any(t == 1 for _, t in mine)))
    out, removed_by = {}, Counter()
    for part in {p for p, *_ in flagged}:
        rows = [row for row in flagged if row[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, own in enumerate(order, 1):
                left = [r for r in rows if not r[1] & set(order[: step - 1])]
                gone = [r for r in left if own in r[1]]
                removed_by[part, own] += len(gone)
                out[part, order, step] = (
                    len(left) - len(gone), len(gone), sum(own in r[1] for r in rows) - len(gone),
                    sum(r[1] == {own} for r in rows), sum(r[2] for r in gone), sum(r[3] for r in gone),
                )
    return {key: (*row, removed_by[key[0], key[1][key[2] - 1]]) for key, row in out.items()}


def collected(result):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in result.collect()}


def random_docs(rng, n):
    words = ["a", "b", "Ab", "ABC", "é", "x#", "\x1cq", "\xa0z", " ", *map(str, range(300))]
    pool = [None, "", " \n", "one", "ONE", "a " * 300, "a\tb\x0bc\x0cd\r" * 60]
    for _ in range(8):
        pool.append(" ".join(rng.choices(words, k=rng.choice([150, 260, 400]))))
    docs = [(None if rng.random() < 0.1 else rng.randrange(n), rng.choice(pool), rng.choice([None, "", "en", "fr"])) for _ in range(n)]
    labels = [(rng.choice([None, *range(n)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(n)]
    return docs, labels


def test_equals_applying_every_order(spark, tmp_path):
    for seed in (1, 2):
        docs, labels = random_docs(random.Random(seed), 120)
        spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS fails", "'k' AS part", "2 AS n", "3 AS shard").repartition(
            5
        ).write.parquet(f"{tmp_path}/{seed}/documents.parquet")
        spark.createDataFrame(labels, LABELS).selectExpr("*", "4 AS n", "5 AS good").write.parquet(f"{tmp_path}/{seed}/labels.parquet")
        got = queries.op13_filter_audit(spark, f"{tmp_path}/{seed}")
        assert got.columns[:3] == ["part", "filter_order", "step"]
        assert collected(got) == brute(docs, labels)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert audit.audit(docs, labels).count() == 0
    some = [(1, None, None), (2, "", "en"), (None, "", "en")]
    assert collected(audit.audit(spark.createDataFrame(some, DOCS), labels)) == brute(some, [])


def test_the_matrix_numbers_words_once_for_all_shards(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["x", "y", "Zé", "日本", *map(str, range(500))], k=rng.choice([0, 5, 300]))) for _ in range(200)]
    texts += ["w" * 200_000 + " x " + "v" * 10]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], DOCS).repartition(4)
    matrix = audit.shards(docs, shard_bytes=20_000)
    assert matrix.count() > 8
    numbers = audit.dictionary(matrix, words_at_once=300)
    words = {}
    for row in numbers.where("shard is null").collect():
        words |= {row.base + nth: word for nth, word in enumerate(row.words.split("\n"))}
    assert sorted(words) == list(range(len(words)))
    assert sorted(words.values()) == sorted({w for t in texts for w in t.split()})
    seen = 0
    for shard in audit.csr_shards(matrix, numbers).collect():
        begin = 0
        for i, end in zip(shard.doc_ids, shard.row_ends):
            entries = {words[c]: n for c, n in zip(shard.indices[begin:end], shard.counts[begin:end])}
            assert entries == Counter(texts[i].split())
            begin, seen = end, seen + 1
    assert seen == len(texts)
