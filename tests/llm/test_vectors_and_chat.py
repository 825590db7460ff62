"""Embedding joins, neighbour search, components and quotation linking."""

import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from compare import assert_same
from pyspark.sql import functions as F

from ticketloom.llm import chat, vectors
from ticketloom.llm.components import connected_components
from ticketloom.llm.oracle import ORACLE_SQL
from ticketloom.llm.simhash import local_roots

SCHEMA = "vec_id long, embedding array<float>, label int, cell string, vector string"
ODD = [
    (9001, None), (9002, [0.0] * 16), (9003, [1.0] * 15 + [None]), (9004, [float("nan")] + [1.0] * 15),
    (9005, [float("inf")] + [1.0] * 15), (9006, [1.0, 2.0]), (9007, []), (None, [1.0] * 16),
]


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "clash", "clash") for i, v in rows], SCHEMA)


def clustered(seed=0, size=16):
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=size) for _ in range(250)]
    for centre in rows[:4]:  # near copies of near copies: chains as well as dense groups
        value = centre
        for _ in range(40):
            value = value + rng.normal(size=size) * 0.12
            rows.append(value)
    rows += [rows[0]] * 30 + [rows[1] * 3.0] * 5
    return [(i * 5, np.float32(v).tolist()) for i, v in enumerate(rows)]


def brute_links(rows, least):
    v = np.array([v for _, v in rows], dtype=np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    linked = v @ v.T >= least
    np.fill_diagonal(linked, False)
    return linked


def dense(seed=2, size=16):
    """Around each centre rows at all distances: inside, at and beyond the linking angle."""
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=size) for _ in range(60)]
    for centre in rows[:3]:
        for spread in (0.01, 0.05, 0.1, 0.2, 0.3):
            rows += [centre + rng.normal(size=size) * spread for _ in range(60)]
    return [(i * 5, np.float32(v).tolist()) for i, v in enumerate(rows)]


@pytest.mark.parametrize(("table_of", "chunk", "ball"), [(clustered, 4096, 32), (clustered, 37, 4), (dense, 4096, 8), (dense, 50, 3)])
def test_near_vectors_equal_brute_force(spark, monkeypatch, table_of, chunk, ball):
    """The smaller chunks split every cell into blocks, and balls over several parts."""
    monkeypatch.setattr(vectors, "CELL_CHUNK", chunk)
    monkeypatch.setattr(vectors, "MIN_BALL", ball)
    monkeypatch.setattr(vectors, "SLICE", 16)
    rows = table_of()
    linked = brute_links(rows, 0.95)
    ids = np.array([i for i, _ in rows])
    component = ids[local_roots(len(ids), *np.nonzero(linked))]
    got = {r.vec_id: r for r in vectors.near_vectors(table(spark, rows + ODD)).collect()}
    assert len(got) == len(rows) + len(ODD)
    for i, links, root in zip(ids.tolist(), linked.sum(axis=1).tolist(), component.tolist()):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (links, root, i == root)
    for i, _ in ODD:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_near_vectors_of_nothing(spark):
    assert vectors.near_vectors(table(spark, [])).count() == 0
    assert vectors.near_vectors(table(spark, ODD)).count() == len(ODD)
    twice = vectors.near_vectors(table(spark, [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])])).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in twice) == [(1, 1, 1), (1, 1, 1), (2, 0, 2)]


def mixed_lengths(seed=7):
    """Three lengths; equal rows under several ids, and ids that repeat."""
    rng = np.random.default_rng(seed)
    rows = []
    for size, count in ((2, 60), (5, 90), (16, 40)):
        own = [np.float32(rng.normal(size=size)).tolist() for _ in range(count)]
        rows += [(len(rows) + i, v) for i, v in enumerate(own + own[:3])]
    rows.append((500, [3.0]))
    return rows + [(0, rows[0][1])] * 2 + [(0, rows[100][1]), (20, rows[5][1])]


def same_length(rows):
    size = np.array([len(v) for _, v in rows])
    return size[:, None] == size


def products(rows, unit):
    wide = np.zeros((len(rows), max(len(v) for _, v in rows)))
    for i, (_, v) in enumerate(rows):
        wide[i, : len(v)] = v
    if unit:
        wide /= np.linalg.norm(wide, axis=1, keepdims=True)
    return wide @ wide.T


def test_near_vectors_of_several_lengths_equal_brute_force(spark):
    rows = mixed_lengths()
    linked = (products(rows, True) >= 0.95) & same_length(rows)
    np.fill_diagonal(linked, False)
    ids = np.array([i for i, _ in rows])
    root = local_roots(len(ids), *np.nonzero(linked))
    least = {r: ids[root == r].min() for r in set(root.tolist())}
    want = sorted((int(i), int(n), int(least[r])) for i, n, r in zip(ids, linked.sum(axis=1), root))
    got = vectors.near_vectors(table(spark, rows + [(9001, None)])).where("vec_id < 9000").collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == want


def random_rows(count, size=64, seed=3):
    values = np.random.default_rng(seed).normal(size=(count, size))
    values[-40:] = values[:40] + np.random.default_rng(seed).normal(size=(40, size)) * 0.1
    return [(i, v) for i, v in enumerate(values.astype(np.float32).tolist())]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_a_task_hands_back_no_more_rows_than_the_table_has(spark, monkeypatch, tmp_path, kind):
    """Random rows have neighbouring cells without end; none is copied into them, in any task."""
    rows, pivots = random_rows(2000), np.array([v for _, v in random_rows(100, seed=4)], dtype=np.float64)
    pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)

    def watched(real):
        def mapped(self, run, schema, **options):
            def counted(batches):
                total = 0
                for out in run(batches):
                    total += len(out)
                    yield out
                with open(f"{tmp_path}/rows", "a") as file:
                    file.write(f"{total}\n")

            return real(self, counted, schema, **options)

        return mapped

    for name in ("mapInPandas", "mapInArrow"):
        monkeypatch.setattr(type(spark.range(0)), name, watched(getattr(type(spark.range(0)), name)))
    monkeypatch.setattr(vectors, "learned", lambda *_: {64: pivots})
    monkeypatch.setattr(vectors, "CELL_CHUNK", 64)
    linked = brute_links(rows, 0.95)
    frame = table(spark, rows).withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(frame).collect()}
    component = local_roots(len(rows), *np.nonzero(linked))
    assert linked.any()
    assert got == {i: (int(n), int(c)) for i, (n, c) in enumerate(zip(linked.sum(axis=1), component))}
    # A bounded number of rows for each that a task got, and a task got no more than all.
    assert max(map(int, (tmp_path / "rows").read_text().split())) <= len(rows)


def test_leading_components_bound_the_product():
    units = vectors._unit(np.array([v for _, v in dense(size=48)]))
    lead = vectors._leading(units)
    assert lead.shape == (len(units), 19)
    assert (lead @ lead.T >= units @ units.T - 1e-5).all()
    assert vectors._leading(units[:, :10]) is None


@pytest.mark.parametrize("block", [4096, 20])
def test_neighbours_of_several_lengths_and_repeated_ids(spark, monkeypatch, block):
    """A radius of all bits makes the search exact, so it must equal brute force."""
    monkeypatch.setattr(vectors, "ROWS_PER_BLOCK", block)
    rows = mixed_lengths()
    every, rows = rows, [row for n, row in enumerate(rows) if row not in rows[:n]]
    score, alike = products(rows, False), same_length(rows)
    ids = np.array([i for i, _ in rows])
    want = []
    for q in np.flatnonzero(ids % 20 == 0):
        others = [r for r in np.flatnonzero(alike[q]) if r != q]
        best = sorted(others, key=lambda r: (-round(score[q, r], 9), ids[r]))[:20]
        want += [(int(ids[q]), n + 1, round(float(score[q, r]), 6)) for n, r in enumerate(best)]
    got = vectors.nearest_neighbours(table(spark, every + ODD[:5]), "vec_id % 20 = 0", recall=1.0, k=20).collect()
    # The radius comes from the sample, which is the whole table here, so recall 1 is exact.
    assert sorted((r.query_id, r["rank"], round(r.score, 6)) for r in got) == sorted(want)


def test_only_retrieved_rows_are_multiplied():
    """With no row within the radius a query gets nothing, whatever its products are."""
    rng = np.random.default_rng(1)
    values = rng.normal(size=(50, 8))
    codes = vectors.RotatedCodes.fit(values)
    frame = pd.DataFrame({"vec_id": range(50), "row": range(50), "vector": list(values)})
    hit = np.bitwise_count(codes.codes(values)[:, None, :] ^ codes.codes(values)).sum(axis=2) <= 30
    np.fill_diagonal(hit, False)
    got = vectors._nearest(frame, frame, codes, 30, 50)
    assert sorted(zip(got["query"], got["row"])) == sorted(zip(*np.nonzero(hit)))


def test_neighbours_of_nothing(spark):
    for rows in ([], ODD, [(20, [1.0, 2.0])], [(7, [1.0, 2.0]), (8, [1.0, 2.0])]):
        found = vectors.nearest_neighbours(table(spark, rows), "vec_id % 20 = 0")
        assert found.columns == ["query_id", "rank", "vec_id", "score"]
        assert found.where("vec_id < 9000").count() == 0


def test_neighbours_are_ordered_exact_and_mostly_found(spark, monkeypatch):
    monkeypatch.setattr(vectors, "ROWS_PER_BLOCK", 100)
    rows = clustered(1)
    got = vectors.nearest_neighbours(table(spark, rows + ODD), "vec_id % 20 = 0", k=20).collect()
    ids, v = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float64)
    found, hits, all_of = {}, 0, 0
    for row in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(row.query_id, []).append(row)
    assert sorted(found) == [i for i in ids.tolist() if i % 20 == 0]
    for query, own in found.items():
        score = (v * v[ids == query]).sum(axis=1)
        exact = dict(zip(ids.tolist(), score.tolist()))
        assert [r.rank for r in own] == list(range(1, 21))
        assert all(r.score == exact[r.vec_id] and r.vec_id != query for r in own)
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        score[ids == query] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        hits += len({r.vec_id for r in own} & set(best.tolist()))
        all_of += 20
    assert hits >= 0.9 * all_of


def test_codes_within_a_radius_are_all_retrieved():
    rng = np.random.default_rng(4)
    rows, queries = rng.integers(0, 256, (300, 16), dtype=np.uint8), rng.integers(0, 256, (40, 16), dtype=np.uint8)
    queries[:10] = rows[:10] ^ (rng.random((10, 16)) < 0.3).astype(np.uint8)
    far = np.bitwise_count(queries[:, None, :] ^ rows).sum(axis=2)
    for radius in (0, 3, 17, 40, 63, 128):
        assert (vectors._within(rows, queries, radius) == (far <= radius)).all()


def test_neighbours_of_few_rows(spark):
    few = table(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (20, [0.0, 1.0]), (1, [0.5, 0.0])] + ODD[:3])
    got = vectors.nearest_neighbours(few, "vec_id % 20 = 0", k=5).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [
        (0, 1, 1, 0.5), (0, 2, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0),
    ]
    for rows in ([], [(0, [1.0])]):
        assert vectors.nearest_neighbours(table(spark, rows), "vec_id % 20 = 0").count() == 0


def test_components_of_chains_stars_and_odd_links(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 60)] + [(7000, 7000), (None, 5)]
    links += [(rng.randint(2000, 2300), rng.randint(2000, 2300)) for _ in range(150)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    proper = [(a, b) for a, b in links if a is not None and a != b]
    nodes = sorted({n for pair in proper for n in pair})
    at = {n: i for i, n in enumerate(nodes)}
    root = local_roots(len(nodes), np.array([at[a] for a, _ in proper]), np.array([at[b] for _, b in proper]))
    assert sorted(got) == nodes
    names = {}
    for node, r in zip(nodes, root.tolist()):
        assert names.setdefault(r, got[node]) == got[node]
    assert len(set(names.values())) == len(names)


# -- quotation linking ------------------------------------------------------------------


def threads():
    rng, rows = random.Random(3), []
    lines = ["", "  ", "Hello There", "A b\tc", "yes.", "x > y", "Longer line here"]
    for conv in range(60):
        texts = []
        for turn in range(rng.randint(1, 9)):
            own = "\n".join(rng.choice(lines) + rng.choice(["", f" {rng.randint(0, 30)}"]) for _ in range(rng.randint(0, 5)))
            quotes = ""
            for _ in range(rng.randint(0, 2) if texts else 0):
                source = rng.choice(texts).split("\n")
                first = rng.randint(0, len(source) - 1)
                part = source[first : first + rng.randint(1, 4)]
                quotes += "\n".join(rng.choice(["> ", ">", " > "]) + line for line in part) + "\n" + rng.choice(["", "mid\n"])
            texts.append(quotes + own)
            rows.append((conv, turn, rng.choice(["user", None]), texts[-1], 1))
    return rows + [(None, 1, "user", "> Hello There", 1), (1, None, "user", "a", 1), (2, 0, "user", None, 1), rows[5], rows[5]]


def test_quotations_equal_sql(spark):
    df = spark.createDataFrame(threads(), "conv_id long, turn long, role string, text string, level int")
    got = chat.link_quotations(df).toPandas()
    conversations = df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"})
    with duckdb.connect() as db:
        db.register("conversations", conversations)
        assert_same(got, db.execute(ORACLE_SQL["op3_chat_formatting"]).df())
    assert got.depth.max() > 1 and (got.linked_passages > 0).sum() > 20
    assert chat.link_quotations(df.where("false")).count() == 0


def test_a_reply_chain_is_one_thread_in_order(spark):
    rows = [
        (1, 0, "user", "How do I  sort this?"),
        (1, 1, "assistant", "> how do i sort this?\nUse ORDER BY."),
        (1, 2, "user", "An unrelated question."),
        (1, 3, "user", ">> How do I sort\n>> this?\n> Use ORDER BY.\nThanks!"),
    ]
    got = chat.link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    ordered = got.orderBy("conv_id", "thread_turn", "turn").collect()
    assert [(r.turn, r.reply_to, r.thread_turn, r.depth) for r in ordered] == [
        (0, None, 0, 0), (1, 0, 0, 1), (3, 1, 0, 2), (2, None, 2, 0),
    ]
    assert [r.reply_text for r in ordered] == ["How do I  sort this?", "Use ORDER BY.", "Thanks!", "An unrelated question."]


def test_conversations_in_reply_order(spark):
    """One conversation holds a third of all rows; ties, repeats, nulls and clashing names."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        conv = None if i % 50 == 7 else 0 if i % 3 == 0 else int(rng.integers(1, 20))
        turn = None if i % 41 == 3 else int(rng.integers(0, 40))
        thread = None if turn is None else int(rng.integers(0, turn + 1))
        rows.append((conv, turn, str(rng.choice(["user", "assistant"])), str(rng.integers(0, 3)), thread, f"p{i % 2}", i, 7))
    rows += rows[:40]
    names = "conv_id long, turn long, role string, reply_text string, thread_turn long, part string, row int, place int"
    df = spark.createDataFrame(rows, names)
    got = chat.in_reply_order(df)
    assert got.columns == [*df.columns[:-1], "place"]
    seen = {}
    for r in got.collect():
        seen.setdefault(r.conv_id, {})[r.place] = (r.thread_turn, r.turn, r.role, r.reply_text)
    nulls_first = lambda key: [(v is not None, v) for v in key]
    expected = {}
    for conv, turn, role, text, thread, *_ in rows:
        expected.setdefault(conv, []).append((thread, turn, role, text))
    assert seen.keys() == expected.keys()
    for conv, messages in expected.items():
        assert [seen[conv][i + 1] for i in range(len(messages))] == sorted(messages, key=nulls_first)
    assert sorted(r.row for r in got.collect()) == sorted(r[6] for r in rows)
    assert chat.in_reply_order(df.where("false")).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    linked = chat.link_quotations(spark.createDataFrame([(1, 0, "u", "a b"), (1, 1, "u", "c"), (1, 2, "u", "> a b\nd")], "conv_id long, turn long, role string, text string"))
    assert [(r.place, r.turn, r.reply_text) for r in chat.in_reply_order(linked).orderBy("place").collect()] == [(1, 0, "a b"), (2, 2, "d"), (3, 1, "c")]


def test_no_python_runs_in_quotation_linking(spark):
    df = spark.createDataFrame(threads(), "conv_id long, turn long, role string, text string, level int")
    plan = chat.link_quotations(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
