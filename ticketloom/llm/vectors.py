"""Embedding vectors: which take part, samples, and neighbour searches over them."""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.llm.components import connected_components
from ticketloom.llm.simhash import local_roots
from ticketloom.llm.storage import in_small_batches, stored

CELL_CHUNK = 4096
MIN_BALL = 32
ANGLE_SLACK = 1e-6
SLICE = 512
# Of a block's vectors as doubles; a block is a row of binary columns.
BLOCK_BYTES = 4 << 20
# Blocks that a task meets with as many others.
BLOCKS_PER_SIDE = 16


def marked(vectors: DataFrame, id_col="vec_id", vector_col="embedding") -> DataFrame:
    """(vec_id, vector, usable) of every row.

    Not usable are rows without an id and vectors that are null, zero, or hold null or
    non-finite components. Vectors may differ in length; those that do have no measure in
    common and never meet.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    sound = F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    return rows.withColumn("usable", F.coalesce(sound, F.lit(False)))


def usable(vectors: DataFrame, id_col="vec_id", vector_col="embedding") -> DataFrame:
    """(vec_id, vector) of the usable rows, see `marked`."""
    return marked(vectors, id_col, vector_col).where("usable").select("vec_id", "vector")


def row_counts(rows: DataFrame) -> dict[int, int]:
    """Rows of each vector length: one number per length reaches the driver."""
    counts = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("rows"))
    return {r["size"]: r["rows"] for r in counts.collect()}


def learned(rows: DataFrame, counts: dict[int, int], most: int, learn) -> dict:
    """`learn(sample, rows)` of each vector length, in a task of its own.

    A sample holds at most `most` vectors, those with the smallest hashes, as doubles. Rows
    are distinct (vec_id, vector), so about twice as many come near enough to be among them.
    """
    table = F.broadcast(rows.sparkSession.createDataFrame(list(counts.items()), "size int, rows long"))
    place = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(1 << 30))
    sized = rows.select("vec_id", "vector", F.size("vector").alias("size"), place.alias("place")).join(table, "size")
    sample = sized.where(F.col("place") / (1 << 30) * F.col("rows") < max(2 * most, 64))

    def run(key, group):
        first = group.sort_values(["place", "vec_id"], kind="stable").head(most)
        model = learn(_matrix(first["vector"]), int(first["rows"].iloc[0]))
        return pd.DataFrame({"size": [key[0]], "model": [pickle.dumps(model)]})

    models = sample.groupBy("size").applyInPandas(run, "size int, model binary").collect()
    return {r["size"]: pickle.loads(r["model"]) for r in models}


def _matrix(column) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


# -- near duplicates ------------------------------------------------------------------


def spread_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Unit vectors of a sample, each the farthest from those before it."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    chosen, far = [0], np.full(len(unit), np.inf)
    while len(chosen) < min(count, len(unit)):
        far = np.minimum(far, 2 - 2 * unit @ unit[chosen[-1]])
        if far.max() < 1e-12:
            break
        chosen.append(int(far.argmax()))
    return unit[chosen]


class Pivots:
    """Pivots of every vector length; no two lengths share a cell number."""

    def __init__(self, of_size: dict[int, np.ndarray]):
        self.of_size, self.first, self.cells = of_size, {}, 0
        for size in sorted(of_size):
            self.first[size], self.cells = self.cells, self.cells + len(of_size[size])

    def size_of(self, cell: int) -> int:
        return max((size for size in self.of_size if self.first[size] <= cell), key=self.first.get)


def _chord(angle):
    return 2 * np.sin(np.minimum(angle, np.pi) / 2)


def _angles(cosines):
    return np.arccos(np.clip(cosines, -1, 1))


def _near_cells(pivots, far, wide, theta, units, radius, home) -> np.ndarray:
    """Which cells may hold something linked with which items of the cell `home`, row by row.

    By the triangle inequality a cell holds nothing within the reach of an item that is
    farther from its pivot than the cell's radius and the reach together, or farther than the
    reach from the plane half-way between its pivot and that of `home`.
    """
    square = np.maximum(2 - 2 * units @ pivots.T, 0)
    apart = np.sqrt(np.maximum(2 - 2 * pivots @ pivots[home], 0))
    reach = _chord(theta + radius[:, None] + wide) + 1e-7
    plane = square - square[:, home, None] <= 2 * reach * apart
    return plane & (np.sqrt(square) <= far + 1e-7 + reach)


def _balls(units: np.ndarray, radius: float, kind=np.float64) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """(members, centre, radius) of groups of at least MIN_BALL rows around a centre.

    Rows of a ball lie within `radius` of its centre, so any two are within twice that. A
    centre holds numbers of `kind`, and its radius is measured from it as it is held.
    """
    small, free, out = units.astype(np.float32), np.ones(len(units), bool), []
    near = small @ small.T >= np.cos(radius)
    counts = near.sum(axis=1)
    while counts.max(initial=0) >= MIN_BALL:
        members = np.flatnonzero(near[counts.argmax()] & free)
        free[members] = False
        counts -= near[:, members].sum(axis=1)
        counts[members] = 0
        centre = units[members].mean(axis=0)
        centre = (centre / np.linalg.norm(centre)).astype(kind)
        angle = _angles(units[members] @ _unit(centre[None])[0])
        members, angle = members[angle <= radius], angle[angle <= radius]
        if len(members) >= MIN_BALL:
            out.append((members, centre, float(angle.max()) + ANGLE_SLACK))
    return out


def near_vectors(
    vectors: DataFrame, min_cosine: float = 0.95, sample_rows: int = 4096, id_col="vec_id", vector_col="embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: an exact metric range join.

    Equal vectors are joined as one with a weight. Pivots, spread over a bounded sample of
    each vector length, part the vectors into cells; lengths share no cell. Where many vectors
    of a cell lie within half the linking angle of a centre, all of them are linked, and they
    go on as one item, a ball. The items of a cell are packed into blocks of bounded size, a
    row each, and two blocks meet if something in one may be linked with something in the
    other; of their rows only those are compared that may be. No row is copied for the cells
    its neighbours may lie in, so what is shuffled and what a task holds do not grow with them.
    By the triangle inequality most pairs with a ball are linked, or not, for all of its
    members; only for the rest are the members compared. Blocks return each row's number
    of links and one link of a spanning forest, never their pairs.

    Rows that are no usable vectors (see `marked`) link with nothing and are kept. Rows that
    repeat an id are rows like others, linked by their vectors alone; `kept` is true for all
    rows with a component's smallest id.
    """
    every = marked(vectors, id_col, vector_col)
    # Single precision stays as it is, half as large as the doubles it is compared in.
    kind = "array<float>" if every.schema["vector"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = every.where("usable").select("vec_id", F.col("vector").cast(kind).alias("vector"))
    rows = stored(rows, "vectors")
    groups = rows.groupBy("vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("weight"))
    # From here on `vec_id` numbers the distinct vectors; an id may have several.
    groups = stored(groups.select(F.monotonically_increasing_id().alias("vec_id"), "first", "weight", "vector"), "groups")
    counts = row_counts(groups)
    alone = every.where("not usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    if not counts:
        return alone
    spread = lambda sample, rows: spread_pivots(sample, int(min(1024, max(8, rows**0.5 / 8))))
    pivots = Pivots(learned(groups, counts, sample_rows, spread))
    theta = float(np.arccos(np.clip(min_cosine, -1, 1)))

    members = stored(_with_items(groups, pivots, theta), "members")
    items = members.where("vec_id = item").select(
        "vec_id", F.col("item_weight").alias("weight"), F.coalesce("centre", "vector").alias("vector"), "radius"
    )
    found = stored(_joined_blocks(items, pivots, theta, min_cosine), "found")

    # Pairs with a ball that its radius leaves open: their members meet, ball by ball.
    opened = stored(found.where("other is not null").select("vec_id", "other"), "open")
    both = opened.select(
        F.col("vec_id").alias("a"), F.col("other").alias("b"), F.explode(F.array("vec_id", "other")).alias("item")
    )
    own = members.select("item", "vec_id", "weight", "vector")
    sizes = members.groupBy("item").agg(F.ceil(F.count("*") / CELL_CHUNK).cast("int").alias("parts"))
    sides = both.join(own, "item").join(sizes, "item").join(sizes.toDF("b", "b_parts"), "b").join(sizes.toDF("a", "a_parts"), "a")
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    first = F.col("item") == F.col("a")
    others = F.explode(F.sequence(F.lit(0), F.when(first, F.col("b_parts")).otherwise(F.col("a_parts")) - 1))
    sides = sides.withColumns({"first": first, "part": part}).withColumn("facing", others)
    sides = sides.withColumns(
        {"p": F.when(first, F.col("part")).otherwise(F.col("facing")), "q": F.when(first, F.col("facing")).otherwise(F.col("part"))}
    )

    def compare(table):
        first, units = table["first"].to_numpy(), _unit(_matrix_of(table["vector"]))
        ids, weight = table["vec_id"].to_numpy(), table["weight"].to_numpy()
        left, right = ((ids[own], weight[own], np.zeros(own.sum()), units[own]) for own in (first, ~first))
        return _links(left, right, False, theta, min_cosine)

    closer = sides.select("a", "b", "p", "q", "first", "vec_id", "weight", "vector")
    closer = stored(closer.groupBy("a", "b", "p", "q").applyInArrow(compare, BLOCK_SCHEMA), "closer")

    joined = found.where("other is null").withColumn("item", F.col("vec_id"))
    per_item = stored(joined.groupBy("item").agg(F.sum("links").alias("item_links")), "item-links")
    per_row = stored(closer.groupBy("vec_id").agg(F.sum("links").alias("row_links")), "row-links")
    forest = (
        found.where("root is not null").select(F.col("vec_id").alias("a"), F.col("root").alias("b"))
        .unionByName(closer.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
        .unionByName(members.select(F.col("vec_id").alias("a"), F.col("item").alias("b")))
    )
    parts = stored(connected_components(forest), "parts")
    firsts = groups.select(F.col("vec_id").alias("node"), "first")
    least = stored(parts.join(firsts, "node").groupBy("root").agg(F.min("first").alias("component_id")), "least")
    parts = parts.join(least, "root").select(F.col("node").alias("vec_id"), "component_id")
    known = (
        members.join(per_item, "item", "left").join(per_row, "vec_id", "left").join(parts, "vec_id", "left").select(
            "vector",
            # Its equals, the rest of its ball, what the ball is linked with whole, and single rows.
            (F.col("item_weight") - 1 + F.coalesce("item_links", F.lit(0)) + F.coalesce("row_links", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "first").alias("component_id"),
        )
    )
    # Sorted by a hash first; only equal vectors are compared whole.
    hashed = lambda df: df.withColumn("hash", F.xxhash64("vector"))
    linked = hashed(rows).join(hashed(stored(known, "known")), ["hash", "vector"]).select("vec_id", "n_links", "component_id")
    linked = linked.withColumn("kept", F.col("vec_id") == F.col("component_id"))
    return linked.unionByName(alone)


def _with_items(groups: DataFrame, pivots: Pivots, theta: float) -> DataFrame:
    """Each distinct vector with the item it goes on as: its ball, or itself.

    Balls are looked for among the vectors of a cell, in parts of bounded size. `item`,
    `item_weight` and `radius` stand on all rows of an item, a ball's `centre` on the one
    whose id names it.
    """
    cells = _homes(groups, pivots)
    # One row per pivot, at most 1024 of a length.
    sizes = {r["cell"]: r["n"] for r in cells.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    table = [(cell, -(-n // CELL_CHUNK)) for cell, n in sizes.items()]
    parts = F.broadcast(groups.sparkSession.createDataFrame(table, "cell long, parts int"))
    cells = cells.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")))
    kind = groups.schema["vector"].dataType.simpleString()
    number = np.float32 if kind == "array<float>" else np.float64

    def collapse(table):
        units = _unit(_matrix_of(table["vector"]))
        ids, weight = table["vec_id"].to_numpy(), table["weight"].to_numpy()
        item, item_weight, radius = ids.copy(), weight.copy(), np.zeros(len(ids))
        centre: list = [None] * len(ids)
        for members, middle, wide in _balls(units, theta / 2 - 2 * ANGLE_SLACK, number):
            names = members[ids[members].argmin()]
            item[members], item_weight[members], radius[members] = ids[names], weight[members].sum(), wide
            centre[names] = middle
        out = table.select(["vec_id", "first", "weight", "vector"])
        added = {"item": item, "item_weight": item_weight, "radius": radius, "centre": pa.array(centre, pa.list_(pa.from_numpy_dtype(number)))}
        for name, values in added.items():
            out = out.append_column(name, pa.array(values))
        return out

    schema = f"vec_id long, first long, weight long, vector {kind}, item long, item_weight long, radius double, centre {kind}"
    return cells.groupBy("cell", "part").applyInArrow(collapse, schema)


def _matrix_of(column) -> np.ndarray:
    """The vectors, all of one length, of an Arrow column as doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _homes(df: DataFrame, pivots: Pivots) -> DataFrame:
    """Rows with the `cell` of their nearest pivot and the `distance` from it."""

    def run(batches):
        for batch in batches:
            sizes = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                cell, distance = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows)
                for at in range(0, part.num_rows, SLICE):
                    units = _unit(_matrix_of(part.column("vector").slice(at, SLICE)))
                    square = np.maximum(2 - 2 * units @ pivots.of_size[size].T, 0)
                    cell[at : at + SLICE] = pivots.first[size] + square.argmin(axis=1)
                    distance[at : at + SLICE] = np.sqrt(square.min(axis=1))
                columns = [*part.columns, pa.array(cell), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "cell", "distance"])

    out = T.StructType([*df.schema.fields, T.StructField("cell", T.LongType()), T.StructField("distance", T.DoubleType())])
    return in_small_batches(df).mapInArrow(run, out)


def _joined_blocks(items: DataFrame, pivots: Pivots, theta: float, min_cosine: float) -> DataFrame:
    """Links found between all blocks, and within each.

    A block is one row, so two that meet are one row for a task, and no more than two are held at
    a time. Which task compares two blocks is drawn by hash, so that tasks have like numbers.
    """
    homes = _homes(items, pivots)
    # One row per pivot, at most 1024 of a length.
    known = homes.groupBy("cell").agg(F.count("*").alias("n"), F.max("distance").alias("far"), F.max("radius").alias("wide"))
    known = {r["cell"]: r for r in known.collect()}
    far = np.array([known[c]["far"] if c in known else -10.0 for c in range(pivots.cells)])
    wide = np.array([known[c]["wide"] if c in known else 0.0 for c in range(pivots.cells)])
    parts = {}
    for size, own in pivots.of_size.items():
        most = max(1, min(2 * CELL_CHUNK, BLOCK_BYTES // (8 * size)))
        parts |= {c: -(-known[c]["n"] // most) for c in range(pivots.first[size], pivots.first[size] + len(own)) if c in known}
    table = F.broadcast(items.sparkSession.createDataFrame(list(parts.items()), "cell long, parts int"))
    number = np.dtype("<f4" if items.schema["vector"].dataType.simpleString() == "array<float>" else "<f8")

    def pack(key, group):
        cell = key[0].as_py()
        size = pivots.size_of(cell)
        cells = slice(pivots.first[size], pivots.first[size] + len(pivots.of_size[size]))
        vectors, radius = _matrix_of(group["vector"]), group["radius"].to_numpy()
        near = np.zeros(len(pivots.of_size[size]), bool)
        for at in range(0, len(vectors), SLICE):
            own = (_unit(vectors[at : at + SLICE]), radius[at : at + SLICE], cell - cells.start)
            near |= _near_cells(pivots.of_size[size], far[cells], wide[cells], theta, *own).any(axis=0)
        values = [group["vec_id"].to_numpy(), group["weight"].to_numpy(), radius, vectors.astype(number)]
        return pa.table({
            "block": [(cell << 32) + key[1].as_py()], "cell": [cell], "near": pa.array([np.flatnonzero(near) + cells.start]),
            **{name: pa.array([value.tobytes()], pa.binary()) for name, value in zip(("ids", "weights", "radii", "vectors"), values)},
        })

    packed = homes.join(table, "cell").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")))
    schema = "block long, cell long, near array<long>, ids binary, weights binary, radii binary, vectors binary"
    blocks = stored(packed.groupBy("cell", "part").applyInArrow(pack, schema), "blocks")

    count = sum(parts.values())
    tasks = max(-(-count // BLOCKS_PER_SIDE), min(count, 8))
    sides = [blocks.select(*(F.col(c).alias(f"{side}_{c}") for c in blocks.columns)).repartition(tasks) for side in "ab"]
    drawn = F.hash("a_block").bitwiseXOR(F.hash("b_block")).bitwiseAND(F.lit(1)) == 0
    once = (F.col("a_block") == F.col("b_block")) | ((F.col("a_block") < F.col("b_block")) == drawn)
    mutual = F.array_contains("a_near", F.col("b_cell")) & F.array_contains("b_near", F.col("a_cell"))
    met = sides[0].join(sides[1], once & ((F.col("a_cell") == F.col("b_cell")) | mutual))

    def unpacked(row, letter, size):
        ids, weight, radius, vectors = (
            np.frombuffer(row[f"{letter}_{name}"].as_buffer(), kind)
            for name, kind in (("ids", "<i8"), ("weights", "<i8"), ("radii", "<f8"), ("vectors", number))
        )
        return ids, weight, radius, _unit(vectors.reshape(len(ids), size))

    def facing(block, cell, other, size):
        """The rows of a block that may be linked with something in another cell."""
        two = np.array([cell, other])
        chosen = pivots.of_size[size][two - pivots.first[size]]
        keep = _near_cells(chosen, far[two], wide[two], theta, block[3], block[2], 0)[:, 1]
        return tuple(column[keep] for column in block)

    def run(batches):
        last, left = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                names, cells = ([row[f"{letter}_{name}"].as_py() for letter in "ab"] for name in ("block", "cell"))
                size = pivots.size_of(cells[0])
                # A block meets several in a row.
                last, left = names[0], left if last == names[0] else unpacked(row, "a", size)
                right = left if names[0] == names[1] else unpacked(row, "b", size)
                both = (left, right) if cells[0] == cells[1] else (facing(left, *cells, size), facing(right, *cells[::-1], size))
                yield from _links(*both, names[0] == names[1], theta, min_cosine).to_batches()

    columns = [f"{letter}_{name}" for letter in "ab" for name in ("block", "cell", "ids", "weights", "radii", "vectors")]
    return in_small_batches(met.select(*columns)).mapInArrow(run, BLOCK_SCHEMA)


BLOCK_SCHEMA = "vec_id long, links long, root long, other long"


def _links(left: tuple, right: tuple, same: bool, theta: float, min_cosine: float) -> pa.Table:
    """Links of one side's rows with those of the other, or among them if both are the same.

    A side is (ids, weights, radii, unit vectors). Rows with `links` and `root` tell a row's
    number of links and a link of a spanning forest; rows with `other` name pairs of items
    that only their members can decide.
    """
    (a_ids, a_weight, a_radius, a), (b_ids, b_weight, b_radius, b) = left, right
    shift = 0 if same else len(a_ids)
    ids = a_ids if same else np.concatenate([a_ids, b_ids])
    links, root, opened = np.zeros(len(ids), np.int64), np.arange(len(ids)), []
    # Single precision decides only where it cannot err.
    slack = max(1e-5, a.shape[1] * 2e-7)
    a_lead, b_lead = _leading(a), _leading(b)
    a_small, b_small, whole = a.astype(np.float32), b.astype(np.float32), a_lead is None
    # New memory for every product would take as long as the product.
    room = np.empty(2 * SLICE * SLICE, np.float32)
    for at, to in ((at, to) for to in range(0, len(b), 2 * SLICE) for at in range(0, len(a), SLICE)):
        if same and at >= to + 2 * SLICE:
            continue
        rows, others, close = slice(at, at + SLICE), slice(to, to + 2 * SLICE), None
        least = np.cos(np.minimum(theta + a_radius[rows, None] + b_radius[others].max(), np.pi)) - slack
        if not whole:
            most = _product(a_lead[rows], b_lead[others], room)
            if most.max() < least.min():
                continue
            maybe = most >= least
            # Where the leading components tell little, all of them are multiplied from here on.
            whole = np.count_nonzero(maybe) > maybe.size // 64
        if whole:
            close = _product(a_small[rows], b_small[others], room)
            if close.max() < least.min():
                continue
            maybe = close >= least
        for i, j in _some_pairs(maybe, a.shape[1]):
            cosine, i, j = np.full(len(i), min_cosine) if close is None else close[i, j], at + i, to + j
            if same:
                cosine, i, j = cosine[i < j], i[i < j], j[i < j]
            spread = a_radius[i] + b_radius[j]
            linked, unsure = cosine >= min_cosine, np.zeros(len(i), bool)
            some = np.flatnonzero((spread > 0) | (np.abs(cosine - min_cosine) <= slack))
            exact = np.einsum("nd,nd->n", a[i[some]], b[j[some]])
            angle, wide = _angles(exact), spread[some]
            linked[some] = np.where(wide > 0, angle <= theta - wide - ANGLE_SLACK, exact >= min_cosine)
            unsure[some] = (wide > 0) & ~linked[some] & (angle <= theta + wide + ANGLE_SLACK)
            opened.append(np.stack([a_ids[i[unsure]], b_ids[j[unsure]]], axis=1))
            i, j = i[linked], j[linked]
            if len(i):
                np.add.at(links, i, b_weight[j])
                np.add.at(links, shift + j, a_weight[i])
                root = _joined(root, i, shift + j)
    some, unsure = np.flatnonzero(links), np.concatenate([np.zeros((0, 2), np.int64), *opened])
    sure = [pa.array(x) for x in (ids[some], links[some], ids[root[some]])] + [pa.nulls(len(some), pa.int64())]
    open_pairs = [pa.array(unsure[:, 0]), *[pa.nulls(len(unsure), pa.int64())] * 2, pa.array(unsure[:, 1])]
    names = ["vec_id", "links", "root", "other"]
    return pa.concat_tables([pa.table(sure, names=names), pa.table(open_pairs, names=names)])


def _product(a: np.ndarray, b: np.ndarray, room: np.ndarray) -> np.ndarray:
    return np.matmul(a, b.T, out=room[: len(a) * len(b)].reshape(len(a), len(b)))


def _leading(units: np.ndarray) -> np.ndarray | None:
    """The first components of unit vectors, and the length of the rest in one more.

    No product of these is less than that of the whole vectors. Short vectors have none.
    """
    lead = 3 * units.shape[1] // 8
    if lead < 8:
        return None
    rest = np.linalg.norm(units[:, lead:], axis=1, keepdims=True)
    return np.concatenate([units[:, :lead], rest], axis=1).astype(np.float32)


def _some_pairs(mask: np.ndarray, size: int):
    """Row and column of all that is set, for as many at once as can be multiplied one by one."""
    rows = np.flatnonzero(mask.any(axis=1))
    i, j = np.nonzero(mask[rows])
    i, most = rows[i], max(1, (1 << 22) // size)
    for at in range(0, len(i), most):
        yield i[at : at + most], j[at : at + most]


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after more links: the roots themselves are joined."""
    ends = np.unique(root[a] * len(root) + root[b])
    return local_roots(len(root), ends // len(root), ends % len(root))[root]


# -- nearest neighbours -----------------------------------------------------------------

CODE_BITS = 128
SUBSTRING_BITS = 8
ROWS_PER_BLOCK = 4096
QUERIES_PER_CHUNK = 4096
_NEAR = [
    [np.flatnonzero(np.bitwise_count(np.arange(256, dtype=np.uint8) ^ np.uint8(u)) <= r) for u in range(256)]
    for r in range(SUBSTRING_BITS + 1)
]


class RotatedCodes:
    """Binary codes: the signs of a vector under learned rotations.

    Each rotation starts at random and is turned step by step so that the sample's
    vectors come to lie close to the corners of the cube (iterative quantization).
    """

    def __init__(self, mean: np.ndarray, turn: np.ndarray):
        self.mean, self.turn = mean, turn

    @classmethod
    def fit(cls, sample: np.ndarray, steps: int = 20) -> RotatedCodes:
        rng = np.random.default_rng(11)
        mean = sample.mean(axis=0)
        centred, size = sample - mean, sample.shape[1]
        turns = []
        for _ in range(-(-CODE_BITS // size)):
            turn = np.linalg.qr(rng.normal(size=(size, size)))[0]
            for _ in range(steps):
                u, _, v = np.linalg.svd(np.sign(centred @ turn).T @ centred)
                turn = (u @ v).T
            turns.append(turn)
        return cls(mean, np.hstack(turns)[:, :CODE_BITS])

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """One row of bytes per vector, a byte per substring."""
        return np.packbits((vectors - self.mean) @ self.turn > 0, axis=1)


def hamming_radius(sample: np.ndarray, codes: RotatedCodes, k: int, recall: float) -> int:
    """The code distance within which `recall` of the sample's own k nearest lie."""
    queries = np.arange(0, len(sample), max(1, len(sample) // 400))
    near = sample[queries] @ sample.T
    near[np.arange(len(queries)), queries] = -np.inf
    k = min(k, len(sample) - 1)
    if k < 1:
        return CODE_BITS
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    code = codes.codes(sample)
    distance = np.bitwise_count(code[queries][:, None, :] ^ code[top]).sum(axis=2)
    return int(np.quantile(distance, recall, method="higher"))


def _within(rows: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """Which row codes lie within the radius of which query codes, by multi-index hashing.

    Of m substrings at least one differs in at most radius // m bits, and it is among the
    first radius % m + 1 or else one differs in a bit less. So each substring's index is
    probed at all values so near, and what is found there is compared whole.
    """
    hit = np.zeros((len(queries), len(rows)), bool)
    each, rest = divmod(radius, rows.shape[1])
    for s in range(rows.shape[1]):
        near = min(each if s <= rest else each - 1, SUBSTRING_BITS)
        if near < 0:
            break
        order = np.argsort(rows[:, s], kind="stable")
        starts = np.searchsorted(rows[order, s], np.arange(257))
        asked = np.argsort(queries[:, s], kind="stable")
        asks = np.searchsorted(queries[asked, s], np.arange(257))
        for value in range(256):
            who = asked[asks[value] : asks[value + 1]]
            if len(who):
                found = np.concatenate([order[starts[v] : starts[v + 1]] for v in _NEAR[near][value]])
                far = np.bitwise_count(queries[who].view(np.uint64)[:, None, :] ^ rows[found].view(np.uint64)).sum(axis=2)
                hit[np.ix_(who, found)] |= far <= radius
    return hit


def _nearest(rows: pd.DataFrame, queries: pd.DataFrame, codes: RotatedCodes, radius: int, k: int) -> pd.DataFrame:
    """The k nearest of one block's retrieved rows for each query of a chunk.

    Only retrieved rows are multiplied with a query. A query's own row is no candidate.
    """
    ids, row = rows["vec_id"].to_numpy(), rows["row"].to_numpy()
    vectors, asked, asks = _matrix(rows["vector"]), _matrix(queries["vector"]), queries["row"].to_numpy()
    hit = _within(codes.codes(vectors), codes.codes(asked), radius)
    norms, lengths = np.linalg.norm(vectors, axis=1), np.linalg.norm(asked, axis=1)
    out = [pd.DataFrame({c: pd.Series(dtype=t) for c, t in _FOUND.items()})]
    for at, query in enumerate(asks):
        found = np.flatnonzero(hit[at] & (row != query))
        if len(found) > k:
            score = vectors[found] @ asked[at]
            # A matrix product may round equal vectors differently.
            slack = 1e-12 * lengths[at] * norms[found].max()
            found = found[score >= np.partition(score, len(found) - k)[len(found) - k] - slack]
        exact = (asked[at] * vectors[found]).sum(axis=1)
        top = np.lexsort((ids[found], -exact))[:k]
        found = found[top]
        out.append(pd.DataFrame({"query": query, "row": row[found], "vec_id": ids[found], "score": exact[top]}))
    return pd.concat(out)


_FOUND = {"query": "int64", "row": "int64", "vec_id": "int64", "score": "float64"}


def nearest_neighbours(
    vectors: DataFrame,
    is_query,
    k: int = 20,
    sample_rows: int = 8192,
    recall: float = 0.97,
    id_col="vec_id",
    vector_col="embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product found.

    `is_query` is a condition on `vec_id`. Codes are learned from a bounded sample of each
    vector length, every row is coded and indexed; rows and queries of one length meet in
    blocks of bounded size. The code radius is that within which `recall` of the sample's
    own k nearest lie, which holds at least as well among more rows. Queries that find
    fewer than k rows search again without a radius. Scores are inner products in double
    precision; ties go to the smaller vec_id. Rows that are no usable vectors (see
    `marked`) take no part. Rows that repeat an id with another vector are rows like others:
    each is a candidate for all but itself, and each of them that is a query has an answer.
    Rows equal in both count once.
    """
    rows = usable(vectors, id_col, vector_col).distinct()
    rows = stored(rows.withColumns({"row": F.monotonically_increasing_id(), "size": F.size("vector")}), "vectors")
    counts = row_counts(rows)
    schema = "query long, row long, vec_id long, score double"

    def learn(sample, count):
        codes = RotatedCodes.fit(sample)
        return codes.mean, codes.turn, hamming_radius(sample, codes, k, recall)

    models = learned(rows, counts, sample_rows, learn) if counts else {}

    def search(queries: DataFrame, whole: bool) -> DataFrame:
        asked = row_counts(queries)
        # One row per vector length.
        table = [(size, -(-counts[size] // ROWS_PER_BLOCK), -(-n // QUERIES_PER_CHUNK)) for size, n in asked.items()]
        table = F.broadcast(rows.sparkSession.createDataFrame(table, "size int, blocks int, chunks int"))
        own = lambda parts: F.pmod(F.xxhash64("row"), F.col(parts)).cast("int")
        every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
        left = rows.join(table, "size").withColumns({"block": own("blocks"), "chunk": every("chunks")})
        # Columns of their own, because both sides come from one table.
        asks = queries.select(*(F.col(c).alias(c) for c in queries.columns))
        right = asks.join(table.select(*(F.col(c).alias(c) for c in table.columns)), "size")
        right = right.withColumns({"chunk": own("chunks"), "block": every("blocks")})

        def meet(key, left, right):
            mean, turn, radius = models[key[0]]
            return _nearest(left, right, RotatedCodes(mean, turn), CODE_BITS if whole else radius, k)

        keys = ("size", "block", "chunk")
        met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, schema)
        best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row"))
        return met.withColumn("rank", best).where(F.col("rank") <= k).select("query", "rank", "vec_id", "score")

    queries = rows.where(is_query)
    if queries.isEmpty():
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = stored(search(queries, False), "found")
    # One number per vector length.
    wanted = F.broadcast(rows.sparkSession.createDataFrame([(s, min(k, n - 1)) for s, n in counts.items()], "size int, wanted int"))
    wanted = queries.join(wanted, "size").select("row", "wanted")
    last = found.groupBy("query").agg(F.max("rank").alias("got")).withColumnRenamed("query", "row")
    lacking = wanted.join(last, "row", "left").where(F.coalesce("got", F.lit(0)) < F.col("wanted"))
    short = stored(queries.join(lacking.select("row"), "row", "left_semi").select(*rows.columns), "short")
    if not short.isEmpty():
        again = search(short, True)
        found = found.join(short.select(F.col("row").alias("query")), "query", "left_anti").unionByName(again)
    asks = queries.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return found.join(asks, "query").select("query_id", "rank", "vec_id", "score")
