"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine c are sqrt(2 - 2c) apart. They are rotated at random
and split into blocks of a few dimensions, each with a share of the squared
distance in proportion to its dimensions: of two vectors close enough, some
block is within its share. Each block is range-joined on a grid over its first
dimensions, a vector also visiting the neighbouring cells within reach, and a
pair found is counted in the first block that has it within its share, after
its cosine has been computed from the vectors themselves.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlive.llm.common import saved
from matchlive.llm.components import components, forest
from matchlive.llm.tiles import tiled

COSINE = 0.95
#: Larger blocks and fewer grid dimensions mean that a vector visits fewer cells; what they prune less, the order
#: along one more coordinate prunes within a cell.
BLOCK_DIMENSIONS = 32
GRID_DIMENSIONS = 1
SEED = 7
#: The own cell, and those whose rows a cell's rows visit.
NEIGHBOURS = ((0, 0), (0, 1), (1, -1), (1, 1), (1, 0))
#: Vectors of one grid cell compared in one task; vectors and pairs compared in one step there.
TILE_ROWS = 16_384
STEP_ROWS, STEP_PAIRS = 512, 1 << 20
VERIFIED_AT_ONCE = 1 << 14
#: Room for rounding when candidates are looked for; the cosine itself has none.
SLACK = 1e-5


def usable(vector: str) -> Column:
    """Neither null nor zero, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(size: int, seed: int = SEED) -> np.ndarray:
    """A random rotation, the same for every call with one size."""
    return np.linalg.qr(np.random.default_rng([seed, size]).normal(size=(size, size)))[0]


def blocks(size: int) -> list[slice]:
    return [slice(low, min(low + BLOCK_DIMENSIONS, size)) for low in range(0, size, BLOCK_DIMENSIONS)]


def budgets(size: int, cosine: float) -> np.ndarray:
    """Squared distance of each block, in proportion to its dimensions."""
    share = np.array([part.stop - part.start for part in blocks(size)]) / size
    return (2 - 2 * cosine) * share


def matrix(vectors: pa.ListArray) -> np.ndarray:
    """Vectors of one length as doubles, scaled so that squares neither overflow nor vanish."""
    raw = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(vectors), -1)
    return raw / np.abs(raw).max(axis=1, keepdims=True)


def rotated(raw: np.ndarray) -> np.ndarray:
    return raw / np.linalg.norm(raw, axis=1, keepdims=True) @ rotation(raw.shape[1])


def cells(cosine: float, whole: bool):
    """Rows (block, cell_x, cell_y, visitor) of every vector: its own cell and the later ones in reach.

    Of two neighbouring cells the one that sorts first visits the other, so a
    pair meets in one cell of a block. ``whole`` adds the vector and its class.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("size").to_numpy()
            for size in np.unique(length):
                at = np.flatnonzero(length == size)
                part = batch.take(pa.array(at))
                points = rotated(matrix(part.column("vector")))
                for number, (block, budget) in enumerate(zip(blocks(size), budgets(size, cosine), strict=True)):
                    yield from visits(part, points[:, block], number, np.sqrt(budget) + SLACK)

    def visits(part: pa.RecordBatch, points: np.ndarray, block: int, reach: float) -> Iterator[pa.RecordBatch]:
        grid = np.zeros((len(points), 2))
        grid[:, : min(points.shape[1], GRID_DIMENSIONS)] = points[:, :GRID_DIMENSIONS]
        own = np.floor(grid / reach)
        inside = grid - own * reach
        for dx, dy in NEIGHBOURS[:1] + NEIGHBOURS[-(GRID_DIMENSIONS**2) :]:
            gap_x = reach - inside[:, 0] if dx else 0.0
            gap_y = {1: reach - inside[:, 1], -1: inside[:, 1], 0: 0.0}[dy]
            at = np.flatnonzero(np.full(len(points), gap_x**2 + gap_y**2) <= (reach + SLACK) ** 2)
            carried = ["size", "node", "copies", "vector"] if whole else ["size"]
            rows = part.select(carried).take(pa.array(at))
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(np.full(len(at), block, np.int32)),
                    "cell_x": pa.array((own[at, 0] + dx).astype(np.int32)),
                    "cell_y": pa.array((own[at, 1] + dy).astype(np.int32)),
                    "visitor": pa.array(np.full(len(at), bool(dx or dy))),
                }
                | {name: rows.column(name) for name in carried}
            )

    return place


def compare(cosine: float):
    """Links within a tile: how many vectors each vector is linked to there, and links that connect them."""

    def pairs_of(points: np.ndarray, home: np.ndarray, visiting: np.ndarray, block: slice, budget: float):
        """Candidates of one block, a home row with any later home row or a visitor, some rows at a time.

        Rows are in order of one more coordinate, so that only a stretch of them
        is compared. One product gives minus half of the squared distances.
        """
        low = points[:, block]
        along = low[:, min(GRID_DIMENSIONS, low.shape[1] - 1)]
        home, visiting = home[np.argsort(along[home])], visiting[np.argsort(along[visiting])]
        half, ones = -(low**2).sum(1, keepdims=True) / 2, np.ones((len(low), 1))
        left = np.hstack([low, half, ones]).astype(np.float32)
        right = np.hstack([low, ones, half]).astype(np.float32)
        reach, least = np.sqrt(budget) + SLACK, -(budget + SLACK) / 2
        for begin in range(0, len(home), STEP_ROWS):
            mine = home[begin : begin + STEP_ROWS]
            first, last = along[mine[0]] - reach, along[mine[-1]] + reach
            later = home[begin : np.searchsorted(along[home], last, "right")]
            near = visiting[np.searchsorted(along[visiting], first) : np.searchsorted(along[visiting], last, "right")]
            for others, same in ((later, True), (near, False)):
                for at in range(0, len(others), STEP_PAIRS // STEP_ROWS):
                    part = others[at : at + STEP_PAIRS // STEP_ROWS]
                    close = left[mine] @ right[part].T >= least
                    one, other = np.divmod(np.flatnonzero(close), len(part))
                    if same:
                        one, other = one[at + other > one], other[at + other > one]
                    yield mine[one], part[other]

    def links(table: pa.Table) -> pa.Table:
        raw = matrix(table.column("vector").combine_chunks())
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        visitor = table.column("visitor").to_numpy()
        side, block = table.column("side").to_numpy(), table.column("block")[0].as_py()
        crossing = table.column("tile_i")[0] != table.column("tile_j")[0]
        unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
        points, parts, most = rotated(raw), blocks(raw.shape[1]), budgets(raw.shape[1], cosine)
        found, total = np.arange(len(raw)), np.zeros(len(raw), np.int64)
        home, visiting = np.flatnonzero(~visitor), np.flatnonzero(visitor)
        for one, other in pairs_of(points, home, visiting, parts[block], most[block]):
            if crossing:
                two = side[one] != side[other]
                one, other = one[two], other[two]
            for at in range(0, len(one), VERIFIED_AT_ONCE):
                a, b = one[at : at + VERIFIED_AT_ONCE], other[at : at + VERIFIED_AT_ONCE]
                apart = (points[a] - points[b]) ** 2
                near = np.stack([apart[:, part].sum(1) for part in parts], 1) <= most + SLACK / 2
                mine = near.any(1) & (near.argmax(1) == block)
                a, b = a[mine], b[mine]
                real = (unit[a] * unit[b]).sum(1) >= cosine
                a, b = a[real], b[real]
                total += np.bincount(a, copies[b], len(raw)).astype(np.int64)
                total += np.bincount(b, copies[a], len(raw)).astype(np.int64)
                found = forest(len(raw), a, b, found)
        moved, some = np.flatnonzero(found != np.arange(len(raw))), np.flatnonzero(total)
        return pa.table(
            {
                "a": np.concatenate([node[some], node[moved]]),
                "b": np.concatenate([node[some], node[found[moved]]]),
                "links": np.concatenate([total[some], np.zeros(len(moved), np.int64)]),
            }
        )

    return links


def near_duplicates(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept): links are pairs of rows with cosine of at least ``cosine``.

    The cosine is computed in double precision. Vectors that are null, empty,
    zero or hold null or non-finite components link with nothing, nor do vectors
    of different length. Equal vectors are compared once and count as linked
    with each other. Rows are what is linked: rows repeated with one id link to
    each other if their vectors are near, and only then. component_id is the
    smallest id reachable, the row's own included; a row without an id links like
    others, and has a null component_id if it reaches no id. Extra columns are
    left out.
    """
    rows = vectors.select(F.col(id_).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    # adding 0.0 turns -0.0 into 0.0, so that equal vectors have one key
    clean = rows.withColumn("vector", F.when(usable("vector"), F.transform("vector", lambda x: x + F.lit(0).cast("float"))))
    keys = [F.xxhash64(F.lit(word), "vector").alias(word) for word in ("k1", "k2")]
    marked = saved(clean.select("vec_id", F.col("vector").isNotNull().alias("valid"), *keys), "vector-keys")
    # a class is a node of its own, numbered as it is written: ids can be null or on several vectors
    classes = saved(
        clean.where("vector IS NOT NULL").select("vec_id", "vector", *keys).groupBy("k1", "k2")
        .agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vector-classes",
    )
    compared = classes.select(F.size("vector").alias("size"), "node", "copies", "vector")
    kind = classes.schema["vector"].dataType.simpleString()
    place = "block int, cell_x int, cell_y int, visitor boolean, size int"
    spread = compared.mapInArrow(cells(cosine, True), f"{place}, node long, copies long, vector {kind}")
    bare = compared.select("size", "vector").mapInArrow(cells(cosine, False), place)
    cell = ["size", "block", "cell_x", "cell_y"]
    counts = bare.groupBy(*cell).agg(F.count("*").alias("count"), F.count_if(~F.col("visitor")).alias("home"))
    counts = saved(counts.where("home > 0 AND count > 1").drop("home"), "vector-cells")
    tiles = tiled(spread, cell, "node", TILE_ROWS, counts)
    found = saved(
        tiles.groupBy(*cell, "tile_i", "tile_j").applyInArrow(compare(cosine), "a long, b long, links long"),
        "vector-links",
    )
    linked = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    named = saved(components(found.select("a", "b")), "vector-components")
    members = classes.drop("vector").join(linked, "node", "left").join(named, "node", "left")
    members = saved(members.withColumn("component", F.coalesce("component", "node")), "vector-members")
    smallest = members.groupBy("component").agg(F.min("first").alias("smallest"))
    known = members.join(smallest, "component").select("k1", "k2", "copies", "links", "smallest")
    out = marked.join(known, ["k1", "k2"], "left")
    count = F.when(F.col("valid"), F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(0).cast("long")
    component = F.when(F.col("valid"), F.col("smallest")).otherwise(F.col("vec_id"))
    out = out.select("vec_id", count.alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
