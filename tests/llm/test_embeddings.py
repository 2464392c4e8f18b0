import numpy as np
from brute import roots
from pyspark.sql import functions as F

from matchlive.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, size string, block string, first string"


def near(rng, base, cosine):
    other = rng.normal(size=len(base))
    other -= other @ base / (base @ base) * base
    return cosine * base / np.linalg.norm(base) + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


def vectors(size):
    """Groups around the limit, exact copies, scaled copies, a chain, opposite vectors, odd ones."""
    rng = np.random.default_rng(size)
    rows = list(rng.normal(size=(150, size)))
    for base in rows[:12]:
        rows += [near(rng, base, c) for c in (0.90, 0.949, 0.9499, 0.9501, 0.951, 0.99, 0.9999)]
        rows += [base, base * 3, -base, base * 1e-18]
    rows += [near(rng, rows[0], 0.999) for _ in range(40)]
    rows = [np.asarray(row, np.float32).tolist() for row in rows]
    rows += [None, [], [0.0] * size, [float("nan")] * size, [1.0] * (size - 1) + [float("inf")], [None] + [1.0] * (size - 1)]
    return rows


def brute(ids, rows):
    unit = []
    for row in rows:
        good = row and all(x is not None and np.isfinite(x) for x in row) and any(row)
        x = np.array(row, np.float64) if good else None
        unit.append(x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if good else None)
    pairs = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and (unit[i] * unit[j]).sum() >= 0.95
    ]
    links = np.bincount(np.array(pairs, int).ravel(), minlength=len(rows))
    root = roots(len(rows), pairs)
    reached = {r: [i for i, own in zip(ids, root, strict=True) if own == r and i is not None] for r in set(root)}
    lowest = {r: min(found, default=None) for r, found in reached.items()}
    out = ((i, int(n), lowest[r], i is not None and i == lowest[r]) for i, n, r in zip(ids, links, root, strict=True))
    return sorted(out, key=repr)


def found(spark, ids, rows):
    frame = spark.createDataFrame([(i, row, 0, "x", "y", "z") for i, row in zip(ids, rows, strict=True)], SCHEMA)
    return sorted(map(tuple, embeddings.near_duplicates(frame.repartition(3)).collect()), key=repr)


def test_links_and_components(spark, monkeypatch):
    rows = vectors(64) + vectors(20)
    ids = [int(i) for i in np.random.default_rng(1).permutation(len(rows))]
    want = brute(ids, rows)
    assert sum(row[1] for row in want) > 1500
    assert found(spark, ids, rows) == want
    monkeypatch.setattr(embeddings, "TILE_ROWS", 20)  # cells in many tiles
    assert found(spark, ids, rows) == want
    monkeypatch.setattr(embeddings, "GRID_DIMENSIONS", 2)
    monkeypatch.setattr(embeddings, "BLOCK_DIMENSIONS", 16)
    assert found(spark, ids, rows) == want


def test_missing_and_shared_ids(spark):
    """A row is what is linked: a null id bridges two others, one id on two vectors joins nothing by itself."""
    rng = np.random.default_rng(9)
    apart = list(rng.normal(size=(6, 30)))
    middle = near(rng, apart[0], 0.97)
    bridged = near(rng, middle, 0.97)  # too far from apart[0] to link with it
    rows = [apart[0], middle, bridged, apart[1], near(rng, apart[1], 0.99), apart[2], near(rng, apart[2], 0.99), apart[3], apart[4], apart[4]]
    ids = [3, None, 8, 1, 5, 9, 5, None, None, None]
    rows = [np.asarray(row, np.float32).tolist() for row in rows] + [None, rows[7].tolist()]
    ids += [None, 20]
    want = brute(ids, rows)
    assert (None, 2, 3, False) in want and (8, 1, 3, False) in want  # the bridge
    assert (5, 1, 1, False) in want and (5, 1, 5, True) in want and (9, 1, 5, False) in want
    assert (None, 1, None, False) in want
    assert found(spark, ids, rows) == want


def test_repeated_rows_and_doubles(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [-0.0, 1.0]), (3, [0.0, 5e300]), (4, None), (4, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(row)[:3] for row in embeddings.near_duplicates(frame).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 2), (3, 1, 2), (4, 0, 4), (4, 0, 4)]


def test_no_vectors(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = spark.createDataFrame([(7, None, 0, "x", "y", "z")], SCHEMA)
    assert [tuple(row) for row in embeddings.near_duplicates(alone).collect()] == [(7, 0, 7, True)]


def test_a_third_of_the_rows_alike(spark):
    """Copies count as linked with each other without pairs being made of them."""
    frame = spark.range(3000).select(
        F.col("id").alias("vec_id"),
        F.when(F.col("id") % 3 == 0, F.array(*[F.lit(1.0)] * 8)).otherwise(
            F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.sin(F.col("id") * i * i))
        ).alias("embedding"),
    )
    found = {row["vec_id"]: row for row in embeddings.near_duplicates(frame).collect()}
    assert {found[i]["component_id"] for i in range(0, 3000, 3)} == {0}
    assert all(found[i]["n_links"] >= 999 for i in range(0, 3000, 3))
