import hashlib
import math
import random

import numpy as np
import pytest

from matchlive.llm import clustering

SCHEMA = "vec_id long, embedding array<float>, cluster string, point int"


def plain(rows, count=8, rounds=10, seed=3, dimensions=64):
    points = []
    for vec_id, vector, *_ in rows:
        if vector is None or len(vector) != dimensions or any(x is None or not math.isfinite(x) for x in vector):
            continue
        points.append((vec_id, [math.floor(1024 * float(np.float32(x))) for x in vector]))
    digest = lambda row: (row[0] is None, hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest() if row[0] is not None else "", row[1])
    centres = [point for _, point in sorted(points, key=digest)[:count]]

    def nearest(point):
        return min((sum((a - b) ** 2 for a, b in zip(point, centre, strict=True)), number) for number, centre in enumerate(centres))

    for _ in range(rounds):
        owned = {}
        for _, point in points:
            owned.setdefault(nearest(point)[1], []).append(point)
        for number, group in owned.items():
            centres[number] = [sum(column) // len(group) for column in zip(*group, strict=True)]
    best = [(vec_id, *nearest(point)) for vec_id, point in points]
    total, each = sum(row[1] for row in best), {}
    for _, distance, number in best:
        each[number] = each.get(number, 0) + distance
    long = lambda x: x if x < 1 << 63 else None
    return sorted(
        ((vec_id, number, long(distance), long(each[number]), long(total), centres[number]) for vec_id, distance, number in best), key=repr
    )


def found(spark, rows, schema=SCHEMA, **settings):
    frame = spark.createDataFrame(rows, schema).repartition(3)
    out = clustering.clustered(frame, **settings)
    assert out.columns[-1] == "centroid_sha256"
    for row in out.collect():
        assert row["centroid_sha256"] == hashlib.sha256(",".join(map(str, row["centroid"])).encode()).hexdigest()
    return sorted((tuple(row)[:-1] for row in out.collect()), key=repr)


def odd_vectors(size=64):
    rng = random.Random(6)
    rows = [(place, [rng.uniform(-1, 1) for _ in range(size)]) for place in range(60)]
    rows += [(60, None), (61, []), (62, [0.5] * (size - 1)), (63, [float("nan")] + [0.0] * (size - 1)), (64, [None] + [0.0] * (size - 1))]
    rows += [(65, [float("inf")] * size), (66, [0.0] * size), (67, [-0.0] * size), (5, rows[5][1]), (5, rows[7][1])]
    rows += [(None, rows[9][1]), (None, rows[10][1]), (70, [-1e-9] * size)]
    return [(*row, "x", 1) for row in rows]


@pytest.mark.parametrize("settings", [{}, {"count": 3, "rounds": 2, "seed": 1}, {"rounds": 0}, {"count": 200}])
def test_equals_plain_rounds(spark, settings):
    rows = odd_vectors()
    assert found(spark, rows, **settings) == plain(rows, **settings)


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    rows = [(place, [float(place % 2)] * 2, "x", 1) for place in range(12)]  # equal centroids, some without points
    assert found(spark, rows, dimensions=2) == plain(rows, dimensions=2)
    even = [(place, [x, 0.0], "x", 1) for place, x in enumerate([0.0, 2.0, 1.0, 1.0, 4.0, 3.0])]  # points on the bisector
    for seed in range(6):
        assert found(spark, even, dimensions=2, count=2, rounds=1, seed=seed) == plain(even, 2, 1, seed, 2)


def test_large_components_stay_exact(spark):
    rows = [(place, [1e9 + 64.0 * place, 3e12 if place == 4 else 1.0], "x", 1) for place in range(9)]
    assert found(spark, rows, dimensions=2, count=3) == plain(rows, 3, dimensions=2)
    beyond = [(1, [1e30, 0.0], "x", 1), (2, [1.0, 2.0], "x", 1)]
    assert [row[0] for row in found(spark, beyond, dimensions=2)] == [2]


def test_no_vectors(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, "x", 1)]) == []


def test_tests_of_a_sign_find_the_nearest():
    rng = np.random.default_rng(2)
    for kind in (4, 1 << 20, 1 << 40):
        centres, points = rng.integers(-kind, kind, (7, 5)).tolist(), rng.integers(-kind, kind, (200, 5))
        points[:7] = centres
        points[7:14] = (np.array(centres) + np.array(centres[::-1])) // 2
        apart = [[sum((int(a) - b) ** 2 for a, b in zip(p, c, strict=True)) for c in centres] for p in points]
        field = clustering.Bisectors(centres)
        winner = field.nearest(points)
        assert winner.tolist() == [row.index(min(row)) for row in apart]
        assert [int(x) for x in field.distances(points, winner)] == [min(row) for row in apart]
