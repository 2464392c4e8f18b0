import random

import numpy as np
import xxhash
from brute import odd_documents, roots, words

from matchlive.llm import simhash
from matchlive.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text, size=3):
    listed = words((text or "").translate(LOWER))
    runs = [" ".join(listed[i : i + size]) for i in range(max(1, len(listed) - size + 1))] if listed else []
    hashes = [xxhash.xxh64_intdigest(run.encode(), 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute(ids, values, distance):
    values = np.array(values, np.uint64)
    near = np.argwhere(np.triu(np.bitwise_count(values[:, None] ^ values[None, :]) <= distance, 1))
    root = roots(len(ids), near.tolist())
    lowest = {r: min(i for i, own in zip(ids, root, strict=True) if own == r) for r in set(root)}
    return sorted((i, int(v), lowest[r]) for i, v, r in zip(ids, values, root, strict=True))


def test_odd_documents(odd):
    rows = odd_documents()
    got = sorted((r["doc_id"], r["fingerprint"] & (1 << 64) - 1, r["component_id"]) for r in simhash.near_duplicates(odd).collect())
    assert got == brute([row[0] for row in rows], [fingerprint(row[1]) for row in rows], 2)


def test_survivors(odd):
    groups = {r["component_id"] for r in simhash.near_duplicates(odd).collect()}
    kept = simhash.survivors(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(groups)
    texts = {row[0]: row[1] for row in odd_documents()}
    assert all(r["text"] == texts[r["doc_id"]] for r in rows)


def test_no_documents_and_no_ids(spark, none):
    assert simhash.near_duplicates(none).collect() == []
    assert simhash.survivors(none).collect() == []
    frame = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (5, "a b c"), (6, "other words here")], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in simhash.near_duplicates(frame).collect()) == [
        (0, 5), (0, 5), (5, 5), (6, 6),
    ]
    assert sorted(r["doc_id"] or 0 for r in simhash.survivors(frame).collect()) == [5, 6]
    alone = frame.where("doc_id IS NULL OR doc_id = 6")
    assert sorted(r["doc_id"] or 0 for r in simhash.survivors(alone).collect()) == [0, 6]


def clustered(rng, count):
    """Fingerprints in chains and clouds, many of them alike in most bits."""
    values = [rng.getrandbits(64) for _ in range(count // 4)] + [0]
    while len(values) < count:
        value = rng.choice(values[-40:] if rng.random() < 0.5 else values)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            value ^= 1 << rng.randrange(64 if rng.random() < 0.5 else 9)
        values.append(value)
    return values


def linked(spark, values, parts, distance):
    rows = [(simhash.signed(v), i) for i, v in enumerate(values)]
    distinct = spark.createDataFrame(rows, "fingerprint long, first long").dropDuplicates(["fingerprint"])
    probes = simhash.probes(distinct, parts)
    tile = probes.selectExpr("xxhash64(part, value) AS tile", "fingerprint", "probe", "first")
    links = tile.repartition("tile").sortWithinPartitions("tile").mapInArrow(simhash.verifier(distance), "a long, b long")
    found = {r["node"]: r["component"] for r in components(links).collect()}
    return {r["fingerprint"]: found.get(r["first"], r["first"]) for r in distinct.collect()}


def test_every_allocation_finds_all_links(spark):
    values = list(dict.fromkeys(clustered(random.Random(9), 600)))
    want = roots(len(values), np.argwhere(np.triu(np.bitwise_count(np.array(values, np.uint64)[:, None] ^ np.array(values, np.uint64)) <= 2, 1)).tolist())
    thirds = [tuple(range(0, 20)), tuple(range(20, 42)), tuple(range(42, 64))]
    for parts in (
        [simhash.Part(bits, 0) for bits in thirds],
        [simhash.Part(tuple(range(0, 30)), 1), simhash.Part(tuple(range(30, 64)), 0)],
        [simhash.Part(tuple(range(64)), 2)],
    ):
        found = linked(spark, values, parts, 2)
        assert [found[simhash.signed(v)] for v in values] == want


def test_allocation_follows_the_estimates():
    groups = [tuple(range(i, i + 4)) for i in range(0, 64, 4)]
    even, constant = np.full(16, 10.0), np.eye(16)[0] * 160
    for histograms in ([even] * 16, [constant] * 12 + [even] * 4, [even, constant] * 8):
        shares = [simhash.distance_shares(h) for h in histograms]
        parts = simhash.allocate(groups, shares, 100_000, 2)
        assert sum(part.threshold + 1 for part in parts) == 3
        assert len({bit for part in parts for bit in part.bits}) == sum(len(part.bits) for part in parts)
    informative = {bit for part in simhash.allocate(groups, [simhash.distance_shares(h) for h in [constant] * 12 + [even] * 4], 1000, 2) for bit in part.bits}
    assert informative & set(range(48, 64))


def test_large_buckets_are_cut_into_tiles(spark, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(50)}" for _ in range(60)) for _ in range(20)]
    rows = [(i, rng.choice(texts) + rng.choice(["", " a", " b", " c d"]) + f" {i % 90}") for i in range(500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(simhash, "TILE_ROWS", 3)
    got = sorted((r["doc_id"], r["fingerprint"] & (1 << 64) - 1, r["component_id"]) for r in simhash.near_duplicates(frame, 4).collect())
    assert got == brute([i for i, _ in rows], [fingerprint(text) for _, text in rows], 4)


def test_components_of_random_links(spark):
    rng = random.Random(8)
    for count, links in ((400, 250), (300, 600)):
        pairs = [(rng.randrange(count), rng.randrange(count)) for _ in range(links)] + [(i, i + 1) for i in range(0, 60)]
        frame = spark.createDataFrame([(a * 10, b * 10) for a, b in pairs], "a long, b long").repartition(5)
        got = {r["node"]: r["component"] for r in components(frame).collect()}
        root = roots(count, pairs)
        assert got == {i * 10: root[i] * 10 for pair in pairs for i in pair if any(a != b and i in (a, b) for a, b in pairs)}


def test_rows_without_an_id_link_near_ones(spark, monkeypatch):
    """Fingerprints of rows without an id: near each other, and between two that have ids."""
    base = 0x5DEECE66D1234567
    values = [(None, base), (3, base ^ 3), (9, base ^ 0b1100), (None, ~base & (1 << 64) - 1), (None, ~base & (1 << 64) - 2)]
    frame = spark.createDataFrame([(i, simhash.signed(v)) for i, v in values], "doc_id long, fingerprint long")
    monkeypatch.setattr(simhash, "fingerprints", lambda documents, size: documents)
    rows = simhash.grouped(frame, 2, 3).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in rows if r["component_id"]) == [(0, 3), (3, 3), (9, 3)]
    alone = [r for r in rows if r["component_id"] is None]
    assert len(alone) == 2 and len({r["root"] for r in alone}) == 1


def test_survivors_of_texts_that_share_an_id(spark):
    rng = random.Random(6)
    one, two, three = (" ".join(f"w{rng.randrange(500)}" for _ in range(80)) for _ in range(3))
    rows = [(1, one), (1, two), (1, two), (2, two), (5, three), (0, one), (7, None), (7, three)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = {(0, one), (1, two), (5, three), (7, None)}
    kept = [tuple(row) for row in simhash.survivors(frame).collect()]
    assert set(kept) == want and len(kept) == len(want)
