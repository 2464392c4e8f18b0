
import numpy as np
from brute import odd_documents

from matchlive.llm import sharding


def size(text):
    return len((text or "").encode()) + 16


def check(rows, found, shards):
    assert sorted((r["doc_id"], r["text"] or "") for r in found) == sorted((row[0], row[1] or "") for row in rows)
    own = {}
    for row in found:
        own.setdefault(row["shard"], []).append(row)
    assert set(own) <= set(range(shards))
    for inside in own.values():
        assert sorted(row["slot"] for row in inside) == list(range(len(inside)))
    sums = [sum(size(row["text"]) for row in own.get(shard, ())) for shard in range(shards)]
    return np.array(sums)


def test_odd_documents(odd):
    rows = odd_documents()
    for shards in (3, 40):
        sums = check(rows, sharding.write_shards(odd, shards).collect(), shards)
        largest = max(size(row[1]) for row in rows)
        # each of the two ends of a shard is off by half a document, or by the tolerance
        assert np.abs(sums - sums.mean()).max() <= largest + 2 * sharding.GROUP_TOLERANCE * sums.mean() + 1


def test_real_documents_are_even_and_copies_together(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = [tuple(row) for row in frame.select("doc_id", "text").collect()]
    found = sharding.write_shards(frame).collect()
    sums = check(rows, found, 40)
    assert sums.max() / sums.mean() < 1.1 and sums.min() / sums.mean() > 0.9
    by_text = {}
    for row in found:
        by_text.setdefault(row["text"], set()).add(row["shard"])
    assert max(map(len, by_text.values())) == 1


def test_reruns_agree(odd):
    first, second = (
        sorted((r["doc_id"], r["shard"], r["slot"]) for r in sharding.write_shards(frame, 5).collect())
        for frame in (odd, odd.repartition(6))
    )
    assert first == second


def test_a_third_of_the_rows_alike(spark):
    text = "if(id % 3 = 0, repeat('same ', 40), repeat(id, 20 + id % 30))"
    frame = spark.range(6000).selectExpr("id AS doc_id", f"{text} AS text")
    rows = [tuple(row) for row in frame.collect()]
    sums = check(rows, sharding.write_shards(frame, 10).collect(), 10)
    assert np.abs(sums / sums.mean() - 1).max() < 0.03


def test_no_documents(none):
    assert sharding.write_shards(none).collect() == []


def test_counts_are_exact(spark):
    rng = np.random.default_rng(1)
    keys, sizes = rng.integers(-(1 << 62), 1 << 62, 500), rng.integers(1, 99, 500)
    frame = spark.createDataFrame([(int(k), int(s)) for k, s in zip(keys, sizes, strict=True)], "key long, size long")
    probes = np.sort(rng.choice(keys, 20, replace=False))
    below = sharding.counts_below(frame, probes)
    assert below.bytes[:-1].tolist() == [int(sizes[keys < p].sum()) for p in probes]
    assert below.rows.tolist() == [*[int((keys < p).sum()) for p in probes], 500]


def test_probes_are_bounded_at_any_size(spark, monkeypatch):
    sent = []
    count = sharding.counts_below
    monkeypatch.setattr(sharding, "counts_below", lambda keys, probes: (sent.append(len(probes)), count(keys, probes))[1])
    keys = spark.range(40_000).selectExpr("xxhash64(id) AS key", "1000L + id % 7 AS size")
    for total in (1 << 20, 100 << 40, 1 << 60):
        parts = sharding.parts_of(total, sharding.SHARDS)
        assert 4 <= parts and parts * sharding.SHARDS <= sharding.MOST_PARTS
    bounds = sharding.splitters(keys, sharding.SHARDS, parts)
    assert len(bounds) == parts * sharding.SHARDS - 1
    assert max(sent) <= max(8, sharding.PROBES) * sharding.MOST_PARTS
