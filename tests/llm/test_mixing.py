import itertools

import numpy as np
import pytest
from brute import odd_documents, words

from matchlive.llm import mixing


def by_source(rows):
    found = {}
    for row in rows:
        found.setdefault(row["source_key"], []).append(row)
    return found


def targets(sizes, weights, total, most):
    """Raises a common level by bisection until the shares are spent."""
    low, high = 0.0, 1e12
    for _ in range(300):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(level * w, most * s) for s, w in zip(sizes, weights, strict=True)) < total else (low, level)
    return [min(low * w, most * s) for s, w in zip(sizes, weights, strict=True)]


def test_odd_documents(odd):
    rows = mixing.mix(odd).collect()
    documents = odd_documents()
    assert sorted((row["doc_id"], row["size"]) for row in rows) == sorted((d[0], len(words(d[1]))) for d in documents)
    names = sorted({d[3] for d in documents if d[3] is not None}, key=lambda s: s.encode()) + [None]
    sizes = [sum(len(words(d[1])) for d in documents if d[3] == name) for name in names]
    want = targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5 * sum(sizes), 2)
    keys = ["null" if name is None else "=" + name for name in names]
    for key, size, target in zip(keys, sizes, want, strict=True):
        own = by_source(rows)[key]
        assert {row["source_size"] for row in own} == {size}
        assert own[0]["target"] == pytest.approx(target, rel=1e-9)
        assert all(0 <= row["copies"] <= 2 and (row["size"] or not row["copies"]) for row in own)
        taken = sum(row["copies"] * row["size"] for row in own)
        assert abs(taken - target) <= max((row["size"] for row in own), default=0) / 2 + 1


def test_reruns_agree_and_repeats_are_emitted(odd):
    first, second = (sorted(tuple(row) for row in mixing.mix(frame).collect()) for frame in (odd, odd.repartition(7)))
    assert first == second
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns
    rows = {(row["doc_id"], row["size"]): row["copies"] for row in mixing.mix(odd).collect() if row["doc_id"] != 8}
    counts = {}
    for row in out.collect():
        counts[row["doc_id"]] = counts.get(row["doc_id"], 0) + 1
    assert all(counts.get(doc_id, 0) == copies for (doc_id, _), copies in rows.items())


def test_no_documents(none):
    assert mixing.mix(none).collect() == []
    assert mixing.mixed_documents(none).collect() == []


def test_knapsack_finds_the_closest_sum():
    rng = np.random.default_rng(4)
    for _ in range(60):
        sizes = np.sort(rng.choice(np.arange(1, 60), 4, replace=False))
        counts = rng.integers(1, 4, 4)
        budget = float(rng.integers(0, int((sizes * counts).sum()) + 1))
        got = mixing._knapsack(sizes, counts, budget)
        best = min(abs(np.dot(t, sizes) - budget) for t in itertools.product(*[range(c + 1) for c in counts]))
        assert (got <= counts).all() and abs(np.dot(got, sizes) - budget) == best


def test_large_sources_come_within_a_word():
    rng = np.random.default_rng(6)
    sizes = np.unique(rng.integers(1, 20_000, 3000))
    counts = rng.integers(1, 300, len(sizes))
    total = int((sizes * counts).sum())
    for share in (0.001, 0.3, 0.77, 0.999):
        taken = mixing.chosen_counts(sizes, counts, share * total)
        assert (taken <= counts).all() and (taken >= 0).all()
        assert abs((taken * sizes).sum() - share * total) <= 1


def test_one_size_in_a_third_of_the_rows(spark):
    frame = spark.range(3000).selectExpr("id AS doc_id", "'s' AS source", "if(id % 3 = 0, 'a b', repeat('w ', 1 + id % 40)) AS text")
    rows = mixing.mix(frame, share=0.5).collect()
    assert abs(sum(r["size"] * r["copies"] for r in rows) - rows[0]["target"]) <= 1


def test_few_long_documents_come_closest():
    rng = np.random.default_rng(8)
    cases = [([1_000_000], [1], 900_000), ([140_000, 150_000, 200_000], [1, 1, 1], 290_000)]
    cases += [([45_000, 50_000, 60_000], [1, 1, 1], 95_000), ([7, 10], [3, 3], 21), ([3], [1], 1.5), ([1, 3], [1, 1], 1.5)]
    for most in (40, 70_000, 200_000, 1_500_000):
        for _ in range(6):
            sizes, counts = np.sort(rng.choice(most, 5, replace=False) + 1), rng.integers(1, 4, 5)
            cases.append((sizes, counts, float(rng.integers(1, int((sizes * counts).sum()) + 1))))
    for sizes, counts, budget in cases:
        sizes, counts = np.array(sizes), np.array(counts)
        got = mixing.chosen_counts(sizes, counts, budget)
        sums = [int(np.dot(t, sizes)) for t in itertools.product(*[range(c + 1) for c in counts])]
        best = min((abs(s - budget), s) for s in sums)
        assert (got >= 0).all() and (got <= counts).all()
        assert (abs(int(np.dot(got, sizes)) - budget), int(np.dot(got, sizes))) == best


def test_many_long_documents_come_close_without_all_choices(monkeypatch):
    monkeypatch.setattr(mixing, "EXACT_WORDS", 0)
    rng = np.random.default_rng(9)
    sizes = np.unique(rng.integers(140_000, 900_000, 60))
    counts = rng.integers(1, 3, len(sizes))
    for share in (0.02, 0.4, 0.9):
        budget = share * float((sizes * counts).sum())
        taken = mixing.chosen_counts(sizes, counts, budget)
        assert (taken <= counts).all() and (taken >= 0).all()
        assert abs((taken * sizes).sum() - budget) <= 1000


def test_source_of_long_documents_gets_its_target(spark):
    frame = spark.createDataFrame([(1, "s", 200_000), (2, "s", 150_000), (3, "s", 140_000)], "doc_id long, source string, n int")
    rows = mixing.mix(frame.selectExpr("doc_id", "source", "repeat('w ', n) AS text"), share=29 / 49).collect()
    assert sum(row["size"] * row["copies"] for row in rows) == 290_000


def test_what_is_emitted_is_what_is_taken(spark):
    """Rows without an id, and rows with one id, source and size, of which not all get as many copies."""
    rows = [(None, f"x{i} " + "w " * (i % 7), "a") for i in range(50)] + [(None, "n " * 5, None), (None, "m " * 6, "b")]
    rows += [(i % 9, f"y{i} z", "ab"[i % 2]) for i in range(60)] + [(100 + i, "v " * (1 + i % 9), "b") for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    for share, repeats in ((1.5, 2), (0.37, 2), (2.3, 3)):
        want, got = {}, {}
        for row in mixing.mix(frame, share=share, repeats=repeats).collect():
            key = row["source_key"], row["doc_id"], row["size"]
            want[key] = want.get(key, 0) + row["copies"]
        out = mixing.mixed_documents(frame, share=share, repeats=repeats)
        assert out.dtypes == frame.dtypes
        for row in out.collect():
            assert tuple(row) in set(rows)
            key = "null" if row["source"] is None else "=" + row["source"], row["doc_id"], len(words(row["text"]))
            got[key] = got.get(key, 0) + 1
        assert got == {key: copies for key, copies in want.items() if copies}
        assert any(key[1] is None for key in got)
