import random

import numpy as np
from brute import odd_documents, random_text, words
from pyspark.sql import functions as F

from matchlive.llm import substring

SCHEMA = "doc_id long, text string"


def brute(rows, window):
    """Kept words of each row, in the order of the rows."""
    first, cover = {}, []
    for doc_id, text in sorted(((row[0], row[1]) for row in rows if row[0] is not None), key=lambda row: row[0]):
        listed = words(text)
        for i in range(len(listed) - window + 1):
            first.setdefault(tuple(listed[i : i + window]), doc_id)
    for row in rows:
        listed = words(row[1])
        gone = set()
        for i in range(len(listed) - window + 1 if row[0] is not None else 0):
            if first[tuple(listed[i : i + window])] < row[0]:
                gone.update(range(i, i + window))
        cover.append((len(listed), len(gone), " ".join(word for i, word in enumerate(listed) if i not in gone)))
    return cover


def check(frame, rows, window=50):
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"], r["kept_text"]) for r in substring.without_repeats(frame, window).collect())
    want = sorted((row[0] or 0, *own) for row, own in zip(rows, brute(rows, window), strict=True))
    assert got == want
    return sum(row[2] for row in want)


def test_odd_documents(odd):
    assert check(odd, odd_documents()) > 300


def test_columns_are_kept(odd):
    out = substring.removed_repeats(odd)
    assert out.dtypes == odd.dtypes
    want = {row[0]: (row[1], own) for row, own in zip(odd_documents(), brute(odd_documents(), 50), strict=True)}
    for row in out.collect():
        text, (_, gone, kept) = want[row["doc_id"]]
        assert row["text"] == (kept if gone else text)
        assert row["n_chars"] == (len(kept) if gone else None if text is None else len(text))


def test_no_documents_and_no_ids(spark, none):
    assert substring.without_repeats(none).collect() == []
    text = random_text(random.Random(1), 90)
    rows = [(None, text), (4, text), (None, text), (3, text), (4, "x " + text)]
    check(spark.createDataFrame(rows, SCHEMA), rows)


def repeating(rng, count, window):
    """Documents made of shared passages cut anywhere, of few words, some just short of a window."""
    passages = [random_text(rng, rng.randrange(window - 2, 3 * window), 30) for _ in range(12)]
    rows = []
    for i in range(count):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            listed = rng.choice(passages).split()
            low = rng.randrange(0, len(listed) // 2)
            parts += [random_text(rng, rng.randrange(0, 15), 30), " ".join(listed[low : rng.randrange(low, len(listed) + 1)])]
        rows.append((rng.randrange(-50, 4 * count), " ".join(parts)))
    return rows


def test_random_overlaps(spark, monkeypatch):
    rng = random.Random(11)
    for window, gathered in ((6, 500_000), (7, 200), (10, 50)):
        monkeypatch.setattr(substring, "GATHERED", gathered)  # packs and references in many pieces
        rows = repeating(rng, 250, window)
        assert check(spark.createDataFrame(rows, SCHEMA).repartition(5), rows, window) > 500


def test_without_broadcast(spark, monkeypatch):
    rows = repeating(random.Random(12), 100, 8)
    monkeypatch.setattr(substring, "BROADCAST_IDS", 0)
    check(spark.createDataFrame(rows, SCHEMA), rows, 8)


def test_a_passage_in_a_third_of_the_documents(spark):
    passage = random_text(random.Random(3), 55)
    own = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: F.concat(F.lit("u"), F.col("doc_id"), F.lit("_"), i)))
    text = F.concat_ws(" ", own, F.when(F.col("doc_id") % 3 == 0, F.lit(passage)), own)
    frame = spark.range(1500).withColumnRenamed("id", "doc_id").select("doc_id", text.alias("text"))
    found = substring.without_repeats(frame)
    assert found.where("doc_id % 3 = 0 AND doc_id > 0 AND n_removed <> 55").count() == 0
    assert found.where("n_removed > 0").count() == 499


def test_a_hot_bucket_is_split(spark):
    passage = random_text(random.Random(3), 55)
    rows = [(n, f"{passage} u{n}" if n % 3 == 0 else random_text(random.Random(n), 56, 10**9)) for n in range(3000)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    places_of = lambda batch: substring.anchors(batch, 25, 50)
    spread = substring.spread_over(frame, places_of, 4096)
    sent, parts = substring.packed(frame, places_of, 4096, 5)
    size = F.sum(F.octet_length("hashes") / 5)
    probes = [r[1] for r in sent.where("kind = 1").groupBy("bucket").agg(size).collect()]
    mean = sum(probes) / 4096
    assert parts == spread.splits.sum()
    assert spread.splits.max() > 20 and len(spread.splits) < spread.splits.sum() <= 1.5 * 4096
    assert max(probes) < 200 and sum(probes) > 60_000 and mean > 15
    references = sent.where("kind = 0").groupBy("bucket").count()
    assert references.join(sent.where("kind = 1"), "bucket", "left_semi").count() > 4096 / 2
    assert check(frame, rows) == 999 * 55


def test_planes_round_trip():
    for values in ([], [5], [-3, 9, 9, -(1 << 62), 1 << 62], list(range(300))):
        array = np.array(values, np.int64)
        assert substring.from_planes(substring.planes(array, 8), 8).tolist() == values
