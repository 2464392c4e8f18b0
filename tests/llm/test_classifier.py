import numpy as np
import pyarrow as pa
from brute import odd_documents

from matchlive.llm import classifier as C
from matchlive.llm import words as W

LABELS = "doc_id long, quality int, toxic int"


def test_real_documents_held_out(spark, monkeypatch):
    """Labelled documents that the bounded sample leaves out are told apart."""
    monkeypatch.setattr(C, "LABELLED", 1500)
    monkeypatch.setattr(C, "BLOCK_ROWS", 700)
    folder = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    order = "xxhash64('sample', doc_id)"
    used = labels.orderBy(C.F.expr(order), "doc_id").limit(1500).select("doc_id")
    rows = C.scored(documents, labels).join(labels, "doc_id").join(used, "doc_id", "left_anti").collect()
    good = [row for row in rows if row["quality"] == 1 and row["toxic"] == 0]
    poor = [row for row in rows if row["quality"] == 0]
    assert len(good) > 1000 and len(poor) > 100
    assert np.mean([row["kept"] for row in good]) > 0.96
    assert np.mean([row["kept"] for row in poor]) < 0.1
    assert all(0 <= row[name] <= 1 for row in rows for name in ("text_score", "meta_score", "score"))


def test_odd_documents_are_scored(spark, odd):
    labels = spark.createDataFrame([(30 + i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (31, None, None), (31, 0, 1), (999, 1, 0)], LABELS)
    rows = C.scored(odd, labels).collect()
    assert sorted(row["doc_id"] for row in rows) == sorted(row[0] for row in odd_documents())
    assert all(0 <= row["score"] <= 1 and row["kept"] is not None for row in rows)
    kept = C.fit_for_training(odd, labels)
    assert kept.dtypes == odd.dtypes
    assert kept.count() == sum(row["kept"] for row in rows)


def test_without_labels_all_is_kept(spark, odd, none):
    for labels in (spark.createDataFrame([], LABELS), spark.createDataFrame([(i, 1, 0) for i in range(99)], LABELS)):
        assert {(row["score"], row["kept"]) for row in C.scored(odd, labels).collect()} == {(None, True)}
    assert C.scored(none, labels).collect() == []


def test_a_model_for_no_documents(spark, none):
    labels = spark.createDataFrame([(30 + i, i % 2, 0) for i in range(60)], LABELS)
    assert C.scored(none, labels).collect() == [] and C.fit_for_training(none, labels).collect() == []


def rows_of(texts):
    (_, _, words), = W.chunks(pa.array(texts), 1 << 30)
    return C.text_rows(words)


def test_rows_stack_and_take():
    one, other = rows_of(["a b", "", "c"]), rows_of(["a b c", "d"])
    both = C.stacked(one, other)
    weights = np.random.default_rng(1).normal(size=(1 << C.TEXT_BITS) + C.SHAPES)
    assert np.allclose(both.times(weights), np.concatenate([one.times(weights), other.times(weights)]))
    assert np.allclose(both.take(np.array([4, 0, 0])).times(weights), both.times(weights)[[4, 0, 0]])


def test_views_lend_each_other_documents():
    """Only pages tell in the labelled sample what the text of the pool says: the text view learns it."""
    rng = np.random.default_rng(2)

    def sample(count, informed):
        good = rng.random(count) < 0.5
        texts = [f"w{rng.integers(9)} " * 5 + (("fine" if g else "bad") if i else "") for g, i in zip(good, informed, strict=True)]
        meta = np.column_stack([np.where(good, 7, 9)] * len(C.META))
        return rows_of(texts), C.meta_rows(meta), good

    text, meta, good = sample(1200, np.zeros(1200, bool))
    pool_text, pool_meta, _ = sample(600, np.ones(600, bool))
    model = C.co_train(text, meta, good, pool_text, pool_meta)
    seen, _, truth = sample(200, np.ones(200, bool))
    assert np.mean((seen.times(model.text) > 0) == truth) > 0.95


def test_calibration_is_near_the_shares():
    rng = np.random.default_rng(3)
    scores = rng.normal(size=4000)
    good = rng.random(4000) < C.sigmoid(2 * scores - 1)
    scale = C.calibrated(scores, good)
    assert abs(scale[0] - 2) < 0.3 and abs(scale[1] + 1) < 0.2


def lent_in_rounds(spark, monkeypatch, rows, labels):
    """What the views have after each round, with 5 documents of either class lent a round."""
    monkeypatch.setattr(C, "LENT", 5)
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(4)
    found, lending = [], C.lending

    def watched(*tables):
        lend = lending(*tables)

        def watch(*state):
            found.append(lend(*state))
            return found[-1]

        return watch

    monkeypatch.setattr(C, "lending", watched)
    assert C.trained(documents, spark.createDataFrame(labels, LABELS)) is not None
    return found


def test_every_unlabelled_document_can_be_lent(spark, monkeypatch):
    """New documents of both classes each round, from the whole table, rows without an id or a label that counts too."""
    text = lambda good: ("fine " if good else "bad ") * 9
    row = lambda i, key: (key, f"{text(i % 2)} w{i}", "en", "a" if i % 2 else "b", 50)
    monkeypatch.setattr(C, "BLOCK_ROWS", 8)
    rows = [row(i, i) for i in range(800)] + [row(800 + i, None if i % 3 else 800 + i) for i in range(60)]
    labels = [(i, i % 2, 0) for i in range(800)] + [(800 + i, None, 0) for i in range(60)]
    rounds = lent_in_rounds(spark, monkeypatch, rows + rows[:30] + rows[-9:], labels)
    assert len(rounds) == C.ROUNDS
    for number, lent in enumerate(rounds, 1):
        for view in lent:
            assert len(set(view.key.tolist())) == len(view.key) == 10 * number
            assert view.good.sum() == 5 * number
            assert len(view.rows.first) - 1 == len(view.key)
