"""Quality by co-training: one classifier reads the text, another only what is known about the page.

Both are logistic regressions, fitted on a bounded sample of labelled documents.
In each round either view scores all unlabelled documents, and those it is surest
of, and has not lent before, become training documents of the other view. Each
view is calibrated, and the calibrated views combined, on labelled documents that
neither has been trained on. The combined score is then computed for every
document.
"""

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlive.llm.common import Carried, saved, small_batches, text_of
from matchlive.llm.quality import CLASSES, class_counts, repeated_lines, shares
from matchlive.llm.words import Words, chunks, mix, split

#: Labelled documents used, a quarter of them for calibration only.
LABELLED = 16_000
#: Rows that the driver receives, and whose products it holds, at once.
BLOCK_ROWS = 2_000
TEXT_BITS = 18
META_BITS = 12
ROUNDS = 3
#: A view lends a document to the other from this calibrated probability on, and so many of either class a round.
CONFIDENCE, LENT = 0.97, 1_000
STEPS, RATE, PENALTY = 150, 0.5, 1e-4
#: Steps from weights of the round before.
MORE_STEPS = 50
#: Places that fewer training rows have are left out.
LEAST_ROWS = 3
#: The threshold keeps this share of the good calibration documents at least.
KEEP_GOOD = 0.99
SHAPES = CLASSES + 5


def folded_bytes() -> np.ndarray:
    """A-Z in lower case, ASCII marks as spaces."""
    out = np.arange(256, dtype=np.uint8)
    out[0x21:0x7F][[not chr(byte).isalnum() for byte in range(0x21, 0x7F)]] = 0x20
    out[ord("A") : ord("Z") + 1] += 32
    return out


FOLDED = folded_bytes()


class Rows(NamedTuple):
    """Sparse rows: row i has places ``at[first[i]:first[i + 1]]`` with their values."""

    first: np.ndarray
    at: np.ndarray
    value: np.ndarray

    def times(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.first) - 1)
        for rows, part in self.blocks():
            out[rows] = row_sums(self.value[part] * weights[self.at[part]], self.first[rows.start : rows.stop + 1] - part.start)
        return out

    def blocks(self) -> Iterator[tuple[slice, slice]]:
        """BLOCK_ROWS rows, and their places."""
        count = len(self.first) - 1
        for low in range(0, count, BLOCK_ROWS):
            high = min(low + BLOCK_ROWS, count)
            yield slice(low, high), slice(self.first[low], self.first[high])

    def take(self, rows: np.ndarray) -> "Rows":
        length = np.diff(self.first)[rows]
        first = np.concatenate(([0], np.cumsum(length)))
        place = np.arange(first[-1]) - np.repeat(first[:-1], length) + np.repeat(self.first[rows], length)
        return Rows(first, self.at[place], self.value[place])


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0.0], np.cumsum(values)))
    return sums[first[1:]] - sums[first[:-1]]


def summed(row: np.ndarray, place: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, place) in order, with their counts, as (first, place, count)."""
    key, count = np.unique(row.astype(np.int64) << 32 | place.astype(np.int64), return_counts=True)
    first = np.searchsorted(key >> 32, np.arange(rows + 1))
    return first, key & 0xFFFFFFFF, count


def text_rows(words: Words) -> Rows:
    """Hashed words of each text, marks and case aside, and its shape: character classes, word lengths, repetition.

    A word counts by the logarithm of its number, divided by the root of the
    logarithm of the text's length, so that one telling word still shows in a
    long text.
    """
    rows = len(words.first) - 1
    plain = split(FOLDED[words.bytes], words.offsets)
    hashes, document = plain.hashes(), plain.documents()
    place = hashes & np.uint64((1 << TEXT_BITS) - 1)
    first, at, count = summed(document, place, rows)
    n_words = np.diff(words.first)
    scale = 1 / np.sqrt(np.log2(n_words + 2))
    value = np.log2(count + 1) * np.repeat(scale, np.diff(first))
    flat, offsets = memoryview(words.bytes), words.offsets
    lines = np.array([repeated_lines(bytes(flat[a:b])) for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
    length = np.concatenate(([0], np.cumsum(words.end - words.start)))
    letters = (length[words.first[1:]] - length[words.first[:-1]]) / np.maximum(n_words, 1)
    shape = np.column_stack(
        [
            np.sqrt(shares(class_counts(words))) * 4,
            np.minimum(letters, 40) / 4,
            np.diff(first) / np.maximum(n_words, 1) * 4,
            np.log2(lines + 1),
            np.log2(n_words + 1) / 4,
            np.ones(rows),
        ]
    )
    return beside(Rows(first, at, value), shape, 1 << TEXT_BITS)


def beside(rows: Rows, dense: np.ndarray, start: int) -> Rows:
    """Dense columns, from place ``start`` on, after the sparse ones of each row."""
    count, width = dense.shape
    length = np.diff(rows.first) + width
    first = np.concatenate(([0], np.cumsum(length)))
    own = np.arange(len(rows.at)) + np.repeat(np.arange(count) * width, np.diff(rows.first))
    added = (first[1:, None] - width + np.arange(width)).ravel()
    at, value = np.empty(first[-1], np.int32), np.empty(first[-1], np.float32)
    at[own], value[own] = rows.at, rows.value
    at[added], value[added] = np.tile(start + np.arange(width), count), dense.ravel()
    return Rows(first, at, value)


def meta_columns() -> list[Column]:
    """What is known without the text: language, source and stated length, alone and together."""
    lang, source = (F.coalesce(F.concat(F.lit("="), name), F.lit("null")) for name in ("lang", "source"))
    length = F.coalesce(F.floor(2 * F.log2(F.greatest("n_chars", F.lit(0)) + 1)).cast("string"), F.lit("null"))
    values = [("l", lang), ("s", source), ("n", length)]
    values += [("ls", F.concat_ws("|", lang, source)), ("ln", F.concat_ws("|", lang, length))]
    mask = F.lit((1 << META_BITS) - 1)
    return [F.xxhash64(F.lit(name), value).bitwiseAND(mask).alias(f"meta_{name}") for name, value in values]


META = ("meta_l", "meta_s", "meta_n", "meta_ls", "meta_ln")


def meta_rows(columns: np.ndarray) -> Rows:
    width = columns.shape[1]
    at = np.column_stack([columns, np.full(len(columns), 1 << META_BITS)])
    return Rows(np.arange(len(columns) + 1) * (width + 1), at.ravel(), np.ones(at.size))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Part(NamedTuple):
    """Some rows with their outcomes; those that are not ``used`` are left out of training."""

    rows: Rows
    good: np.ndarray
    used: np.ndarray


def fitted(parts: Sequence[Part], places: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Logistic regression with both classes weighed alike, by Adam from ``weights`` on.

    Rows are read where they are: what is not used weighs nothing, and places of
    too few rows keep no weight.
    """
    steps = STEPS if weights is None else MORE_STEPS
    weights = np.zeros(places) if weights is None else weights.copy()
    number = np.zeros(places, np.int64)
    for part in parts:
        for rows, at in part.rows.blocks():
            own = np.repeat(part.used[rows], np.diff(part.rows.first[rows.start : rows.stop + 1]))
            number += np.bincount(part.rows.at[at][own], minlength=places)
    seen = number >= LEAST_ROWS
    of_class = [max(sum(int((part.used & (part.good == kind)).sum()) for part in parts), 1) for kind in (False, True)]
    balance = [np.where(part.good, 0.5 / of_class[1], 0.5 / of_class[0]) * part.used for part in parts]
    mean, square = np.zeros(places), np.zeros(places)
    for step in range(1, steps + 1):
        slope = PENALTY * weights
        for part, weigh in zip(parts, balance, strict=True):
            for rows, at in part.rows.blocks():
                place, value, first = part.rows.at[at], part.rows.value[at], part.rows.first[rows.start : rows.stop + 1] - at.start
                error = (sigmoid(row_sums(value * weights[place], first)) - part.good[rows]) * weigh[rows]
                slope += np.bincount(place, value * np.repeat(error, np.diff(first)), places)
        slope *= seen
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        weights -= RATE / np.sqrt(step) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return weights


def calibrated(scores: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Logistic regression of the outcome on scores and a constant, by Newton steps with a small penalty."""
    x = np.column_stack([scores, np.ones(len(scores))])
    # targets a little off 0 and 1, so that separable scores still give finite weights
    y = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = sigmoid(x @ weights)
        slope = x.T @ (p - y) + 1e-2 * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        weights -= np.clip(np.linalg.solve(curve, slope), -4, 4)
    return weights


class Model(NamedTuple):
    """Weights of both views, their calibrations, and how to combine them."""

    text: np.ndarray
    meta: np.ndarray
    text_scale: np.ndarray
    meta_scale: np.ndarray
    combine: np.ndarray
    threshold: float

    def scores(self, text: Rows, meta: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated text and metadata scores, and the combined one."""
        one = self.text_scale[0] * text.times(self.text) + self.text_scale[1]
        other = self.meta_scale[0] * meta.times(self.meta) + self.meta_scale[1]
        both = self.combine[0] * one + self.combine[1] * other + self.combine[2]
        return sigmoid(one), sigmoid(other), sigmoid(both)


class Lent(NamedTuple):
    """Documents lent to a view: their keys, their features there, and what the other view takes them for."""

    key: np.ndarray
    rows: Rows
    good: np.ndarray

    def plus(self, key: np.ndarray, rows: Rows, good: np.ndarray) -> "Lent":
        return Lent(np.append(self.key, key), stacked(self.rows, rows), np.append(self.good, good))


NOTHING = Rows(np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32))
#: From weights and calibrations of both views, and what either has been lent, to what either has then.
Lending = Callable[[list[np.ndarray], list[np.ndarray], list[Lent]], list[Lent]]


def margins(rows: Rows, weights: np.ndarray, scale: np.ndarray, key: np.ndarray, lent: np.ndarray) -> np.ndarray:
    """Calibrated scores on the logistic scale; 0 for documents that are unsure or lent already."""
    margin = scale[0] * rows.times(weights) + scale[1]
    sure = np.abs(margin) >= np.log(CONFIDENCE / (1 - CONFIDENCE))
    return np.where(sure & ~np.isin(key, lent), margin, 0.0)


def co_train(text: Rows, meta: Rows, good: np.ndarray, pool_text: Rows, pool_meta: Rows) -> Model:
    """Trains both views on rows with an outcome and a pool at hand."""
    pools, key = (pool_text, pool_meta), np.arange(len(pool_text.first) - 1)

    def lend(weights: list[np.ndarray], scales: list[np.ndarray], lent: list[Lent]) -> list[Lent]:
        out = []
        for view, giver in ((0, 1), (1, 0)):
            margin = margins(pools[giver], weights[giver], scales[giver], key, lent[view].key)
            order = np.argsort(-np.abs(margin), kind="stable")
            chosen = np.concatenate([order[margin[order] > 0][:LENT], order[margin[order] < 0][:LENT]])
            out.append(lent[view].plus(chosen, pools[view].take(chosen), margin[chosen] > 0))
        return out

    return co_trained([text], meta, good, lend)


def co_trained(text: Sequence[Rows], meta: Rows, good: np.ndarray, lend: Lending) -> Model:
    """Trains both views on three quarters of the rows; the fourth calibrates and sets the threshold."""
    held = np.arange(len(good)) % 4 == 3
    views = [(as_parts(text, good, ~held), (1 << TEXT_BITS) + SHAPES), (as_parts([meta], good, ~held), (1 << META_BITS) + 1)]
    lent = [Lent(np.zeros(0, np.int64), NOTHING, np.zeros(0, bool)) for _ in views]
    weights: list[np.ndarray | None] = [None, None]
    scales = [np.zeros(2), np.zeros(2)]
    raw = [np.zeros(0), np.zeros(0)]
    for round_ in range(ROUNDS + 1):
        for view, (parts, places) in enumerate(views):
            borrowed = Part(lent[view].rows, lent[view].good, np.ones(len(lent[view].good), bool))
            weights[view] = fitted([*parts, borrowed], places, weights[view])
            raw[view] = np.concatenate([part.rows.times(weights[view])[~part.used] for part in parts])
            scales[view] = calibrated(raw[view], good[held])
        if round_ < ROUNDS:
            lent = lend(weights, scales, lent)
    logits = np.column_stack([scales[view][0] * raw[view] + scales[view][1] for view in (0, 1)])
    combine = calibrated(logits, good[held])
    model = Model(weights[0], weights[1], scales[0], scales[1], combine, 0.5)
    both = sigmoid(logits @ combine[:2] + combine[2])
    return model._replace(threshold=float(min(0.5, np.quantile(both[good[held]], 1 - KEEP_GOOD))))


def as_parts(rows: Sequence[Rows], good: np.ndarray, used: np.ndarray) -> list[Part]:
    out, low = [], 0
    for some in rows:
        high = low + len(some.first) - 1
        out.append(Part(some, good[low:high], used[low:high]))
        low = high
    return out


def stacked(one: Rows, other: Rows) -> Rows:
    return Rows(
        np.concatenate([one.first, one.first[-1] + other.first[1:]]),
        np.concatenate([one.at, other.at]),
        np.concatenate([one.value, other.value]),
    )


def sampled(documents: DataFrame, key: Column, keys: Sequence[int]) -> tuple[list[Rows], Rows]:
    """Features of the documents with these keys, in that order; of documents that share a key, the same one each time.

    The features are written and come to the driver some BLOCK_ROWS at a time,
    each time in one part of the text rows.
    """
    spark = documents.sparkSession
    places = spark.createDataFrame([(int(own), place) for place, own in enumerate(keys)], "key long, place int")
    rows = documents.select(key.cast("long").alias("key"), text_of("text").alias("text"), *meta_columns())
    rows = rows.join(F.broadcast(places), "key")
    one = F.min(F.struct(F.xxhash64("text", *META).alias("tie"), "text", *META)).alias("one")
    rows = rows.groupBy("place").agg(one).select("place", "one.*").drop("tie").repartition(16, "place")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in chunks(batch.column("text")):
                found = text_rows(words)
                part = batch.slice(low, high - low)
                lists = [
                    pa.ListArray.from_arrays(pa.array(found.first, pa.int32()), pa.array(values))
                    for values in (found.at, found.value)
                ]
                kept = [part.column(name) for name in ("place", *META)]
                yield pa.RecordBatch.from_arrays([*kept, *lists], names=["place", *META, "at", "value"])

    schema = "place int, " + ", ".join(f"{name} long" for name in META) + ", at array<int>, value array<float>"
    table = saved(rows.mapInArrow(features, schema), "features")
    text, meta = [], []
    for low in range(0, max(len(keys), 1), BLOCK_ROWS):
        some = table.where((F.col("place") >= low) & (F.col("place") < low + BLOCK_ROWS)).toArrow()
        some = some.sort_by("place").combine_chunks()
        at, value = (some.column(name).combine_chunks() for name in ("at", "value"))
        first = np.concatenate(([0], np.cumsum(at.value_lengths().to_numpy()))).astype(np.int64)
        text.append(Rows(first, at.flatten().to_numpy().copy(), value.flatten().to_numpy().copy()))
        meta.append(np.column_stack([some.column(name).to_numpy() for name in META]))
    return text, meta_rows(np.concatenate(meta))


def row_key() -> Column:
    """Rows with one id and the same features are one document, rows without an id too."""
    return F.xxhash64("doc_id", text_of("text"), *meta_columns())


def sure_documents(documents: DataFrame, labels: DataFrame, weights: list[np.ndarray], scales: list[np.ndarray],
                   lent: list[Lent]) -> DataFrame:
    """(key, metadata, text_margin, meta_margin) of every unlabelled document that a view can lend."""
    lent_by_text, lent_by_meta = lent[1].key, lent[0].key

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = np.column_stack([batch.column(name).to_numpy() for name in META])
            keys = batch.column("key").to_numpy()
            for low, high, words in chunks(batch.column("text")):
                key = keys[low:high]
                by_text = margins(text_rows(words), weights[0], scales[0], key, lent_by_text)
                by_meta = margins(meta_rows(columns[low:high]), weights[1], scales[1], key, lent_by_meta)
                out = batch.slice(low, high - low).select(["doc_id", "key", *META])
                out = out.append_column("text_margin", pa.array(by_text)).append_column("meta_margin", pa.array(by_meta))
                yield out.filter(pa.array((by_text != 0) | (by_meta != 0)))

    rows = documents.select(F.col("doc_id").cast("long"), row_key().alias("key"), text_of("text").alias("text"), *meta_columns())
    metas = ", ".join(f"{name} long" for name in META)
    found = rows.mapInArrow(score, f"doc_id long, key long, {metas}, text_margin double, meta_margin double")
    # rows without an id match no label; their own hash spreads them
    found = found.withColumn("spread", F.when(F.col("doc_id").isNull(), F.col("key")).otherwise(F.lit(0)))
    known = labels.where(LABEL).select(F.col("doc_id").cast("long"), F.lit(0).cast("long").alias("spread"))
    return saved(found.join(known, ["doc_id", "spread"], "left_anti").drop("doc_id", "spread"), "sure-documents")


def lending(documents: DataFrame, labels: DataFrame) -> Lending:
    """Either view lends the other the LENT documents of either class that it is surest of, of the whole table."""

    def lend(weights: list[np.ndarray], scales: list[np.ndarray], lent: list[Lent]) -> list[Lent]:
        sure, out = sure_documents(documents, labels, weights, scales, lent), []
        for view, margin in enumerate(("meta_margin", "text_margin")):
            chosen = []
            for of_class in (F.col(margin) > 0, F.col(margin) < 0):
                # the sums of copies can differ in their last digits
                some = sure.where(of_class).groupBy("key", *META).agg(F.max(margin).alias(margin))
                chosen += some.orderBy(F.abs(margin).desc(), "key").limit(LENT).collect()
            if not chosen:
                out.append(lent[view])
                continue
            good = {row["key"]: row[margin] > 0 for row in chosen}
            if view == 0:
                key, rows = np.array(sorted(good), np.int64), NOTHING
                for part in sampled(documents, row_key(), sorted(good))[0]:
                    rows = stacked(rows, part)
            else:
                key = np.array([row["key"] for row in chosen], np.int64)
                rows = meta_rows(np.array([[row[name] for name in META] for row in chosen], np.int64))
            out.append(lent[view].plus(key, rows, np.array([good[int(i)] for i in key], bool)))
        return out

    return lend


#: Labels that count.
LABEL = "doc_id IS NOT NULL AND quality IS NOT NULL"


def trained(documents: DataFrame, labels: DataFrame) -> Model | None:
    """The model, or none if the labelled documents are not of both kinds.

    Good is quality 1 and not toxic. Labels without an id or quality do not
    count; of several for one id the lowest does.
    """
    known = labels.where(LABEL).groupBy("doc_id")
    good = ((F.min("quality") > 0) & (F.max(F.coalesce("toxic", F.lit(0))) == 0)).alias("good")
    known = known.agg(good).join(documents.select("doc_id").distinct(), "doc_id", "left_semi")
    order = F.xxhash64(F.lit("sample"), "doc_id")
    outcome = {row["doc_id"]: row["good"] for row in known.orderBy(order, "doc_id").limit(LABELLED).collect()}
    if len(set(outcome.values())) < 2 or len(outcome) < 16:
        return None
    ids = np.array(sorted(outcome), np.int64)
    ids = ids[np.argsort(mix(ids.astype(np.uint64)), kind="stable")]
    truth = np.array([outcome[int(i)] for i in ids])
    return co_trained(*sampled(documents, F.col("doc_id"), ids.tolist()), truth, lending(documents, labels))


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text_score, meta_score, score, kept) of every document.

    Scores are probabilities of being fit for training. Null text is scored as
    empty; null metadata is a value of its own; rows repeated, or without an id,
    are scored each.
    Without labelled documents of both kinds, scores are null and all is kept.
    Extra columns are left out. Ids are integers.
    """
    ids = Carried(documents.select("doc_id"))
    return _with_scores(documents, labels, ids).withColumnRenamed(ids["doc_id"], "doc_id")


def fit_for_training(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, with all their columns."""
    whole = Carried(documents)
    return whole.restored(_with_scores(documents, labels, whole).where("kept"))


def _with_scores(documents: DataFrame, labels: DataFrame, carried: Carried) -> DataFrame:
    model = trained(small_batches(documents), labels)
    names = ("text_score", "meta_score", "score")
    if model is None:
        none = [F.lit(None).cast("double").alias(name) for name in names]
        return documents.select(*carried.columns, *none, F.lit(True).alias("kept"))
    text, own = carried["text"] if "text" in carried.names else "text", carried.own

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = np.column_stack([batch.column(name).to_numpy() for name in META])
            for low, high, words in chunks(batch.column(text)):
                found = model.scores(text_rows(words), meta_rows(columns[low:high]))
                out = batch.slice(low, high - low).select(own)
                for name, values in zip(names, found, strict=True):
                    out = out.append_column(name, pa.array(values))
                yield out.append_column("kept", pa.array(found[2] >= model.threshold))

    read = [F.col("text")] if text == "text" else []
    rows = documents.select(*carried.columns, *read, *meta_columns())
    return rows.mapInArrow(score, f"{carried.schema}, text_score double, meta_score double, score double, kept boolean")
