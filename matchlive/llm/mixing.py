"""Mixing sources to target weights by fitting whole documents into each source's budget of words.

A source's budget is covered by whole passes over it and a rest. For the rest,
documents are counted by exact size; each size gives its proportional share of
documents, and a bounded knapsack over sizes spends what is left. Which
documents of a size are taken is set by a seeded hash of their id.
"""

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlive.llm.common import WORD, Carried, numbered, parts_for, saved

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
SEED = "mix-42"
#: Rests above so many words, and above four of the largest document, are first cut by whole documents.
KNAPSACK_WORDS = 1 << 16
#: Where that is not exact, the knapsack goes over all documents if no sum that counts has more words.
EXACT_WORDS = 1 << 25


def water_fill(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; the excess goes to the others."""
    targets, open_ = [0.0] * len(sizes), [i for i, size in enumerate(sizes) if size > 0]
    rest = min(total, most * sum(sizes))
    while open_:
        unit = rest / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit > most * sizes[i]]
        for i in full or open_:
            targets[i] = most * sizes[i] if full else weights[i] * unit
            rest -= targets[i] if full else 0
        if not full:
            break
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def chosen_counts(sizes: np.ndarray, counts: np.ndarray, budget: float) -> np.ndarray:
    """How many documents of each size to take so that their words come closest to ``budget``.

    ``sizes`` are distinct and positive. Of sums equally close the smaller wins.
    Proportional shares come first, which documents cover exactly where there
    are many; where they do not, all choices are compared up to EXACT_WORDS.
    Beyond, those are compared that add to the shares and to the largest documents.
    """
    total = int((sizes * counts).sum())
    if budget <= 0 or not total:
        return np.zeros(len(sizes), np.int64)
    take = np.floor(counts * min(1.0, budget / total)).astype(np.int64)
    rest = budget - float((take * sizes).sum())
    for i in np.argsort(-sizes, kind="stable"):
        bound = max(KNAPSACK_WORDS, 4 * int(sizes[take < counts].max(initial=0)))
        if rest <= bound:
            break
        if take[i] < counts[i]:
            more = min(int(counts[i] - take[i]), int((rest - bound) // sizes[i]) + 1)
            take[i] += more
            rest -= float(more * sizes[i])
    take += _knapsack(sizes, counts - take, rest)
    words = int((take * sizes).sum())
    if words != _nearest(budget) and _limit(sizes, counts, budget) <= EXACT_WORDS:
        other = _knapsack(sizes, counts, budget)
        other_words = int((other * sizes).sum())
        if (abs(other_words - budget), other_words) < (abs(words - budget), words):
            return other
    return take


def _nearest(budget: float) -> int:
    """The whole number nearest to the budget, the smaller of two."""
    return math.ceil(budget - 0.5)


def _limit(sizes: np.ndarray, counts: np.ndarray, budget: float) -> int:
    """The largest sum that can be the closest: without any of its documents, larger ones would be closer."""
    return int(min(2 * budget, budget + int(sizes[counts > 0].max(initial=0)))) + 1


def _knapsack(sizes: np.ndarray, counts: np.ndarray, budget: float) -> np.ndarray:
    """Bounded knapsack: bit s of ``reached`` is set if some choice has s words."""
    taken = np.zeros(len(sizes), np.int64)
    limit = _limit(sizes, counts, budget)
    usable = [i for i in np.argsort(-sizes, kind="stable") if 0 < sizes[i] <= limit and counts[i] > 0]
    if budget <= 0 or not usable:
        return taken
    reached, everything = 1, (1 << (limit + 1)) - 1  # the empty choice has 0 words
    first = np.full(limit + 1, -1, np.int32)
    steps: list[tuple[int, int]] = []
    wanted = 1 << _nearest(budget)
    for i in usable:
        left, copies = min(int(counts[i]), limit // int(sizes[i])), 1
        while left and not reached & wanted:
            copies = min(copies, left)
            new = (reached << int(sizes[i]) * copies) & everything & ~reached
            if new:
                data = np.frombuffer(new.to_bytes((limit // 64 + 1) * 8, "little"), "<u8")
                some = np.flatnonzero(data)  # each sum is new once, so that few bits are unpacked a step
                bits = np.unpackbits(data[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                row, bit = np.nonzero(bits)
                first[some[row] * 64 + bit] = len(steps)
                reached |= new
            steps.append((i, copies))
            left, copies = left - copies, copies * 2
    sums = np.append(0, np.flatnonzero(first >= 0))
    at = int(sums[np.argmin(np.abs(sums - budget))])
    while at:
        i, copies = steps[first[at]]
        taken[i] += copies
        at -= copies * int(sizes[i])
    return taken


def _fit_source(histogram: pd.DataFrame) -> pd.DataFrame:
    """Copies that every document of a size gets, and how many documents get one more."""
    sizes = histogram["__size"].to_numpy(np.int64)
    counts = histogram["__count"].to_numpy(np.int64)
    total, target = int((sizes * counts).sum()), float(histogram["__target"].iloc[0])
    whole = int(target // total) if total else 0
    extra = chosen_counts(sizes, counts, target - whole * total)
    return histogram[["__source", "__size", "__source_size", "__target"]].assign(__whole=whole, __extra=extra)


def source_targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: float = REPEATS
) -> DataFrame:
    """Adds ``__target`` to rows of (source, null or not, size): one row a source, so it is small.

    The list of sources goes through the driver; it has a row per source, never per document.
    """
    rows = sources.orderBy(F.col("source").isNull(), F.encode("source", "utf-8")).collect()
    sizes = [row["__source_size"] for row in rows]
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(rows))], share * sum(sizes), repeats)
    out = [(row["__source"], row["__source_size"], float(target)) for row, target in zip(rows, targets, strict=True)]
    spark = sources.sparkSession
    return spark.createDataFrame(out, "__source string, __source_size long, __target double")


def mix(
    documents: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: float = REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, source_key, size, source_size, target, copies): how often the mix takes each document.

    Size is the number of words; null text has 0 and an empty text too, and such
    documents get 0 copies. A null source is a source of its own. Documents of
    one size in one source are chosen by a seeded hash of the id, so reruns
    agree; of rows repeated with one id, or without an id, any may be the one
    taken. Extra columns are left out. No documents give no rows. What is known of
    a source, one row each, passes through the driver, and the sizes of one source
    are fitted in one task: sources are a list, not hosts by the million.
    """
    rows = saved(documents.select("doc_id", "source", source_key(), word_count().alias("__size")), "mix-sizes")
    return taken(rows, weights, share, repeats, seed).select(
        "doc_id",
        F.col("__source").alias("source_key"),
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        F.col("__copies").alias("copies"),
    )


def taken(
    rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: float = REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """Adds ``__source_size``, ``__target`` and ``__copies`` to saved rows of id, source, its key and size."""
    histogram = saved(rows.groupBy("source", "__source", "__size").agg(F.count("*").alias("__count")), "mix-counts")
    sums = histogram.groupBy("source", "__source").agg(F.sum(F.col("__size") * F.col("__count")).alias("__source_size"))
    targets = source_targets(sums, weights, share, repeats)
    plan = (
        histogram.select("__source", "__size", "__count")
        .join(targets, "__source")
        .groupBy("__source")
        .applyInPandas(
            _fit_source,
            "__source string, __size long, __source_size long, __target double, __whole long, __extra long",
        )
    )
    total = histogram.agg(F.sum("__count")).first()[0] or 0
    ranked = numbered(
        rows.drop("source"), ["__source", "__size"], [F.lit(seed), F.col("doc_id")], parts_for(total), "__rank"
    )
    copies = F.col("__whole") + (F.col("__rank") < F.col("__extra")).cast("long")
    copies = F.when(F.col("__size") > 0, copies).otherwise(F.lit(0)).cast("long")
    return ranked.join(plan, ["__source", "__size"]).withColumn("__copies", copies)


def source_key():
    """The source as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")).alias("__source")


def word_count():
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def mixed_documents(documents: DataFrame, **settings) -> DataFrame:
    """The documents of the mix with their columns, each as often as it is taken.

    Each row has a key of its own, so that rows without an id, and rows that share
    one, get the copies that the mix gives them.
    """
    whole = Carried(documents)
    keyed = documents.select(
        *whole.columns, source_key(), word_count().alias("__size"), F.monotonically_increasing_id().alias("__row")
    )
    kept = saved(keyed, "mix-documents")  # from here on the keys stay the same
    own = [F.col(whole[name]).alias(name) for name in ("doc_id", "source")]
    copies = taken(kept.select(*own, "__source", "__size", "__row"), **settings).where("__copies > 0")
    joined = kept.join(copies.select("__row", "__copies"), "__row")
    return whole.restored(joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))))
