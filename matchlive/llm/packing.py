"""Best-two-fit packing of document pieces into sequences of a fixed number of tokens.

A bin is filled greedily, largest piece first. Then its smallest piece is
replaced by two unpacked pieces that fit the gap so widened more tightly, as
long as there are such. Only the number of pieces of each length matters for
that, so bins are planned on the counts per length (as many as a sequence has
tokens), equal bins at once; pieces are then dealt to the places by their rank
within their length.
"""

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlive.llm.common import numbered, parts_for, saved
from matchlive.llm.tokens import VOCABULARY, cut

SEQUENCE_TOKENS = 4096


class Bins(NamedTuple):
    """``times`` bins alike: for each length how many pieces a bin has."""

    times: int
    lengths: dict[int, int]


def two_for(available: np.ndarray, counts: np.ndarray, room: int, more_than: int) -> tuple[int, int] | None:
    """Two available pieces whose sum is the largest up to ``room``, if over ``more_than``."""
    best, pair = more_than, None
    at = np.searchsorted(available, room - available, "right") - 1
    at = np.minimum(at, np.arange(len(available)))  # the second is no longer than the first
    alone = (at == np.arange(len(available))) & (counts[available] < 2)
    at = np.where(alone, at - 1, at)
    sums = np.where(at >= 0, available + available[np.maximum(at, 0)], 0)
    if len(sums) and (top := int(sums.argmax())) >= 0 and sums[top] > best:
        pair = int(available[top]), int(available[at[top]])
    return pair


def plan(counts: Sequence[int], most: int) -> list[Bins]:
    """Bins for ``counts[length]`` pieces of each length up to ``most``."""
    left = np.array(counts, np.int64)
    out = []
    available = np.flatnonzero(left)
    while len(available):
        lengths: dict[int, int] = {}
        gap, place = most, len(available) - 1
        while place >= 0 and gap:
            length = int(available[place])
            if fit := min(int(left[length]), gap // length):
                lengths[length] = fit
                left[length] -= fit
                gap -= fit * length
            place = min(place, int(np.searchsorted(available, gap, "right"))) - 1
        while gap and sum(lengths.values()) > 1:
            smallest = min(lengths)
            pair = two_for(np.flatnonzero(left), left, gap + smallest, smallest)
            if pair is None:
                break
            left[smallest] += 1
            lengths[smallest] -= 1
            gap += smallest
            for length in pair:
                left[length] -= 1
                lengths[length] = lengths.get(length, 0) + 1
                gap -= length
            lengths = {length: fit for length, fit in lengths.items() if fit}
        more = min(int(left[length]) // fit for length, fit in lengths.items())
        for length, fit in lengths.items():
            left[length] -= more * fit
        out.append(Bins(1 + more, lengths))
        available = np.flatnonzero(left)
    return out


def places(bins: Sequence[Bins]) -> pd.DataFrame:
    """For each length, runs of ranks and where they lie: first rank, pieces a bin, first bin, offset."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for times, lengths in bins:
        offset = 0
        for length in sorted(lengths, reverse=True):
            rank = used.get(length, 0)
            rows.append((length, rank, lengths[length], first, offset))
            used[length] = rank + times * lengths[length]
            offset += length * lengths[length]
        first += times
    return pd.DataFrame(rows, columns=["length", "rank", "each", "first", "offset"], dtype="int64")


def placed(pieces: DataFrame, most: int = SEQUENCE_TOKENS) -> DataFrame:
    """Adds sequence_id and offset to saved rows of (doc_id, piece, length, ...).

    Ties between pieces of one length are settled by a hash of doc_id and piece;
    repeated rows get different places.
    """
    rows = pieces.groupBy("length").count().collect()  # at most one row per length up to ``most``
    counts = np.zeros(most + 1, np.int64)
    for length, count in rows:
        counts[length] = count
    runs = places(plan(counts, most)).sort_values(["length", "rank"])
    shift = np.int64(1) << 48
    start = (runs["length"] * shift + runs["rank"]).to_numpy(np.int64)
    rank, each, first, offset = (runs[name].to_numpy(np.int64) for name in ("rank", "each", "first", "offset"))

    def deal(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for length, number in frames:
            own = length.to_numpy(np.int64), number.to_numpy(np.int64)
            at = np.searchsorted(start, own[0] * shift + own[1], "right") - 1
            inside = own[1] - rank[at]
            yield pd.DataFrame(
                {
                    "sequence_id": first[at] + inside // each[at],
                    "offset": offset[at] + inside % each[at] * own[0],
                }
            )

    where = F.pandas_udf(deal, "sequence_id long, offset long")
    order = [F.col("doc_id"), F.col("piece")]
    ranked = numbered(pieces, ["length"], order, parts_for(int(counts.sum())), "__rank")
    return ranked.withColumn("__place", where("length", "__rank")).select(
        *pieces.columns, F.col("__place.sequence_id"), F.col("__place.offset")
    )


def pack(
    documents: DataFrame, most: int = SEQUENCE_TOKENS, path: str = VOCABULARY, ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset) of all documents.

    Null and empty texts are one piece, the end mark. Rows repeated with one id,
    and rows without an id, are packed each; extra columns are left out; no
    documents give no rows.
    """
    return placed(saved(cut(documents, most, path, ids=ids), "pack-pieces"), most)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the token ids of each sequence, from pieces packed with ``ids``."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # bounded by the sequence's tokens
    joined = F.aggregate(inside, F.lit(b""), lambda data, piece: F.concat(data, piece["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
