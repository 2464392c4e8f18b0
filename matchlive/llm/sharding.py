"""Histogram sort: splitters found by counting bytes below candidate keys, then one exchange.

Documents are ordered by a 64-bit key: a hash of the text, its last 20 bits
replaced by a hash of the id, so that equal texts lie side by side. Rounds of
probes count the exact bytes below candidate boundaries over all partitions and
narrow each splitter down until it is within tolerance of its target; no key
passes through the driver, only counts per probe. Candidates lie between groups
of equal texts as long as that is precise enough; only a group that would put a
shard off by more than the wider tolerance is split.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlive.llm.common import saved, text_of
from matchlive.workspace import new_run_dir

SHARDS = 40
ROW_BYTES = 16
#: A splitter may be off by this part of a shard, and by so much more to keep equal texts together.
TOLERANCE, GROUP_TOLERANCE = 0.01, 0.04
#: Shards are sorted in parts of about so many bytes, four at least; a part is larger where that is more than
#: the driver should hold keys for, and spills like any sort.
PART_BYTES, MOST_PARTS = 64 << 20, 8192
PROBES = 16
GROUP_BITS = 20
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def size_of(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 16."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def sort_key() -> Column:
    group = F.shiftleft(F.shiftright(F.xxhash64(text_of("text")), GROUP_BITS), GROUP_BITS)
    return group.bitwiseOR(F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - GROUP_BITS))


class Counts(NamedTuple):
    """Bytes and rows whose key is below each probe, and in all."""

    bytes: np.ndarray
    rows: np.ndarray


def counts_below(keys: DataFrame, probes: np.ndarray) -> Counts:
    """``keys`` has key and size; each task adds up its rows between neighbouring probes."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(probes) + 1), np.int64)
        for batch in batches:
            at = np.searchsorted(probes, batch.column("key").to_numpy(), "right")
            np.add.at(sums[0], at, batch.column("size").to_numpy())
            np.add.at(sums[1], at, 1)
        at = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_pydict({"at": at, "bytes": sums[0][at], "rows": sums[1][at]})

    parts = keys.select("key", "size").mapInArrow(add_up, "at long, bytes long, rows long")
    sums = np.zeros((2, len(probes) + 1), np.int64)
    for at, size, rows in parts.groupBy("at").agg(F.sum("bytes"), F.sum("rows")).collect():
        sums[:, at] = size, rows
    return Counts(*np.cumsum(sums, axis=1))


class Edge(NamedTuple):
    """A key with the bytes and rows below it."""

    key: int
    bytes: int
    rows: int


def between(low: Edge, high: Edge) -> list[int]:
    """Candidate keys inside an interval, between groups of equal texts while it holds several."""
    width = high.key - low.key
    unit = 1 << GROUP_BITS if width > 1 << GROUP_BITS else 1
    found = {-(-(low.key + width * step // PROBES) // unit) * unit for step in range(1, PROBES)}
    return [key for key in found if low.key < key < high.key]


def parts_of(total: int, shards: int) -> int:
    """Parts of a shard for so many bytes in all; the keys on the driver are bounded by MOST_PARTS, not by the rows."""
    return max(4, min(-(-total // (shards * PART_BYTES)), MOST_PARTS // shards))


def splitters(keys: DataFrame, shards: int, parts: int, tolerance: float = TOLERANCE) -> np.ndarray:
    """Keys that cut the rows into shards * parts runs; every ``parts``-th is exact to ``tolerance``."""
    count = shards * parts
    grid = np.array([LOWEST + (step << 64) // (8 * count) for step in range(1, 8 * count)], np.int64)
    below = counts_below(keys, grid)
    total, rows = int(below.bytes[-1]), int(below.rows[-1])
    targets = [total * step / count for step in range(1, count)]
    allowed = [tolerance * total / shards if step % parts == 0 else 0.1 * total / count for step in range(1, count)]
    known = [Edge(LOWEST, 0, 0)]
    known += [Edge(int(k), int(b), int(r)) for k, b, r in zip(grid, below.bytes, below.rows, strict=False)]
    known.append(Edge(HIGHEST, total, rows))
    while True:
        sums = np.array([edge.bytes for edge in known])
        chosen, probes = [], set()
        for target, off in zip(targets, allowed, strict=True):
            at = max(1, int(np.searchsorted(sums, target, "left")))
            low, high = known[at - 1], known[min(at, len(known) - 1)]
            best = low if target - low.bytes < high.bytes - target else high
            chosen.append(best.key)
            alone = low.key >> GROUP_BITS == (high.key - 1) >> GROUP_BITS  # nothing but one group in between
            most = max(off, GROUP_TOLERANCE * total / shards) if alone else off
            if abs(best.bytes - target) > most and high.rows - low.rows > 1:
                probes.update(between(low, high))
        if not probes:
            return np.maximum.accumulate(np.array(chosen, np.int64))
        fresh = np.array(sorted(probes), np.int64)
        below = counts_below(keys, fresh)
        known += [Edge(int(k), int(b), int(r)) for k, b, r in zip(fresh, below.bytes, below.rows, strict=False)]
        known.sort()


def write_shards(documents: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Writes the documents as one folder a shard and reads them back: doc_id, text, shard, slot.

    Shards have equally many bytes within the tolerance and the size of a
    document; slots count from 0 in key order. A null text stays null and counts
    as empty for the order. Rows repeated with one id and text stay together, as
    nothing tells them apart, and so do rows of one text without an id; extra
    columns are left out; no documents give no rows.
    """
    keys = saved(documents.select(sort_key().alias("key"), size_of().alias("size")), "shard-keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    parts = parts_of(total, shards)
    bounds = splitters(keys, shards, parts, tolerance)
    below = counts_below(keys, bounds).rows[:-1]
    starts = np.concatenate(([0], below))
    starts -= np.repeat(starts[::parts], parts)

    def part_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(), "right").astype(np.int32))

    def start_of(part: pd.Series) -> pd.Series:
        return pd.Series(starts[part.to_numpy()])

    part = F.pandas_udf(part_of, "int")("key")
    rows = documents.select("doc_id", "text", sort_key().alias("key")).withColumn("part", part)
    dealt = rows.withColumn("shard", F.expr(f"part div {parts}").cast("int")).repartition("shard", "part")
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("key", "doc_id")) - 1
    slots = dealt.withColumn("inside", inside).withColumn("start", F.pandas_udf(start_of, "long")("part"))
    placed = slots.select("doc_id", "text", (F.col("start") + F.col("inside")).alias("slot"), "shard")
    path = new_run_dir(documents.sparkSession, "shards")
    placed.write.partitionBy("shard").parquet(path)
    return documents.sparkSession.read.schema(placed.schema).parquet(path)
