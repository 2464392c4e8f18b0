"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints within ``distance`` bits agree to within t_i bits in some partition
i, for any thresholds with sum(t_i + 1) = distance + 1. Bits that go together are
put into one partition; a dynamic programme over groups of bits picks the
partitions and their thresholds by the number of candidates it expects, from
counts over all fingerprints. Partitions are probed by an equi-join of masked
values, and candidates verified on all bits.
"""

import math
from collections.abc import Iterator, Sequence
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlive.llm.common import Carried, saved, small_batches, text_of
from matchlive.llm.components import components, forest
from matchlive.llm.tiles import tiled
from matchlive.llm.words import Words, chunks

SHINGLE_WORDS = 3
DISTANCE = 2
SEED = 42
BITS = 64
GROUP_BITS = 4
#: Rows of one masked value compared in one task.
TILE_ROWS = 1024


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle, A-Z in lower case, and where each document's begin."""
    data, begin = words.spaced(np.ones(len(words.start), bool))
    flat = np.frombuffer(data, np.uint8)
    data = np.where((flat >= 65) & (flat <= 90), flat + 32, flat).astype(np.uint8).tobytes()
    length = words.end - words.start + 1
    end = np.cumsum(length) - 1
    start = end - length + 1
    count = np.diff(words.first)
    shingles = np.where(count > 0, np.maximum(count - size + 1, 1), 0)
    first = np.concatenate(([0], np.cumsum(shingles)))
    inside = np.arange(first[-1]) - np.repeat(first[:-1], shingles)
    word = np.repeat(words.first[:-1], shingles) + inside
    last = np.minimum(word + size - 1, np.repeat(words.first[1:], shingles) - 1)
    digest = xxhash.xxh64_intdigest
    pairs = zip(start[word].tolist(), end[last].tolist(), strict=True)
    return np.array([digest(data[a:b], SEED) for a, b in pairs], np.uint64), first


def majority_bits(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per document the bits set in over half of its hashes; zero without hashes."""
    count = np.diff(first)
    out = np.zeros(len(count), np.uint64)
    used = np.flatnonzero(count)
    if len(used):
        ones = np.zeros((len(used), BITS), np.int64)
        step = 1 << 16
        for low in range(0, len(hashes), step):
            part = hashes[low : low + step]
            bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            begin = np.clip(first[used] - low, 0, len(part))
            over = np.clip(first[used + 1] - low, 0, len(part))
            touched = np.flatnonzero(over > begin)
            ones[touched] += np.add.reduceat(bits, begin[touched], axis=0, dtype=np.int32)
        most = 2 * ones > count[used][:, None]
        out[used] = np.packbits(most, axis=1, bitorder="little").view("<u8").ravel()
    return out


#: Tell rows of different ids or texts apart.
ROW_KEYS = ("row_1", "row_2")


def fingerprints(documents: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint as signed 64-bit number, ROW_KEYS) of every whole text."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [majority_bits(*shingle_hashes(words, size)) for _, _, words in chunks(batch.column("text"))]
            if parts:
                values = pa.array(np.concatenate(parts).view(np.int64))
                own = {name: batch.column(name) for name in ("doc_id", *ROW_KEYS)}
                yield pa.RecordBatch.from_pydict({"doc_id": own.pop("doc_id"), "fingerprint": values} | own)

    rows = small_batches(documents).select("doc_id", text_of("text").alias("text"), *row_keys("doc_id", "text"))
    return rows.mapInArrow(digest, f"doc_id {kind}, fingerprint long, " + ", ".join(f"{name} long" for name in ROW_KEYS))


def row_keys(doc_id: str, text: str) -> list[Column]:
    """A null id differs from all others, a null text does not from an empty one."""
    known = F.col(doc_id).isNotNull()
    return [F.xxhash64(F.lit(name), known, doc_id, text_of(text)).alias(name) for name in ROW_KEYS]


class Part(NamedTuple):
    """Bits of a partition and how many of them may differ."""

    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return sum(1 << bit for bit in self.bits)


def bit_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often bits i and j are set together, of a task's fingerprints."""
    sums = np.zeros((BITS, BITS))
    for batch in batches:
        values = batch.column(0).to_numpy().view(np.uint64)
        bits = (values[:, None] >> np.arange(BITS, dtype=np.uint64) & np.uint64(1)).astype(np.float64)
        sums += bits.T @ bits
    cell = np.arange(BITS * BITS)
    yield pa.RecordBatch.from_pydict({"cell": cell, "together": sums.ravel().astype(np.int64)})


def grouped_bits(together: np.ndarray, count: int) -> list[tuple[int, ...]]:
    """Groups of GROUP_BITS bits, correlated ones together; groups most alike are neighbours."""
    share = together / max(count, 1)
    mean = np.diag(share)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    alike = np.abs(share - np.outer(mean, mean)) / np.outer(spread, spread)
    left, groups = list(range(BITS)), []
    while left:
        before = groups[-1] if groups else ()
        near = alike[np.ix_(left, before)].sum(1) if before else alike[np.ix_(left, left)].sum(1)
        group = [left.pop(int(near.argmax()))]
        while len(group) < GROUP_BITS:
            group.append(left.pop(int(alike[np.ix_(left, group)].sum(1).argmax())))
        groups.append(tuple(sorted(group)))
    return groups


def distance_shares(histogram: np.ndarray) -> np.ndarray:
    """Of random pairs, the share that differs in 0, 1, ... bits of a group, from counts per value."""
    share = histogram / max(histogram.sum(), 1)
    values = np.arange(len(histogram))
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    return np.bincount(apart.ravel(), weights=np.outer(share, share).ravel(), minlength=GROUP_BITS + 1)


def allocate(groups: Sequence[tuple[int, ...]], shares: Sequence[np.ndarray], count: int, distance: int) -> list[Part]:
    """Partitions of neighbouring groups and thresholds with the fewest expected candidates and probes.

    ``best[g][used]`` covers the first g groups with sum(t_i + 1) = used. A
    partition with threshold -1 is not probed.
    """
    pairs = count * (count - 1) / 2
    best: list[dict[int, tuple[float, list[Part]]]] = [{0: (0.0, [])}]
    for end in range(1, len(groups) + 1):
        best.append({})
        for begin in range(end):
            bits = tuple(sorted(bit for group in groups[begin:end] for bit in group))
            near = np.ones(1)
            for share in shares[begin:end]:
                near = np.convolve(near, share)[: distance + 1]
            for threshold in range(-1, distance + 1):
                probes = sum(math.comb(len(bits), flips) for flips in range(threshold + 1))
                cost = pairs * near[: threshold + 1].sum() + count * probes
                for used, (so_far, parts) in best[begin].items():
                    now = used + threshold + 1
                    if now <= distance + 1 and so_far + cost < best[end].get(now, (math.inf,))[0]:
                        best[end][now] = so_far + cost, [*parts, Part(bits, threshold)]
    return [part for part in best[-1][distance + 1][1] if part.threshold >= 0]


def partitions(distinct: DataFrame, distance: int) -> list[Part]:
    """Partitions for the ``fingerprint`` column; 64 x 64 and 16 x 16 counts go through the driver."""
    sums = distinct.select("fingerprint").mapInArrow(bit_table, "cell long, together long")
    table = np.zeros(BITS * BITS)
    for cell, value in sums.groupBy("cell").agg(F.sum("together")).collect():
        table[cell] = value
    count = distinct.count()
    groups = grouped_bits(table.reshape(BITS, BITS), count)

    def values(bits: tuple[int, ...]):
        each = [f"((shiftrightunsigned(fingerprint, {bit}) & 1) << {place})" for place, bit in enumerate(bits)]
        return F.expr(" + ".join(each)).cast("int")

    wide = distinct.select(*[values(bits).alias(f"g{number}") for number, bits in enumerate(groups)])
    histograms = np.zeros((len(groups), 1 << GROUP_BITS))
    stacked = F.explode(F.array(*[F.struct(F.lit(i).alias("g"), F.col(f"g{i}").alias("v")) for i in range(len(groups))]))
    for number, value, times in wide.select(stacked.alias("x")).groupBy("x.g", "x.v").count().collect():
        histograms[number, value] = times
    return allocate(groups, [distance_shares(row) for row in histograms], count, distance)


def flips(part: Part) -> list[int]:
    """Masks that change at most ``threshold`` bits of the partition, none first."""
    return [sum(1 << bit for bit in some) for size in range(part.threshold + 1) for some in combinations(part.bits, size)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def probes(distinct: DataFrame, parts: Sequence[Part]) -> DataFrame:
    """(part, value, flip, fingerprint, first): every masked value, and its variants as probes."""
    found = []
    for number, part in enumerate(parts):
        masked = F.col("fingerprint").bitwiseAND(F.lit(signed(part.mask)))
        variants = F.explode(F.array(*[F.lit(signed(mask)) for mask in flips(part)]))
        rows = distinct.select("fingerprint", "first", masked.alias("value"), variants.alias("flip"))
        found.append(rows.select(F.lit(number).alias("part"), F.col("value").bitwiseXOR(F.col("flip")).alias("value"),
                                 (F.col("flip") != 0).alias("probe"), "fingerprint", "first"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def verifier(distance: int):
    """Of the rows of each tile, sorted, the links between fingerprints within ``distance`` bits."""

    def links(key: np.ndarray, value: np.ndarray, probe: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        root, step = np.arange(len(key)), 1
        open_ = np.arange(len(key))
        while len(open_ := open_[open_ + step < len(key)]):
            open_ = open_[key[open_] == key[open_ + step]]
            near = np.bitwise_count(value[open_] ^ value[open_ + step]) <= distance
            pair = open_[near & ~(probe[open_] & probe[open_ + step])]
            root = forest(len(key), pair, pair + step, root)
            step += 1
        moved = np.flatnonzero(root != np.arange(len(key)))
        return pa.RecordBatch.from_pydict({"a": node[moved], "b": node[root[moved]]})

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            names = ("tile", "fingerprint", "probe", "first")
            columns = [batch.column(name).to_numpy(zero_copy_only=False) for name in names]
            if kept is not None:
                columns = [np.concatenate(pair) for pair in zip(kept, columns, strict=True)]
            cut = int(np.searchsorted(columns[0], columns[0][-1]))  # the last tile may go on in the next batch
            kept = [column[cut:] for column in columns]
            key, value, probe, node = (column[:cut] for column in columns)
            if cut:
                yield links(key, value.view(np.uint64), probe.astype(bool), node)
        if kept is not None:
            key, value, probe, node = kept
            yield links(key, value.astype(np.int64).view(np.uint64), probe.astype(bool), node)

    return verify


def near_duplicates(documents: DataFrame, distance: int = DISTANCE, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of all documents.

    A shingle is ``size`` words in a row, A-Z in lower case; fewer words make one
    shingle. Null and empty texts have fingerprint zero and link like others.
    component_id is the smallest doc_id reachable over links of at most
    ``distance`` differing bits. Rows repeated with one id appear as often; extra
    columns are left out. A null doc_id never is a component's id unless all of
    its members are null. Needs integer ids.
    """
    return grouped(documents, distance, size).select("doc_id", "fingerprint", "component_id")


def grouped(documents: DataFrame, distance: int, size: int) -> DataFrame:
    """(doc_id, fingerprint, ROW_KEYS, component_id, root); root is a fingerprint of the group, and only of this group."""
    marked = saved(fingerprints(documents, size), "fingerprints")
    distinct = saved(marked.groupBy("fingerprint").agg(F.min("doc_id").cast("long").alias("first")), "distinct")
    if distinct.isEmpty():
        return marked.select("*", F.col("doc_id").cast("long").alias("component_id"), F.col("fingerprint").alias("root"))
    # fingerprints are the nodes: they are distinct and never null
    nodes = distinct.select("fingerprint", F.col("fingerprint").alias("first"))
    rows = probes(nodes, partitions(distinct, distance))
    counts = rows.groupBy("part", "value").count().where("count > 1")
    shared = rows.join(counts.select("part", "value"), ["part", "value"])
    tiles = tiled(shared, ["part", "value"], "fingerprint", TILE_ROWS, counts)
    tile = F.xxhash64("part", "value", "tile_i", "tile_j").alias("tile")
    dealt = tiles.select(tile, "fingerprint", "probe", "first").repartition("tile").sortWithinPartitions("tile")
    links = dealt.mapInArrow(verifier(distance), "a long, b long")
    found = components(links)
    root = F.coalesce("component", "fingerprint").alias("root")
    rooted = saved(distinct.join(found, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", "first", root), "rooted")
    lowest = saved(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "component-ids")
    named = rooted.drop("first").join(lowest, "root")
    return marked.join(named, "fingerprint").select(*marked.columns, "component_id", "root")


def survivors(documents: DataFrame, distance: int = DISTANCE, size: int = SHINGLE_WORDS) -> DataFrame:
    """One document of each group, with its columns: that whose id names the group.

    Rows that share an id but not a group are documents of their own. Of rows
    repeated with the id that names a group one stays. Rows without an id are in
    groups like others; one of them stays where no row of the group has an id.
    """
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "fingerprint", *ROW_KEYS)
    groups = grouped(documents, distance, size).groupBy("root").agg(F.min(order).alias("chosen"))
    chosen = saved(groups.select(*[f"chosen.{name}" for name in ROW_KEYS]), "survivors")
    whole = Carried(documents)
    rows = documents.select(*whole.columns, *row_keys("doc_id", "text"))
    kept = rows.join(chosen, list(ROW_KEYS), "left_semi").dropDuplicates(list(ROW_KEYS))
    return whole.restored(kept).select(documents.columns)
