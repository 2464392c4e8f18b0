"""Removes passages that an earlier document has, found by fixed-block anchors.

Every document is cut into non-overlapping reference blocks of half a window. A
window holds a whole block of any document it is equal to, so probing the blocks
with every rolling run of that length finds all repeats. Hits are extended on
the text: the windows around them are compared whole, and what equal windows of
a smaller doc_id cover is removed.

Blocks and probes travel as packs: all those of one task and one hash bucket in
one row, hashes cut to what the bucket leaves open. A task takes a bucket's
references first, one per hash, and then its probes one pack after the other, so
a passage that many documents share is neither a group in memory nor a pair per
two documents. Probes are counted per bucket beforehand: those of a large bucket
are dealt over several tasks by their document, and its references go to each.
"""

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlive.llm.common import Carried, saved, small_batches, text_of
from matchlive.llm.words import Words, chunks, mix, windows

WINDOW = 50
#: Text bytes per hash bucket, and the most buckets.
BUCKET_BYTES = 8 << 20
MOST_BUCKETS = 1 << 16
#: A bucket with more than so many times the mean number of probes is split.
EVEN = 2
#: Positions a task gathers before it writes its packs.
GATHERED = 500_000
#: Up to so many document ids are broadcast to pick out documents (16 MB); more are joined by shuffles.
BROADCAST_IDS = 2_000_000
#: Hash bytes that go with a probe for candidates, and with a window for the comparison.
PROBE_BYTES, WINDOW_BYTES = 5, 8
#: Word numbers are below 2 ** WORD_BITS; in the comparison a mark of the text stands above them.
WORD_BITS = 31

PACK = "bucket int, kind int, docs binary, first binary, hashes binary, places binary"


class Places(NamedTuple):
    """Hashes of runs of words, each with its document and the number of its first word."""

    hash: np.ndarray
    doc: np.ndarray
    word: np.ndarray


#: References and probes of the texts of a batch.
PlacesOf = Callable[[pa.RecordBatch], Iterator[tuple[Places, Places]]]


def joined(parts: list[Places]) -> Places:
    return Places(*(np.concatenate(columns) for columns in zip(*parts, strict=True)))


def planes(values: np.ndarray, width: int) -> bytes:
    """Differences of neighbours, byte by byte, so that small ones of either sign compress to little."""
    step = np.diff(values.astype(np.int64), prepend=np.int64(0))
    folded = ((step << 1) ^ (step >> 63)).astype("<u8")
    return np.ascontiguousarray(folded.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    raw = np.zeros((len(data) // width, 8), np.uint8)
    raw[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    folded = raw.view("<u8").ravel()
    return np.cumsum((folded >> np.uint64(1)).astype(np.int64) ^ -(folded & np.uint64(1)).astype(np.int64))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(hashes) >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


class Spread(NamedTuple):
    """Over how many parts the probes of each bucket are dealt, and the number of its first part."""

    splits: np.ndarray
    offset: np.ndarray

    def parts(self, places: Places, kind: int) -> tuple[Places, np.ndarray]:
        """The places with the number of their part; references (kind 0) once for each part."""
        bucket = bucket_of(places.hash, len(self.splits))
        splits = self.splits[bucket]
        if kind:
            part = (mix(places.doc.astype(np.uint64)) % splits.astype(np.uint64)).astype(np.int64)
            return places, self.offset[bucket] + part
        part = np.arange(splits.sum()) - np.repeat(np.cumsum(splits) - splits, splits)
        return Places(*(np.repeat(column, splits) for column in places)), np.repeat(self.offset[bucket], splits) + part


def packs(places: Places, kind: int, spread: Spread, width: int) -> pa.RecordBatch:
    """Rows (see PACK), one a part of a bucket: for each document how many entries, for each entry hash and word."""
    places, bucket = spread.parts(places, kind)
    order = np.lexsort((places.word, places.doc, bucket))
    bucket, hashes = bucket[order].astype(np.int32), places.hash[order]
    doc, word = places.doc[order], places.word[order]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    rows = {"bucket": bucket[cuts], "kind": np.full(len(cuts), kind, np.int32)}
    columns: dict[str, list[bytes]] = {"docs": [], "first": [], "hashes": [], "places": []}
    for low, high in zip(cuts, [*cuts[1:], len(bucket)], strict=True):
        first = np.flatnonzero(np.diff(doc[low:high], prepend=doc[low] - 1))
        columns["docs"].append(planes(doc[low:high][first], 8))
        columns["first"].append(planes(first, 4))
        raw = hashes[low:high].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        columns["hashes"].append(np.ascontiguousarray(raw).tobytes())
        columns["places"].append(planes(word[low:high], 8))
    return pa.RecordBatch.from_pydict(rows | {k: pa.array(v, pa.binary()) for k, v in columns.items()})


def unpacked(row: dict[str, bytes], width: int) -> Places:
    word = from_planes(row["places"], 8)
    raw = np.zeros((len(word), 8), np.uint8)
    raw[:, :width] = np.frombuffer(row["hashes"], np.uint8).reshape(-1, width)
    docs = from_planes(row["docs"], 8)
    first = from_planes(row["first"], 4)
    return Places(raw.view("<u8").ravel(), np.repeat(docs, np.diff(first, append=len(word))), word)


def first_holders(places: Places, each_word: bool) -> Places:
    """Per hash the entries of the smallest document, or just one of them."""
    order = np.lexsort((places.word, places.doc, places.hash))
    hashes, doc, word = (column[order] for column in places)
    new = np.diff(hashes, prepend=hashes[:1] ^ np.uint64(1)) != 0
    if each_word:
        begin = np.flatnonzero(new)
        new = doc == np.repeat(doc[begin], np.diff(begin, append=len(hashes)))
    return Places(hashes[new], doc[new], word[new])


def resolver(width: int, references: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Answers a bucket's probes: (doc, word) of those that a smaller document has.

    With ``references`` also the places of the reference itself, once it is hit.
    """

    def answers(doc: np.ndarray, word: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"doc_id": pa.array(doc, pa.int64()), "word": pa.array(word, pa.int64())})

    def close(index: Places | None, hit: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        if references and index is not None and hit is not None and hit.any():
            yield answers(index.doc[hit], index.word[hit])

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, index, hit, gathered, size = None, None, None, [], 0
        for batch in batches:
            for at_row in range(batch.num_rows):
                row = {name: batch.column(name)[at_row].as_py() for name in batch.schema.names}
                if row["bucket"] != bucket:
                    yield from close(index, hit)
                    bucket, index, hit, gathered, size = row["bucket"], None, None, [], 0
                found = unpacked(row, width)
                if row["kind"] == 0:
                    gathered.append(found)
                    size += len(found.hash)
                    if size > GATHERED:
                        gathered = [first_holders(joined(gathered), references)]
                        size = len(gathered[0].hash) // 2
                    continue
                if index is None and not gathered:
                    continue
                if index is None:
                    index = first_holders(joined(gathered), references)
                    unique = np.flatnonzero(np.diff(index.hash, prepend=index.hash[:1] ^ np.uint64(1)))
                    keys, holder = index.hash[unique], index.doc[unique]
                    reach = np.diff(unique, append=len(index.hash))
                    hit, gathered = np.zeros(len(index.hash), bool), []
                at = np.minimum(np.searchsorted(keys, found.hash), len(keys) - 1)
                later = (keys[at] == found.hash) & (holder[at] < found.doc)
                if later.any():
                    if references:
                        asked = np.zeros(len(keys), bool)
                        asked[at[later]] = True
                        hit |= np.repeat(asked, reach)
                    yield answers(found.doc[later], found.word[later])
        yield from close(index, hit)

    return resolve


def exchanged(sent: DataFrame, parts: int, width: int, references: bool) -> DataFrame:
    """(doc_id, word) of the probes answered, a task for each part, references first."""
    dealt = sent.repartitionById(parts, "bucket").sortWithinPartitions("bucket", "kind")
    return dealt.mapInArrow(resolver(width, references), "doc_id long, word long")


def spread_over(rows: DataFrame, places_of: PlacesOf, buckets: int) -> Spread:
    """Counts all probes per bucket; what the driver gets is a number a bucket, MOST_BUCKETS at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, probes in places_of(batch):
                found += np.bincount(bucket_of(probes.hash, buckets), minlength=buckets)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"bucket": at, "entries": found[at]})

    counted = rows.mapInArrow(count, "bucket long, entries long").groupBy("bucket").agg(F.sum("entries"))
    entries = np.zeros(buckets, np.int64)
    for bucket, number in counted.collect():
        entries[bucket] = number
    splits = np.maximum(1, np.ceil(entries / max(1.0, EVEN * entries.mean()))).astype(np.int64)
    return Spread(splits, np.cumsum(splits) - splits)


def gatherer(
    places_of: PlacesOf, spread: Spread, width: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packs what ``places_of`` finds in a task's batches: (references, probes)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[Places, Places]] = []
        size = 0
        for batch in batches:
            for found in places_of(batch):
                kept.append(found)
                size += len(found[1].hash)
                if size >= GATHERED:
                    yield from write(kept)
                    kept, size = [], 0
        if size:
            yield from write(kept)

    def write(kept: list[tuple[Places, Places]]) -> Iterator[pa.RecordBatch]:
        references = first_holders(joined([pair[0] for pair in kept]), True)
        if len(references.hash):
            yield packs(references, 0, spread, width)
        yield packs(joined([pair[1] for pair in kept]), 1, spread, width)

    return gather


def packed(rows: DataFrame, places_of: PlacesOf, buckets: int, width: int) -> tuple[DataFrame, int]:
    """The packs, and the number of parts their buckets are cut into."""
    spread = spread_over(rows, places_of, buckets)
    return rows.mapInArrow(gatherer(places_of, spread, width), PACK), int(spread.splits.sum())


def anchors(batch: pa.RecordBatch, block: int, window: int) -> Iterator[tuple[Places, Places]]:
    """Reference blocks and rolling runs of the documents that are long enough for a window."""
    ids = batch.column("doc_id").to_numpy()
    for low, high, words in chunks(batch.column("text")):
        count = np.diff(words.first)
        if not (count >= window).any():
            continue
        runs = windows(words.hashes(), block)
        doc = words.documents()[: len(runs)]
        word = np.arange(len(runs)) - words.first[doc]
        use = (word + block <= count[doc]) & (count[doc] >= window)
        probes = Places(runs[use], ids[low:high][doc[use]], word[use])
        fixed = probes.word % block == 0
        yield Places(*(column[fixed] for column in probes)), probes


def around(batch: pa.RecordBatch, block: int, window: int) -> Iterator[tuple[Places, Places]]:
    """The windows that hold a hit, as references (one per hash) and as probes."""
    ids, hits, mark = batch.column("doc_id").to_numpy(), batch.column("hits"), batch.column("mark").to_numpy()
    for low, high, words in chunks(batch.column("text")):
        full = windows(words.hashes(), window)
        count = np.diff(words.first)
        near = np.zeros(len(full) + 1, np.int64)
        for at in range(low, high):
            if count[at - low] < window:
                continue
            hit = hits[at].values.to_numpy()
            begin = np.maximum(hit - (window - block), 0)
            end = np.minimum(hit, count[at - low] - window) + 1
            begin, end = begin[begin < end], end[begin < end]
            np.add.at(near, words.first[at - low] + begin, 1)
            np.add.at(near, words.first[at - low] + end, -1)
        place = np.flatnonzero(np.cumsum(near)[:-1] > 0)
        doc = words.documents()[place] if len(place) else place
        found = Places(full[place], ids[low:high][doc], (mark[low:high][doc] << WORD_BITS) + place - words.first[doc])
        yield first_holders(found, False), found


def repeated_windows(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, mark, word): starts of windows whose words a document with a smaller doc_id has too.

    The mark tells texts of one id apart. Equality is that of 64-bit hashes with
    a bucket besides.
    """
    block = window // 2
    rows = small_batches(documents).select("doc_id", text_of("text").alias("text")).where("doc_id IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(min(MOST_BUCKETS, max(64, total // BUCKET_BYTES)))
    first, parts = packed(rows, lambda batch: anchors(batch, block, window), buckets, PROBE_BYTES)
    hits = saved(exchanged(first, parts, PROBE_BYTES, True), "anchor-hits")
    by_doc = hits.groupBy("doc_id").agg(F.collect_set("word").alias("hits"))
    near = only(rows, hits.select("doc_id").distinct()).join(by_doc, "doc_id")
    marked = near.select("doc_id", "text", "hits", mark_of("text"))
    second, parts = packed(marked, lambda batch: around(batch, block, window), buckets, WINDOW_BYTES)
    found = exchanged(second, parts, WINDOW_BYTES, False)
    word = F.col("word").bitwiseAND((1 << WORD_BITS) - 1).cast("int").alias("word")
    return found.select("doc_id", F.shiftright("word", WORD_BITS).alias("mark"), word)


def mark_of(text: str | Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(1 << WORD_BITS)).alias("mark")


def only(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Drops rows of other documents ahead of a join, where the ids are few enough to broadcast."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids), "doc_id", "left_semi") if few else rows


def kept_words(words: Words, starts: pa.Array, window: int) -> np.ndarray:
    """Which words no repeated window covers."""
    near = np.zeros(len(words.start) + 1, np.int64)
    for at in range(len(words.first) - 1):
        begin = starts[at].values
        if begin is not None and len(begin):
            begin = begin.to_numpy() + words.first[at]
            np.add.at(near, begin, 1)
            np.add.at(near, np.minimum(begin + window, words.first[at + 1]), -1)
    return np.cumsum(near)[:-1] == 0


def without_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text): what is left of every document.

    A word goes if a window of ``window`` words covers it whose words also start
    in a document with a smaller doc_id; all is judged on the input. The words
    left are joined by one space. Null text has no words; documents shorter than
    a window lose none; rows repeated with one id do not count as two documents;
    a null doc_id neither loses nor takes words. Extra columns are left out. Ids are integers.
    """
    ids = Carried(documents.select("doc_id"))
    return _with_kept_text(documents, window, ids).withColumnRenamed(ids["doc_id"], "doc_id")


def removed_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with all their columns; texts that lose words are replaced, and n_chars with them."""
    whole = Carried(documents)
    found = _with_kept_text(documents, window, whole)
    changed = F.col("n_removed") > 0
    out = found.withColumn(whole["text"], F.when(changed, F.col("kept_text")).otherwise(F.col(whole["text"])))
    if "n_chars" in whole.names:
        kind = documents.schema["n_chars"].dataType
        length = F.when(changed, F.length("kept_text").cast(kind)).otherwise(F.col(whole["n_chars"]))
        out = out.withColumn(whole["n_chars"], length)
    return whole.restored(out)


def _with_kept_text(documents: DataFrame, window: int, carried: Carried) -> DataFrame:
    text, own = carried["text"] if "text" in carried.names else "text", carried.own
    read = [F.col("text")] if text == "text" else []
    rows = documents.select(*carried.columns, *read, mark_of(text_of("text")))
    id_ = carried["doc_id"]
    found = saved(repeated_windows(documents, window), "repeated-windows")
    starts = found.groupBy(F.col("doc_id").alias(id_), "mark").agg(F.collect_set("word").alias("starts"))
    ids = found.select(F.col("doc_id").alias(id_)).distinct()
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        none = F.lit(None).cast("array<int>").alias("starts")
        clean = rows.join(F.broadcast(ids), id_, "left_anti").select(*rows.columns, none)
        hit = rows.join(F.broadcast(ids), id_, "left_semi").join(starts, [id_, "mark"], "left")
        marked = hit.select(*rows.columns, "starts").unionByName(clean)
    else:
        marked = rows.join(starts, [id_, "mark"], "left").select(*rows.columns, "starts")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in chunks(batch.column(text)):
                part = batch.slice(low, high - low)
                keep = kept_words(words, part.column("starts"), window)
                count = np.diff(words.first)
                left = np.concatenate(([0], np.cumsum(keep)))
                gone = count - (left[words.first[1:]] - left[words.first[:-1]])
                spaced, begin = words.spaced(keep)
                texts = [spaced[a : max(a, b - 1)] for a, b in zip(begin[:-1], begin[1:], strict=True)]
                columns = [part.column(name) for name in own]
                columns += [pa.array(count, pa.int64()), pa.array(gone, pa.int64())]
                columns.append(pa.array(texts, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*own, "n_words", "n_removed", "kept_text"])

    return marked.mapInArrow(remove, f"{carried.schema}, n_words long, n_removed long, kept_text string")
