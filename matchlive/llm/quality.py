"""Quality rules: base counts, and divergence of a document from its language.

Every document is compared with references of its language by the Jensen-Shannon
distance (square root of the divergence in bits, 0 to 1): its histogram of
character classes, and that of the language's most common words with all others
as one. The references are gathered from the corpus itself; short documents,
whose histograms say little, and languages with few documents are not judged.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlive.llm.common import WORD, saved, small_batches, text_of
from matchlive.llm.words import Words, chunks, mix, string_buffers, split, windows

#: Common words per language.
COMMON_WORDS = 40
#: Documents that a language needs for a reference.
REFERENCE_DOCUMENTS = 20
#: Farther from the reference than this is rejected, from so many characters or words on.
CLASS_DISTANCE, CLASS_CHARS = 0.25, 200
WORD_DISTANCE, WORD_WORDS = 0.30, 200

SYMBOLS = b"#*$%&|<>"
LOWER, UPPER, DIGIT, SPACE, SYMBOL, MARK, CONTROL, OTHER, CONTINUATION = range(9)
CLASSES = 8


def byte_classes() -> np.ndarray:
    """Class of the character that a byte begins; bytes after the first of a character have their own."""
    out = np.full(256, CONTROL)
    out[0x21:0x7F] = MARK
    out[ord("a") : ord("z") + 1] = LOWER
    out[ord("A") : ord("Z") + 1] = UPPER
    out[ord("0") : ord("9") + 1] = DIGIT
    out[list(b" \t\n\v\f\r")] = SPACE
    out[list(SYMBOLS)] = SYMBOL
    out[0x80:0xC0] = CONTINUATION
    out[0xC0:] = OTHER
    return out


BYTE_CLASS = byte_classes()

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_chars long, classes array<long>, common array<long>"
)


def class_counts(words: Words) -> np.ndarray:
    """Characters of each class, by document."""
    count = len(words.first) - 1
    document = np.repeat(np.arange(count), np.diff(words.offsets))
    cell = document * (CLASSES + 1) + BYTE_CLASS[words.bytes]
    return np.bincount(cell, minlength=count * (CLASSES + 1)).reshape(count, -1)[:, :CLASSES]


def repeated_words(words: Words, hashes: np.ndarray, size: int = 3) -> np.ndarray:
    """Words in windows found twice or more in their document."""
    runs, document = windows(hashes, size), words.documents()
    inside = np.flatnonzero(document[: len(runs)] == document[size - 1 : size - 1 + len(runs)])
    key = runs[inside] ^ mix(document[inside])
    order = np.argsort(key)
    same = np.flatnonzero(key[order][1:] == key[order][:-1])
    place = inside[order[np.unique(np.concatenate([same, same + 1]))]]
    near = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(near, place, 1)
    np.add.at(near, place + size, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(near)[:-1] > 0)))
    return covered[words.first[1:]] - covered[words.first[:-1]]


def repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def common_counts(words: Words, hashes: np.ndarray, groups: np.ndarray, known: dict[str, np.ndarray]) -> np.ndarray:
    """How often each document has each common word of its group, and last all others."""
    count = len(words.first) - 1
    out = np.zeros((count, COMMON_WORDS + 1), np.int64)
    out[:, -1] = np.diff(words.first)
    document = words.documents()
    for group in set(groups):
        if not len(listed := known.get(group, ())):
            continue
        own = np.flatnonzero((groups == group)[document])
        order = np.argsort(listed)
        at = np.minimum(np.searchsorted(listed[order], hashes[own]), len(listed) - 1)
        hit = listed[order][at] == hashes[own]
        np.add.at(out, (document[own][hit], order[at[hit]]), 1)
    out[:, -1] -= out[:, :-1].sum(1)
    return out


def group_of() -> Column:
    """The language as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), "lang"), F.lit("null")).alias("group")


def common_words(documents: DataFrame, most: int = COMMON_WORDS) -> dict[str, list[str]]:
    """Per language with enough documents the words that most of them have; ties go to the smaller word."""
    found = F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))).alias("word")
    counts = documents.select(group_of(), found).groupBy("group", "word").count()
    best = Window.partitionBy("group").orderBy(F.desc("count"), "word")
    rows = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)
    # languages that can have a reference, so that an unclean column sends nothing to the driver
    judged = documents.groupBy(group_of()).count().where(F.col("count") >= REFERENCE_DOCUMENTS).select("group")
    rows = rows.join(judged, "group", "left_semi")
    out: dict[str, list[str]] = {}
    for row in rows.orderBy("group", "rank").collect():  # ``most`` words a language with a reference
        out.setdefault(row["group"], []).append(row["word"])
    return out


def word_hashes(listed: list[str]) -> np.ndarray:
    return split(*string_buffers(pa.array(listed, pa.string()))).hashes()


def measured(documents: DataFrame, common: dict[str, list[str]]) -> DataFrame:
    """(doc_id, group, and MEASURES) of every whole text."""
    known = {group: word_hashes(listed) for group, listed in common.items()}
    kind = documents.schema["doc_id"].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in chunks(batch.column("text")):
                hashes, classes = words.hashes(), class_counts(words)
                group = batch.column("group").slice(low, high - low)
                flat, at = memoryview(words.bytes), words.offsets
                lines = [repeated_lines(bytes(flat[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)]
                listed = common_counts(words, hashes, group.to_numpy(zero_copy_only=False), known)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(low, high - low),
                        "group": group,
                        "n_words": np.diff(words.first),
                        "word_chars": classes.sum(1) - classes[:, SPACE],
                        "n_symbols": classes[:, SYMBOL],
                        "n_dup_lines": np.array(lines, np.int64),
                        "n_repeat_words": repeated_words(words, hashes),
                        "n_chars": classes.sum(1),
                        "classes": pa.array(list(classes), pa.list_(pa.int64())),
                        "common": pa.array(list(listed), pa.list_(pa.int64())),
                    }
                )

    rows = small_batches(documents).select("doc_id", group_of(), text_of("text").alias("text"))
    return rows.mapInArrow(measure, f"doc_id {kind}, group string, {MEASURES}")


def shares(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(1, keepdims=True), 1)


def histogram(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def references(measures: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Mean shares of character classes and common words, per language, over documents that pass the base rules."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            both = [shares(histogram(batch.column(name))) for name in ("classes", "common")]
            rows = np.hstack([np.ones((batch.num_rows, 1)), *both])
            groups = batch.column("group").to_numpy(zero_copy_only=False)
            for group in set(groups):
                sums[group] = sums.get(group, 0) + rows[groups == group].sum(0)
        for group, values in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"group": [group] * len(values), "place": np.arange(len(values)), "value": values}
            )

    parts = measures.where("NOT base_failed").select("group", "classes", "common")
    parts = parts.mapInArrow(add_up, "group string, place long, value double")
    added = parts.groupBy("group", "place").agg(F.sum("value").alias("value"))
    enough = added.where((F.col("place") == 0) & (F.col("value") >= REFERENCE_DOCUMENTS)).select("group")
    sums: dict[str, np.ndarray] = {}
    for group, place, value in added.join(enough, "group", "left_semi").select("group", "place", "value").collect():
        sums.setdefault(group, np.zeros(1 + CLASSES + COMMON_WORDS + 1))[place] = value
    return {
        group: (values[1 : 1 + CLASSES] / values[0], values[1 + CLASSES :] / values[0])
        for group, values in sums.items()
    }


def divergence(rows: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row's shares to the reference."""
    middle = (rows + reference) / 2

    def bits(a: np.ndarray) -> np.ndarray:
        return np.where(a > 0, a * np.log2(np.where(a > 0, a, 1) / np.where(middle > 0, middle, 1)), 0).sum(1)

    return np.sqrt(np.clip((bits(rows) + bits(np.broadcast_to(reference, rows.shape))) / 2, 0, 1))


def judged(documents: DataFrame) -> DataFrame:
    """Base counts and verdict of every document.

    base_failed: under 50 words, or over half of the words in repeated 3-word
    windows. kept: not base_failed, and near enough to its language in both
    histograms, where these are judged. class_distance and word_distance are
    null where they are not. Null text counts as empty; documents without a
    language are a language of their own; rows repeated, or without a doc_id, are
    judged each; extra columns are left out. Sums are doubles added in any order, so distances can
    differ in their last digits between runs.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measures = saved(measured(documents, common_words(documents)).withColumn("base_failed", failed), "quality")
    known = references(measures)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = batch.column("group").to_numpy(zero_copy_only=False)
            found = np.full((2, batch.num_rows), np.nan)
            for group in set(groups) & known.keys():
                own = groups == group
                for place, name in enumerate(("classes", "common")):
                    found[place, own] = divergence(shares(histogram(batch.column(name))[own]), known[group][place])
            found[0, batch.column("n_chars").to_numpy() < CLASS_CHARS] = np.nan
            found[1, batch.column("n_words").to_numpy() < WORD_WORDS] = np.nan
            far = (found[0] > CLASS_DISTANCE) | (found[1] > WORD_DISTANCE)  # false for what is not judged
            failed = batch.column("base_failed").to_numpy(zero_copy_only=False).astype(bool)
            out = batch.drop_columns(["classes", "common", "n_chars", "group"])
            for name, values in (("class_distance", found[0]), ("word_distance", found[1])):
                out = out.append_column(name, pa.array(values, pa.float64(), from_pandas=True))
            yield out.append_column("kept", pa.array(~failed & ~far))

    names = [name for name in measures.columns if name not in ("classes", "common", "n_chars", "group")]
    kinds = ", ".join(f"{name} {measures.schema[name].dataType.simpleString()}" for name in names)
    return measures.mapInArrow(judge, f"{kinds}, class_distance double, word_distance double, kept boolean")
