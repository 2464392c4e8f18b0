"""Elements of JSON arrays of any length, read by byte ranges.

Whether a byte lies in a string, and how deep, depends on all bytes before it.
So a first pass gives per range the quotes in it and the change of depth for
either way it may begin; sums of these over the ranges before tell how a range
does begin. A second pass cuts the elements. Files of one range skip the first.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGE_BYTES = 64 << 20
CHUNK_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
#: Splits of the list of files that one task goes through; a split has 32 files by Spark's default.
SPLITS = 64
QUOTE, BACKSLASH, COMMA, OPEN, CLOSE = b'"\\,[]'
STEP = np.zeros(256, np.int64)
STEP[list(b"[{")] = 1
STEP[list(b"]}")] = -1
MARK = STEP != 0
MARK[COMMA] = True
BLANK = b" \t\r\n\xef\xbb\xbf"


def outline(data: bytes, slashes: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Places of brackets and commas, the quotes before each, the quotes in all, and backslashes at the end.

    ``slashes`` is the number of backslashes right before the data; quotes after
    an odd number of them do not count.
    """
    raw = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(raw == QUOTE)
    others = np.flatnonzero(raw != BACKSLASH)
    if slashes or len(others) < len(raw):
        at = np.searchsorted(others, quotes)
        last = np.where(at > 0, others[np.maximum(at, 1) - 1] if len(others) else 0, -1 - slashes)
        quotes = quotes[(quotes - last) % 2 == 1]
    marks = np.flatnonzero(MARK[raw])
    trailing = len(raw) - 1 - int(others[-1]) if len(others) else slashes + len(raw)
    return marks, np.searchsorted(quotes, marks), len(quotes), trailing


def slashes_before(source, place: int) -> int:
    """Backslashes right before a place."""
    found = 0
    while place > found:
        piece = source.read_at(min(64, place - found), max(0, place - found - 64))
        more = len(piece) - len(piece.rstrip(b"\\"))
        found += more
        if more < len(piece):
            break
    return found


def holds_array(source, size: int) -> bool:
    at = 0
    while at < size:
        head = source.read_at(min(4096, size - at), at).lstrip(BLANK)
        if head:
            return head[0] == OPEN
        at += 4096
    return False


def summary(source, start: int, end: int) -> tuple[int, int, int]:
    """Quotes in a range, and its change of depth if it begins outside and if it begins inside a string."""
    slashes, quotes, change = slashes_before(source, start), 0, [0, 0]
    for at in range(start, end, CHUNK_BYTES):
        data = source.read_at(min(CHUNK_BYTES, end - at), at)
        marks, before, more, slashes = outline(data, slashes)
        step, inside = STEP[np.frombuffer(data, np.uint8)[marks]], (before + quotes) % 2
        change[0] += int(step[inside == 0].sum())
        change[1] += int(step[inside == 1].sum())
        quotes += more
    return quotes, change[0], change[1]


def elements(source, start: int, end: int, size: int, quoted: int, depth: int) -> Iterator[bytes]:
    """The elements of the file's array that begin in the range; the last one is read past its end."""
    at, slashes = start, slashes_before(source, start)
    begun, pieces = False, []
    while at < end or (begun and at < size):
        data = source.read_at(min(CHUNK_BYTES, (end if at < end else size) - at), at)
        marks, before, quotes, slashes = outline(data, slashes)
        marks = marks[(before + quoted) % 2 == 0]
        kinds = np.frombuffer(data, np.uint8)[marks]
        after = depth + np.cumsum(STEP[kinds])
        cuts = ((kinds == COMMA) | (kinds == OPEN)) & (after == 1) | (kinds == CLOSE) & (after == 0)
        rest = 0
        for place, kind in zip(marks[cuts].tolist(), kinds[cuts].tolist(), strict=True):
            if begun:
                yield b"".join([*pieces, data[rest:place]]).strip(BLANK)
                if at >= end:
                    return
            begun, pieces, rest = kind != CLOSE, [], place + 1
        if begun:
            pieces.append(data[rest:])
        quoted = (quoted + quotes) % 2
        depth = int(after[-1]) if len(after) else depth
        at += len(data)


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path that Spark names, and the path there."""
    return fs.FileSystem.from_uri(path.removeprefix("file:"))


def opened(path: str):
    """A file of any store that Spark names."""
    store, place = store_of(path)
    return store.open_input_file(place)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            with opened(row["path"]) as source:
                found.append(summary(source, row["start"], row["end"]))
        columns = [pa.array(values, pa.int64()) for values in zip(*found, strict=True)]
        if found:
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *COUNTS])


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements of several ranges go in one batch: a batch per range costs more than a short range does."""
    paths, held, size = [], [], 0
    for batch in batches:
        for row in batch.to_pylist():
            path = row["path"]
            with opened(path) as source:
                if not holds_array(source, row["length"]):
                    continue
                begin = (row["start"], row["end"], row["length"], row["quoted"], row["depth"])
                for text in elements(source, *begin):
                    if text:
                        paths.append(path)
                        held.append(None if text == b"null" else text.decode("utf-8", "replace"))
                        size += len(text) + len(path)
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pydict({"path": paths, "payload": held}, RESULT)
                        paths, held, size = [], [], 0
    yield pa.RecordBatch.from_pydict({"path": paths, "payload": held}, RESULT)


COUNTS = ("quotes", "change_outside", "change_inside")
RESULT = pa.schema([("path", pa.string()), ("payload", pa.string())])
RANGE = "path string, length long, start long, end long"


def array_elements(spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, payload): the elements of the JSON arrays in all files below a folder or several, as JSON text.

    A file is read by as many tasks as it has ranges, and no more than an element
    is held. ``null`` gives a null payload. A file that holds no array gives no
    rows, and an element in which a file breaks off is left out.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = files.select("path", "length").where("length > 0")
    # only names and lengths are read, so a split of a few files is not worth a task
    listers = max(spark.sparkContext.defaultParallelism, -(-files.rdd.getNumPartitions() // SPLITS))
    files = files.coalesce(listers)
    total, shortest, longest = files.agg(F.sum("length"), F.min("length"), F.max("length")).first()
    total, shortest, longest = total or 0, shortest or 0, longest or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // RANGE_BYTES))

    def ranges(some: DataFrame) -> DataFrame:
        every = F.lit(range_bytes).cast("long")
        starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, every)
        cut = some.select("path", "length", F.explode(starts).alias("start"))
        end = F.least(F.col("start") + range_bytes, "length")
        # the number of tasks follows the files' bytes: adaptive execution would go by the names' bytes
        return cut.withColumn("end", end).repartition(tasks, "path", "start")

    one = ranges(files.where(F.col("length") <= range_bytes))
    known = one.select("*", F.lit(0).alias("quoted"), F.lit(0).cast("long").alias("depth"))
    if longest <= range_bytes:
        return known.mapInArrow(_elements, "path string, payload string")
    several = ranges(files.where(F.col("length") > range_bytes)).mapInArrow(
        _summaries, f"{RANGE}, quotes long, change_outside long, change_inside long"
    )
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    quoted = F.coalesce(F.sum("quotes").over(before) % 2, F.lit(0)).cast("int")
    change = F.when(F.col("quoted") == 0, F.col("change_outside")).otherwise(F.col("change_inside"))
    begins = several.withColumn("quoted", quoted).withColumn("change", change)
    depth = F.coalesce(F.sum("change").over(before), F.lit(0))
    begins = begins.select("path", "length", "start", "end", "quoted", depth.alias("depth"))
    begins = begins.repartition(tasks, "path", "start")
    if shortest > range_bytes:
        return begins.mapInArrow(_elements, "path string, payload string")
    return known.unionByName(begins).mapInArrow(_elements, "path string, payload string")
