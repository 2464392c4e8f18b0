"""Match files: one JSON array of event documents per match, named ``events_<match id>``."""

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlive.schemas import EVENT
from matchlive.sources.json_ranges import RANGE_BYTES, array_elements, store_of

MATCH_ID_IN_PATH = r"events_(\d+)"
#: Files in a folder, so that many files are listed by many tasks.
FOLDER_FILES = 1000


def _match_id(pattern: str) -> Column:
    return F.regexp_extract("_metadata.file_path", pattern, 1).try_cast("bigint")


def read_match_events(
    spark: SparkSession, path: str | list[str], pattern: str = MATCH_ID_IN_PATH
) -> DataFrame:
    """Typed events of all match files below a folder or several, files read in parallel."""
    events = (
        spark.read.schema(EVENT)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .json(path)
    )
    return events.select(_match_id(pattern).alias("match_id"), *events.columns)


def read_match_documents(
    spark: SparkSession,
    path: str | list[str],
    pattern: str = MATCH_ID_IN_PATH,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Events of all match files as JSON text, with every field kept; a large file is read by many tasks."""
    found = array_elements(spark, path, range_bytes)
    match_id = F.regexp_extract("path", pattern, 1).try_cast("bigint")
    return found.select(match_id.alias("match_id"), "payload")


def write_match_documents(documents: DataFrame, path: str) -> list[str]:
    """Writes a file per match from (match_id, payload); returns the folders to read them from.

    Spark's writer makes a folder and a checksum for each file, and the driver
    moves them one by one; here tasks write plain files, and a document at a
    time, so a match of any length is not held. A task has folders of its own
    and names them when it ends, so what a lost or repeated task has left is
    never read. A null payload is left out; without a match id the file has none.
    """
    spark = documents.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    root = files.makeQualified(folder).toString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = store_of(root)
        folders, written, out, current, filled = [], 0, None, None, False
        try:
            for batch in batches:
                runs, payloads, start = pc.run_end_encode(batch.column("name")), batch.column("payload").to_pylist(), 0
                for name, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                    if name != current:
                        if out is not None:
                            out.write(b"]")
                            out.close()
                        if written % FOLDER_FILES == 0:
                            folders.append(uuid.uuid4().hex)
                            store.create_dir(f"{place}/{folders[-1]}", recursive=True)
                        out = store.open_output_stream(f"{place}/{folders[-1]}/{name}.json", compression=None)
                        out.write(b"[")
                        written, current, filled = written + 1, name, False
                    found = [payload for payload in payloads[start:end] if payload is not None]
                    if found:
                        out.write((b"," if filled else b"") + b",".join(found))
                        filled = True
                    start = end
            if out is not None:
                out.write(b"]")
        finally:
            if out is not None:
                out.close()
        yield pa.RecordBatch.from_pydict({"folder": pa.array(folders, pa.string())})

    name = F.concat(F.lit("events_"), F.coalesce(F.col("match_id").cast("string"), F.lit("without_id")))
    rows = documents.select("match_id", "payload").repartition("match_id").sortWithinPartitions("match_id")
    rows = rows.select(name.alias("name"), F.col("payload").cast("binary").alias("payload"))
    return [f"{root}/{row.folder}" for row in rows.mapInArrow(write, "folder string").collect()] or [root]
