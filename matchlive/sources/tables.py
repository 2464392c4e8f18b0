"""Table reads that stand a table not being there yet, and append-only tables as streams."""

import os

from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The schema's columns of a table; an empty frame while the path does not exist.

    Any other failure is raised.
    """
    try:
        names = StructType.fromDDL(schema).names
        return spark.read.schema(schema).parquet(path).select(*names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_version(path: str) -> int | None:
    """Number of the newest batch a streaming file sink has committed to a table.

    It is the name of the newest of the sink's commit files, which Spark's
    readers hide; None before the first.
    """
    store, place = fs.FileSystem.from_uri(path if ":" in path else os.path.abspath(path))
    commits = fs.FileSelector(f"{place}/_spark_metadata", allow_not_found=True)
    names = [found.base_name.removesuffix(".compact") for found in store.get_file_info(commits)]
    return max((int(name) for name in names if name.isdigit()), default=None)


def stream_table(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    """Rows appended to a table by a streaming file sink, each exactly once.

    Only for append-only tables. A change log is rewritten per batch, and a
    rewritten file would look like new rows.
    """
    return spark.readStream.schema(schema).options(**options).parquet(path)
