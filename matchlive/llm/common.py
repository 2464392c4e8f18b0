"""Helpers that the operators share: tables written on the way, and ranks that no single task computes."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchlive.workspace import new_run_dir

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

BATCH_SETTING, BATCH_DEFAULT, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(frame: DataFrame) -> DataFrame:
    """The frame; its session sends Python workers fewer rows at once from now on.

    Texts are long, and a task holds several copies of a batch. A session with a
    setting of its own keeps it.
    """
    conf = frame.sparkSession.conf
    if conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        conf.set(BATCH_SETTING, BATCH_ROWS)
    return frame


def saved(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    What follows neither computes it again nor depends on the executors that did.
    """
    path = new_run_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def numbered(
    frame: DataFrame, keys: Sequence[str], order: Sequence[Column], buckets: int, name: str
) -> DataFrame:
    """Adds a row number from 0 within ``keys``, in an order set by a hash of ``order``.

    Each key is dealt over ``buckets`` parts by the hash. The parts are counted,
    the counts added up, and rows are ranked within their part only, so that a
    key with a third of all rows is no single task. Keys must not be null. Rows
    that agree in all of ``order`` get neighbouring numbers in any order.
    ``frame`` is read twice: pass a saved table.
    """
    part, inside, before = f"__part_{name}", f"__inside_{name}", f"__before_{name}"
    spread = frame.withColumn(part, F.pmod(F.xxhash64(F.lit("part"), *order), F.lit(buckets)).cast("int"))
    ahead = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = spread.groupBy(*keys, part).agg(F.count("*").alias(inside))
    starts = counts.select(*keys, part, F.coalesce(F.sum(inside).over(ahead), F.lit(0)).alias(before))
    within = Window.partitionBy(*keys, part).orderBy(F.xxhash64(F.lit("rank"), *order), *order)
    ranked = spread.withColumn(inside, F.row_number().over(within) - 1)
    joined = ranked.join(starts, [*keys, part])
    return joined.withColumn(name, (F.col(before) + F.col(inside)).cast("long")).drop(part, inside, before)


def parts_for(rows: int, rows_per_part: int = 50_000) -> int:
    """How many parts to deal a key over, so that even one with all rows fits its tasks."""
    return max(64, -(-rows // rows_per_part))


class Carried:
    """All columns of a frame under names that clash with nothing, to pass through a task unread."""

    def __init__(self, frame: DataFrame) -> None:
        self.names = frame.columns
        self.own = [f"__c{place}" for place in range(len(self.names))]
        self.columns = [F.col(f"`{name}`").alias(own) for name, own in zip(self.names, self.own, strict=True)]
        kinds = (field.dataType.simpleString() for field in frame.schema)
        self.schema = ", ".join(f"{own} {kind}" for own, kind in zip(self.own, kinds, strict=True))

    def __getitem__(self, name: str) -> str:
        return self.own[self.names.index(name)]

    def restored(self, frame: DataFrame) -> DataFrame:
        return frame.select(*[F.col(own).alias(name) for own, name in zip(self.own, self.names, strict=True)])
