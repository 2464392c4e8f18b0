"""Running values along an order within groups, however many rows a group has.

A window brings a whole group to one task. Here the rows of all groups are
range-partitioned along (group, order) instead, so that small groups share a
task and a large one is cut into pieces. Windows run within the pieces, and the
totals and last values of the pieces before are added to them.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlive.workspace import shared_dir

PIECE = "_piece"


def join_on(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join in which null keys match; the key columns of the right side are dropped."""
    theirs = {name: f"_right_{name}" for name in keys}
    right = right.withColumnsRenamed(theirs)
    match = reduce(
        lambda a, b: a & b, (F.col(mine).eqNullSafe(F.col(name)) for mine, name in theirs.items())
    )
    return left.join(right, match, how).drop(*theirs.values())


def ordered_pieces(
    rows: DataFrame, by: Sequence[str], order: Sequence[Column], pieces: int | None = None
) -> DataFrame:
    """Rows ready for ``previous_value`` and ``running_sum``, in pieces along the order.

    The order has to tell rows apart, or else rows that agree in it stay in one
    piece. Column ``_piece`` numbers the pieces; a checkpoint fixes the numbers,
    as they come from the partition a row fell in. The number of pieces is that
    of the shuffle partitions, of which adaptive execution merges small ones.
    """
    shared_dir(rows.sparkSession)
    number = () if pieces is None else (pieces,)
    cut = rows.repartitionByRange(*number, *by, *order)
    return cut.withColumn(PIECE, F.spark_partition_id()).checkpoint()


def previous_value(
    pieces: DataFrame, by: Sequence[str], order: Sequence[Column], value: str, name: str
) -> DataFrame:
    """Adds the value of the row before in the group's order, null for the first row."""
    keys = [*by, PIECE]
    within = Window.partitionBy(*keys).orderBy(*order)
    # The first row of a piece follows the last row of the piece before.
    along = Window.partitionBy(*by).orderBy(PIECE)
    lasts = (
        pieces.groupBy(*keys)
        .agg(F.max_by(F.struct(value), F.struct(*order)).alias("_last"))
        .withColumn("_before", F.lag("_last").over(along))
        .drop("_last")
    )
    numbered = pieces.withColumn("_n", F.row_number().over(within)).withColumn(
        name, F.lag(value).over(within)
    )
    before = F.when(F.col("_n") == 1, F.col("_before")[value]).otherwise(F.col(name))
    return (
        join_on(numbered, lasts, keys, "left").withColumn(name, before).drop("_n", "_before")
    )


def running_sum(
    pieces: DataFrame, by: Sequence[str], order: Sequence[Column], sums: dict[str, Column]
) -> DataFrame:
    """Adds, per name, the sum over the group's rows up to and including this one."""
    keys = [*by, PIECE]
    so_far = (
        Window.partitionBy(*keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = pieces.withColumns({n: F.sum(value).over(so_far) for n, value in sums.items()})
    # A piece starts from the total of all pieces before it.
    earlier = (
        Window.partitionBy(*by)
        .orderBy(PIECE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = pieces.groupBy(*keys).agg(*(F.sum(v).alias(n) for n, v in sums.items()))
    starts = totals.select(*keys, *(F.sum(n).over(earlier).alias(f"_start_{n}") for n in sums))
    joined = join_on(local, starts, keys, "left")
    return joined.withColumns({n: _plus(F.col(n), F.col(f"_start_{n}")) for n in sums}).drop(
        *(f"_start_{n}" for n in sums)
    )


def _plus(a: Column, b: Column) -> Column:
    """Sum in which one null counts as nothing, as in an aggregate."""
    return F.coalesce(a + b, a, b)
