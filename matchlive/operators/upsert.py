"""Keyed tables as frames: merge, versioned change log, newest row per key."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERSION = "batch_id"


def merge_additive(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], added: Sequence[str]
) -> DataFrame:
    """Target with the batch's values added to matching keys and new keys inserted.

    A full outer join would shuffle both sides for every row; the sum of the
    union is combined before its one shuffle. Null keys match, and a null value
    adds nothing.
    """
    both = target.select(*keys, *added).unionByName(batch.select(*keys, *added))
    types = {name: target.schema[name].dataType for name in added}
    return both.groupBy(*keys).agg(
        *(F.sum(name).cast(kind).alias(name) for name, kind in types.items())
    )


def latest_by_key(
    changes: DataFrame, keys: Sequence[str], version: str = VERSION
) -> DataFrame:
    """Current table of a change log: each key's row of the highest version.

    A key that later versions do not mention keeps its row.
    """
    values = [name for name in changes.columns if name not in (*keys, version)]
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*values), version).alias("_row"))
    return newest.select(*keys, *(F.col("_row")[name].alias(name) for name in values))
