"""Comparing all rows of a key with each other in tasks of bounded size, however many rows a key has."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys with more rows than a tile holds are few: rows / tile size. Up to so many are broadcast (some MB).
BROADCAST_KEYS = 200_000


def tiled(rows: DataFrame, keys: Sequence[str], spread: str, most: int, counts: DataFrame) -> DataFrame:
    """Adds tile_i, tile_j and side to ``rows``.

    A key with more than ``most`` rows is dealt over parts by a hash of
    ``spread``; any two parts, and each part with itself, meet in one tile. A
    tile holds about ``2 * most`` rows at most. ``counts`` has the keys and
    ``count``. Side is 1 for rows of the second part, else 0.
    """
    large = counts.where(F.col("count") > most).select(*keys, F.ceil(F.col("count") / most).cast("int").alias("parts"))
    if large.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        large = F.broadcast(large)
    parts = F.coalesce("parts", F.lit(1))
    dealt = rows.join(large, list(keys), "left").withColumn("own", F.pmod(F.xxhash64(spread), parts).cast("int"))
    met = dealt.withColumn("met", F.explode(F.sequence(F.lit(0), parts - 1)))
    tile = met.withColumn("tile_i", F.least("own", "met")).withColumn("tile_j", F.greatest("own", "met"))
    return tile.withColumn("side", (F.col("own") > F.col("met")).cast("int")).drop("own", "met", "parts")
