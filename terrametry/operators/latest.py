"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """The last row of each key in ``order`` (later columns break ties).

    The rank filter is applied before the shuffle as well as after it, so each
    input task sends at most one row per key, however frequent the key.
    """
    newest_first = [
        (F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in order
    ]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
