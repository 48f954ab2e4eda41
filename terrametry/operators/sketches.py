"""Distinct counts that merge: stored sketches for any range of days, exact bitmaps for rollups."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage

#: Logarithm of a sketch's registers: 16 KB at most for each day and group.
LG_K = 14


def error_bound(lg_k: int = LG_K, deviations: float = 4) -> float:
    """Relative error of a merged sketch that all but one in 15,000 estimates keep."""
    return deviations * 1.04 / math.sqrt(2 ** lg_k)


def daily_sketches(df: DataFrame, ts: str, term: Column | str, by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """One sketch of the distinct values of ``term`` for each ``day`` and ``by``; rows without time or value count nowhere."""
    term = F.col(term) if isinstance(term, str) else term
    return df.filter(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("day"), *by).agg(
        F.hll_sketch_agg(term, lg_k).alias("sketch"), F.count(term).alias("n_values"))


def distinct_in_ranges(stored: DataFrame, ranges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Estimates for each range ``(first, last)`` of days, both included: only sketches are read.

    ``ranges`` are the asked-for rows, few enough to broadcast.
    """
    within = (F.col("day") >= F.col("first")) & (F.col("day") <= F.col("last"))
    # days of a range by equality, so that no join compares every day with every range
    days = ranges.withColumn("day", F.explode(F.sequence("first", "last")))
    return stored.join(F.broadcast(days), "day").filter(within).groupBy("first", "last", *by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))


def with_codes(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` with a number of their own, ``code``, written once.

    Numbers are consecutive within an input task, so bitmaps of 32,768 of them are
    dense; no task numbers all values.
    """
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return stage(values.withColumn("code", F.monotonically_increasing_id() + 1), "codes")


def bitmap_table(coded: DataFrame, by: Sequence[str]) -> DataFrame:
    """One bitmap for each ``by`` and block of codes; repeated rows set the same bit."""
    return coded.groupBy(*by, F.bitmap_bucket_number("code").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bits"))


def rolled_up(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps for fewer columns, or-ed from finer ones."""
    return bitmaps.groupBy(*by, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_of(bitmaps: DataFrame, by: Sequence[str], name: str = "n_distinct") -> DataFrame:
    """Exact distinct count for each ``by`` of a bitmap table of these columns."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))
