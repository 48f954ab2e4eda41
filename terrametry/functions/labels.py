"""Labels from rules: quality, bands, zones, label matching."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from .parsing import _column


def quality_flag(rules: Sequence[Column], bad: str = "SUSPECTE", good: str = "OK") -> Column:
    """``bad`` when any rule is true; a rule that is NULL does not count."""
    return F.when(reduce(Column.__or__, rules), bad).otherwise(good)


def band(
    c: Column | str, steps: Sequence[tuple[float, str]], above: str
) -> Column:
    """Label of the first step whose upper bound exceeds the value.

    ``steps`` are ``(exclusive upper bound, label)`` in rising order; values
    past the last step are ``above`` and NULL stays NULL.
    """
    value = _column(c)
    chain = F
    for upper, label in steps:
        chain = chain.when(value < upper, label)
    return chain.when(value.isNotNull(), above)


def zone(c: Column | str, members: Mapping[str, Sequence[str]]) -> Column:
    """Name of the first zone that lists the code, else NULL."""
    chain = F
    for name, codes in members.items():
        chain = chain.when(_column(c).isin(list(codes)), name)
    return chain


def matches_label(c: Column | str, pattern: str, regex: bool = True) -> Column:
    """Label test; a pattern has to match the whole label, and an absent label
    is the empty label."""
    label = F.coalesce(_column(c), F.lit(""))
    return label.rlike(f"^(?:{pattern})$") if regex else label == pattern
