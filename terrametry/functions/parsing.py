"""Text to typed values. Malformed text gives NULL, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number_from_text(c: Column | str, decimal_mark: str = ".") -> Column:
    """Double from text; ``decimal_mark`` names the mark the text uses."""
    text = _column(c)
    if decimal_mark != ".":
        text = F.replace(text, F.lit(decimal_mark), F.lit("."))
    return text.try_cast("double")


def whole_from_text(c: Column | str) -> Column:
    """Int from text such as ``'3'`` or ``'3.7'`` (truncated); else NULL."""
    digits = F.regexp_extract(_column(c), r"^\s*([+-]?\d+)(?:\.\d*)?\s*$", 1)
    return digits.try_cast("int")


def date_from_text(c: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    """Date under one fixed pattern; any other text gives NULL."""
    return F.try_to_date(_column(c), pattern)
