"""Codes and keys built from text parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .parsing import _column


def compose_code(
    area: Column | str, unit: Column | str, mode: str = "reference",
    width: int = 5, unit_width: int = 3,
) -> Column:
    """Area code and unit code as one code of ``width`` characters.

    ``reference`` joins the parts, skipping NULLs, then pads or cuts the whole
    on its left side: ``('01', '53') -> '00153'``, ``(NULL, NULL) -> '00000'``.
    ``fixed`` sizes each part by itself and is NULL when either is:
    ``('01', '53') -> '01053'``, ``('971', '101') -> '97101'``.
    """
    area, unit = _column(area), _column(unit)
    if mode == "reference":
        return F.lpad(F.concat_ws("", area, unit), width, "0")
    if mode == "fixed":
        return F.concat(
            F.lpad(area, width - unit_width, "0"), F.lpad(unit, unit_width, "0")
        )
    raise ValueError(f"mode must be 'reference' or 'fixed', not {mode!r}")


def prefix(c: Column | str, length: int = 2) -> Column:
    return F.substring(_column(c), 1, length)


def message_key(*parts: Column | str, missing: str = "None") -> Column:
    """Parts joined by ``_``; a NULL part shows as ``missing``."""
    return F.concat_ws("_", *[F.coalesce(_column(p).cast("string"), F.lit(missing)) for p in parts])


def document_id(key: Column | str) -> Column:
    """Key made safe as an id: blank to ``_`` and colon to ``-``."""
    return F.translate(_column(key), " :", "_-")
