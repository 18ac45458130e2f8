"""Text-to-type casts, defaults, identifiers and JSON payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(as_column(c), F.lit(""))


def int_from_text(c: str | Column) -> Column:
    """Integer id that may be written as ``1.0``; blank is NULL, junk raises."""
    return F.round(blank_to_null(c).cast("decimal(38,6)"), 0).cast("int")


def decimal_or_zero(c: str | Column, precision: int = 12, scale: int = 2) -> Column:
    """Blank or missing amount becomes zero."""
    return F.coalesce(blank_to_null(c), F.lit("0")).cast(f"decimal({precision},{scale})")


def flag(c: str | Column) -> Column:
    """Boolean as 0/1."""
    return as_column(c).cast("int")


def canonical_uuid(c: str | Column) -> Column:
    """Lower-case hyphenated UUID text; NULL stays NULL, anything else raises."""
    col = as_column(c)
    digits = F.lower(F.translate(col, "{}-", ""))
    text = F.concat_ws(
        "-",
        F.substring(digits, 1, 8),
        F.substring(digits, 9, 4),
        F.substring(digits, 13, 4),
        F.substring(digits, 17, 4),
        F.substring(digits, 21, 12),
    )
    return (
        F.when(col.isNull(), F.lit(None).cast("string"))
        .when(digits.rlike("^[0-9a-f]{32}$"), text)
        .otherwise(F.raise_error(F.concat(F.lit("not a uuid: "), col)).cast("string"))
    )


def row_json(columns: Sequence[str]) -> Column:
    """Whole row as JSON text; NULL fields are kept, they explain the reject."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
