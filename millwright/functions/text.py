"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def digit_cells(line: Column) -> Column:
    """Comma-separated cells that consist of digits only, as an integer array."""
    cells = F.transform(F.split(line, ","), lambda cell: F.trim(cell))
    return F.transform(
        F.filter(cells, lambda cell: cell.rlike("^[0-9]+$")), lambda cell: cell.cast("int")
    )


def number_cells(line: Column) -> Column:
    """Comma-separated cells as truncated whole numbers; an empty cell becomes null."""
    cells = F.transform(F.split(line, ","), lambda cell: F.trim(cell))
    return F.transform(
        cells, lambda cell: F.when(cell != "", cell).cast("double").cast("int")
    )


def rounded(value: Column, digits: int = 4) -> Column:
    """A double rounded for a report; a negative zero becomes a plain one."""
    return F.round(value.cast("double"), digits) + F.lit(0.0)


def as_report_text(value: Column, digits: int = 4) -> Column:
    """A number as text with fixed decimals."""
    return F.format_string(f"%.{digits}f", value.cast("double"))


def row_hash(key: list[str], seed: int) -> Column:
    """A repeatable, evenly spread hex order for rows with a unique key."""
    parts = [F.col(f"`{name}`").cast("string") for name in key]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))
