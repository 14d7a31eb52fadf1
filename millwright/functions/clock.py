"""Zone-less timestamps and intervals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Start of both clocks, sensor step, as-of tolerance.
CLOCK_START = "2020-01-01 00:00:00"
SENSOR_STEP_SECONDS = 10
TOLERANCE_MINUTES = 3


def moment(text: str) -> Column:
    """A TIMESTAMP_NTZ literal."""
    return F.to_timestamp_ntz(F.lit(text), F.lit("yyyy-MM-dd HH:mm:ss"))


def parsed(column: str | Column) -> Column:
    """A text column read as TIMESTAMP_NTZ (with or without fractional seconds)."""
    return F.col(column).cast("timestamp_ntz") if isinstance(column, str) else column.cast("timestamp_ntz")


def minutes(count: int | Column) -> Column:
    """A day-time interval of whole minutes."""
    amount = count if isinstance(count, Column) else F.lit(count)
    return F.make_dt_interval(F.lit(0), F.lit(0), amount.cast("int"))


def seconds(count: int | Column) -> Column:
    """A day-time interval of seconds; days are split off so that long clocks fit."""
    amount = (count if isinstance(count, Column) else F.lit(count)).cast("bigint")
    day = F.lit(86400).cast("bigint")
    return F.make_dt_interval(
        F.floor(amount / day).cast("int"), F.lit(0), F.lit(0), F.pmod(amount, day).cast("decimal(18,6)")
    )


def plus_minutes(start: Column, count: Column) -> Column:
    """``start`` + whole minutes; days are split off so that long jobs fit."""
    total = count.cast("bigint")
    day = F.lit(1440).cast("bigint")
    return start + F.make_dt_interval(
        F.floor(total / day).cast("int"), F.lit(0), F.pmod(total, day).cast("int")
    )


def order_value(column: Column, kind: str, shared: str = "") -> Column:
    """A double that never decreases as ``column`` grows. Used to spread rows, not to compare them.

    ``shared`` is what most texts begin with; what follows it tells them apart.
    """
    if kind == "timestamp":
        return F.unix_micros(column).cast("double")
    if kind == "timestamp_ntz":
        return (
            F.unix_date(column.cast("date")).cast("double") * 86400.0
            + F.hour(column) * 3600.0
            + F.minute(column) * 60.0
            + F.date_part(F.lit("SECOND"), column).cast("double")
        )
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind == "string":
        # Six bytes as a number: strings that differ later share it.
        rest = F.substring(column, len(shared) + 1, 6)
        head = F.conv(F.rpad(F.substring(F.hex(rest), 1, 12), 12, "0"), 16, 10).cast("double")
        if not shared:
            return head
        return F.when(column.startswith(shared), head).when(column < shared, -1.0).otherwise(F.when(column.isNotNull(), 2.0**48))
    return column.cast("double")
