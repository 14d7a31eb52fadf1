"""Choosing, naming and checking columns. All of it works on the schema, never on rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Short names of the sensor headers.
SENSOR_NAMES = {
    "Air temperature [K]": "air_temp_K",
    "Process temperature [K]": "proc_temp_K",
    "Rotational speed [rpm]": "rot_speed_rpm",
    "Torque [Nm]": "torque_Nm",
    "Tool wear [min]": "tool_wear_min",
    "Machine failure": "machine_failure",
}

# The model input of the fused table.
NUMERIC_FEATURES = [
    "air_temp_K",
    "proc_temp_K",
    "rot_speed_rpm",
    "torque_Nm",
    "tool_wear_min",
    "setup_time",
    "processing_time",
]
CATEGORICAL_FEATURES = ["machine_id"]
TARGET = "machine_failure"

# Header text that identifies each role in a raw sensor file.
ROLE_TEXT = {
    "air": "air temperature",
    "process": "process temperature",
    "speed": "rotational speed",
    "torque": "torque",
    "wear": "tool wear",
    "target": "machine failure",
}

# Columns that give the target away or only identify a row.
LEAKING_COLUMNS = ["UDI", "Product ID", "TWF", "HDF", "PWF", "OSF", "RNF"]


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the listed columns; absent ones are left out, as in a header map."""
    return df.withColumnsRenamed(names)


def project(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep only ``columns``; the scan below reads nothing else."""
    return df.select(*[F.col(f"`{name}`") for name in columns])


def without(df: DataFrame, *columns: str) -> DataFrame:
    """Drop columns, e.g. the target before features are chosen."""
    return df.drop(*columns)


def numeric_columns(df: DataFrame) -> list[str]:
    """Number-typed columns in schema order; booleans are not numbers."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    """Text columns in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def columns_by_role(df: DataFrame, roles: dict[str, str] | None = None) -> dict[str, str]:
    """Find, for each role, the first header that contains its text, ignoring case."""
    wanted = ROLE_TEXT if roles is None else roles
    found, absent = {}, []
    for role, text in wanted.items():
        hit = next((name for name in df.columns if text.lower() in name.lower()), None)
        if hit is None:
            absent.append(text)
        else:
            found[role] = hit
    if absent:
        raise KeyError(f"no column containing {', '.join(repr(t) for t in absent)}")
    return found


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Raise one error that names every missing column."""
    absent = [name for name in columns if name not in df.columns]
    if absent:
        raise KeyError(f"missing columns: {', '.join(absent)}")
    return df


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Raise when there is no row at all; reads one row at most."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keep rows in which all of ``columns`` have a value."""
    return df.na.drop(how="any", subset=columns)


def missing(df: DataFrame, name: str) -> Column:
    """True for null, and for NaN in floating columns."""
    cell = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return cell.isNull() | F.isnan(cell)
    return cell.isNull()


def value_or_null(df: DataFrame, name: str) -> Column:
    """The column as double with NaN turned into null."""
    cell = F.col(f"`{name}`").cast("double")
    return F.when(~missing(df, name), cell)
