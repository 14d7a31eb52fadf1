"""Profile a table: every summary as a small table of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millwright.functions.columns import numeric_columns
from millwright.operators.density import histogram, kernel_densities
from millwright.operators.profile import correlations, missing_counts, only_missing, summary
from millwright.sources.reports import write_report


def profile(df: DataFrame) -> dict[str, DataFrame]:
    """``summary, missing, missing_nonzero`` and, with numeric columns, ``histogram, density, correlation``."""
    numbers = numeric_columns(df)
    missing = missing_counts(df)
    tables = {"missing": missing, "missing_nonzero": only_missing(missing)}
    if numbers:
        tables["summary"] = summary(df, numbers)
        tables["histogram"] = histogram(df, numbers)
        tables["density"] = kernel_densities(df, numbers)
    if len(numbers) > 1:
        tables["correlation"] = correlations(df, numbers)
    return tables


def profile_job(df: DataFrame, folder: str) -> dict[str, str]:
    """Write the profile as CSV tables."""
    return write_report(profile(df), folder)
