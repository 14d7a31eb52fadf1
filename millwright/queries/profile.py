"""Profiles of whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millwright.functions.columns import numeric_columns
from millwright.operators.density import histogram, kernel_density
from millwright.operators.profile import correlations, missing_counts, only_missing, summary
from millwright.operators.profile_state import add_parts, merged_correlations, merged_summary
from millwright.queries.views import digits, q, table
from millwright.session import fresh_path

LINE_NUMBERS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with some cells blanked and one constant column."""
    return table(spark, sf_dir, "lineitem").select(
        F.nullif(F.col("l_linenumber"), F.lit(3)).alias("l_linenumber"),
        F.nullif(F.col("l_quantity"), F.lit(10.0)).alias("l_quantity"),
        "l_extendedprice",
        "l_discount",
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"),
        F.nullif(F.col("l_returnflag"), F.lit("A")).alias("l_returnflag"),
        F.lit(7).alias("constant"),
    )


_HOLES = """
    SELECT nullif(l_linenumber, 3) AS l_linenumber, nullif(l_quantity, 10) AS l_quantity, l_extendedprice,
           l_discount, nullif(l_tax, 0) AS l_tax, nullif(l_returnflag, 'A') AS l_returnflag, 7 AS constant
    FROM lineitem
"""
_HOLED_NUMBERS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "constant"]


def profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    holed = _holes(spark, sf_dir)
    return digits(
        summary(holed, numeric_columns(holed)), ["mean", "std", "min", "p25", "p50", "p75", "max"]
    )


def profile_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return digits(summary(parts, numeric_columns(parts)), ["mean", "std", "min", "p25", "p50", "p75", "max"])


def profile_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_counts(_holes(spark, sf_dir))


def missing_nonzero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return only_missing(missing_counts(_holes(spark, sf_dir)))


def corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    holed = _holes(spark, sf_dir)
    return digits(correlations(holed, numeric_columns(holed)), ["correlation"])


def histogram_30(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every number of the line items; a constant column has one bin."""
    holed = _holes(spark, sf_dir)
    return digits(histogram(holed, numeric_columns(holed)), ["bin_low", "bin_high"])


def kde_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digits(kernel_density(table(spark, sf_dir, "events"), "value"), ["x", "density", "scaled"])


def kde_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return digits(
        kernel_density(lines, "l_extendedprice").withColumn("density", F.col("density") * 1e5),
        ["x", "density", "scaled"],
        4,
    )


def _by_year(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Line items with gaps, and the folder of a profile to which their years were added one after the other."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("year"), F.nullif(F.col("l_quantity"), F.lit(10.0)).alias("l_quantity"), "l_extendedprice",
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"),
    )
    folder = fresh_path(spark, "profile-state")
    add_parts(lines.filter("year < 1995"), _YEARLY, "year", folder)
    for later in ("year >= 1995", "year = 1996"):  # a year that is added again replaces itself
        add_parts(lines.filter(later), _YEARLY, "year", folder)
    return lines, folder


_YEARLY = ["l_quantity", "l_extendedprice", "l_tax"]


def profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of a table whose parts were profiled one by one."""
    lines, folder = _by_year(spark, sf_dir)
    return digits(merged_summary(spark, folder, lines), ["mean", "std", "min", "p25", "p50", "p75", "max"])


def corr_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digits(merged_correlations(spark, _by_year(spark, sf_dir)[1]), ["correlation"])


QUERIES = {
    "profile_merged": profile_merged,
    "corr_merged": corr_merged,
    "profile_numeric": profile_numeric,
    "profile_parts": profile_parts,
    "profile_missing": profile_missing,
    "missing_nonzero": missing_nonzero,
    "corr_matrix": corr_matrix,
    "histogram_30": histogram_30,
    "kde_200": kde_lines,
    "kde_events": kde_events,
}


def _summary_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""
        SELECT '{c}' AS column_name, count({c}) AS count, {q(f'avg({c})')} AS mean,
               {q(f'stddev_samp(CAST({c} AS DOUBLE))')} AS std, {q(f'min({c})')} AS min,
               {q(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)')} AS p25, {q(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)')} AS p50,
               {q(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)')} AS p75, {q(f'max({c})')} AS max
        FROM ({source})"""
        for c in columns
    )


def _missing_sql(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS missing_count FROM ({_HOLES})"
        for c in columns
    )


def _corr_sql(columns: list[str]) -> str:
    rows = []
    for a in columns:
        for b in columns:
            if a == b:
                value = f"CASE WHEN min({a}) < max({a}) THEN 1.0 END"
            elif "constant" in (a, b):
                value = "CASE WHEN count(*) < 0 THEN 0.0 END"
            else:
                value = f"corr({a}, {b})"
            rows.append(
                f"SELECT '{a}' AS column_a, '{b}' AS column_b, {q(value)} AS correlation FROM ({_HOLES})"
            )
    return " UNION ALL ".join(rows)


def _histogram_sql(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""
        SELECT '{c}' AS column_name, bin, {q('low + bin * ((high - low) / 30)')} AS bin_low,
               {q('low + (bin + 1) * ((high - low) / 30)')} AS bin_high, count(*) AS rows
        FROM (
            SELECT low, high,
                   CASE WHEN high > low THEN least(CAST(floor((x - low) / (high - low) * 30.0) AS INT), 29) ELSE 0 END AS bin
            FROM (SELECT CAST({c} AS DOUBLE) AS x, min(CAST({c} AS DOUBLE)) OVER () AS low,
                         max(CAST({c} AS DOUBLE)) OVER () AS high FROM ({_HOLES}) WHERE {c} IS NOT NULL)
        )
        GROUP BY low, high, bin"""
        for c in columns
    )


def _kde_sql(source: str, column: str, factor: str, places: int) -> str:
    return f"""
        WITH span AS (
            SELECT count({column}) AS n, min({column}) AS low, max({column}) AS high,
                   stddev_samp({column}) * pow(count({column}), -0.2) AS width
            FROM {source}
        ),
        grid AS (
            SELECT CAST(i AS INT) AS point, low + i * ((high - low) / 199) AS x, n, low, high, width
            FROM span, range(200) t(i)
        ),
        curve AS (
            SELECT g.point, g.x, any_value(g.n * (g.high - g.low) / 30) AS factor,
                   sum(exp(-0.5 * ((g.x - s.{column}) / g.width) * ((g.x - s.{column}) / g.width)))
                     / any_value(g.n * g.width * sqrt(2 * pi())) AS density
            FROM grid g, {source} s
            WHERE s.{column} IS NOT NULL
            GROUP BY g.point, g.x
        )
        SELECT point, {q('x', places)} AS x, {q(f'density * {factor}', places)} AS density,
               {q('density * factor', places)} AS scaled
        FROM curve
    """


_YEARLY_SQL = "SELECT nullif(l_quantity, 10) AS l_quantity, l_extendedprice, nullif(l_tax, 0) AS l_tax FROM lineitem"


def _corr_plain(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {q('1.0' if a == b else f'corr({a}, {b})')} AS correlation FROM ({source})"
        for a in columns for b in columns
    ).replace("(round(CAST(1.0 AS DOUBLE), 6) + 0.0) AS correlation FROM", "any_value(1.0::DOUBLE) AS correlation FROM")


ORACLES = {
    "profile_merged": f"""
        SELECT s.*, m.missing_count FROM ({_summary_sql(_YEARLY_SQL, _YEARLY)}) s JOIN (
            {' UNION ALL '.join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count FROM ({_YEARLY_SQL})" for c in _YEARLY)}
        ) m USING (column_name)
    """,
    "corr_merged": _corr_plain(_YEARLY_SQL, _YEARLY),
    "profile_numeric": _summary_sql(_HOLES, _HOLED_NUMBERS),
    "profile_parts": _summary_sql("SELECT * FROM part", ["p_partkey", "p_size", "p_retailprice"]),
    "profile_missing": _missing_sql(["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "constant"]),
    "missing_nonzero": f"""
        SELECT * FROM ({_missing_sql(["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "constant"])})
        WHERE missing_count > 0
    """,
    "corr_matrix": _corr_sql(_HOLED_NUMBERS),
    "histogram_30": _histogram_sql(_HOLED_NUMBERS),
    "kde_200": _kde_sql("lineitem", "l_extendedprice", "1e5", 4),
    "kde_events": _kde_sql("events", "value", "1.0", 6),
}
