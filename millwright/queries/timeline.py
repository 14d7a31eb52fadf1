"""Routes, matrices, timelines, clocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millwright.functions.columns import columns_by_role, require_columns, require_rows
from millwright.functions.text import digit_cells
from millwright.operators.timeline import check_jobs, matrix_long, matrix_lookup, operations_timeline, shop_floor, with_row_clock
from millwright.session import fresh_path
from millwright.sources.files import read_minutes, read_routes
from millwright.queries.views import LINE_ORDER, table


def flatten_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as jobs, their lines as operations: start time and place of every line."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("job_id"),
        "l_linenumber",
        "l_partkey",
        F.col("l_suppkey").alias("machine_id"),
        F.col("l_linenumber").alias("setup_time"),
        F.col("l_quantity").cast("int").alias("processing_time"),
    )
    return operations_timeline(
        lines, "job_id", ["l_linenumber", "l_partkey", "machine_id"], "setup_time", "processing_time"
    ).select("timestamp", "job_id", "task_id", "machine_id", "setup_time", "processing_time")


def route_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untidy route text to numbered machine visits: only digit cells count."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.concat(
            F.lit(" "), F.col("l_orderkey"), F.lit(", ,x,"), F.col("l_partkey"), F.lit(" ,-1,"),
            F.col("l_suppkey"), F.lit(",2.5,"),
        ).alias("line"),
    )
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.posexplode(digit_cells(F.col("line"))).alias("at", "machine_id")
    ).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("at") + 1).alias("task_id"), "machine_id"
    )


def matrix_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix_long(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cell per row of the matrix, at a place that depends on the row."""
    vectors = table(spark, sf_dir, "embeddings")
    wanted = vectors.select("vec_id", (F.lit(1) + F.col("vec_id") % 64).cast("int").alias("machine_id"))
    return matrix_lookup(wanted, vectors, "vec_id", "machine_id", "embedding", "minutes")


def row_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_row_clock(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), ["c_custkey"])


def row_clock_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with gaps: the clock goes on by one step per row all the same."""
    return with_row_clock(table(spark, sf_dir, "labels").select("doc_id", "quality"), ["doc_id"])


def row_clock_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered by a text whose values begin alike."""
    return with_row_clock(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), ["c_name"])


def row_clock_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A leading key with a handful of values: each fills many ranges and is cut along the next key."""
    lines = table(spark, sf_dir, "lineitem").select("l_linenumber", "l_orderkey", "l_partkey", "l_suppkey")
    return with_row_clock(lines, ["l_linenumber", "l_orderkey", "l_partkey", "l_suppkey"])


def _written(lines: DataFrame, spark: SparkSession, name: str) -> str:
    path = fresh_path(spark, name)
    lines.orderBy("vec_id").select("line").write.text(path)
    return path


def shop_floor_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as jobs: route and minute files are written, read by line number and unrolled."""
    vectors = table(spark, sf_dir, "embeddings")
    machine = lambda factor: (F.lit(1) + (F.col("vec_id") * factor) % 64).cast("string")
    route = F.when(F.col("label") == 0, F.lit("")).otherwise(
        F.concat_ws(",", machine(1), F.lit(" x"), machine(7), F.lit(""), F.concat(F.lit(" "), machine(11)))
    )

    def minutes(factor: int) -> DataFrame:
        cells = F.transform("embedding", lambda v: F.floor(F.abs(v.cast("double")) * factor).cast("string"))
        return vectors.select("vec_id", F.concat_ws(",", cells).alias("line"))

    return shop_floor(
        read_routes(spark, _written(vectors.select("vec_id", route.alias("line")), spark, "routes")),
        read_minutes(spark, _written(minutes(100), spark, "process")),
        read_minutes(spark, _written(minutes(10), spark, "setup")),
    )


def _raises(run) -> bool:
    try:
        run()
    except (KeyError, ValueError):
        return True
    return False


def guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each guard on tables that it must let through and on others that it must refuse, with the rows of the good one."""
    orders = table(spark, sf_dir, "orders")
    jobs = orders.select(F.col("o_orderkey").alias("job_id"))
    twice = jobs.unionAll(jobs.limit(1))
    headed = orders.select(F.col("o_totalprice").alias("Air temperature [K]"), F.col("o_orderkey").alias("UDI"))
    tried = {
        "row_count": (lambda: check_jobs(routes=jobs, process=jobs), lambda: check_jobs(routes=jobs, process=twice)),
        "required_columns": (lambda: require_columns(orders, ["o_orderkey", "o_custkey"]), lambda: require_columns(orders, ["o_orderkey", "no_such"])),
        "empty_input": (lambda: require_rows(orders), lambda: require_rows(orders.filter("o_orderkey < 0"))),
        "column_by_text": (lambda: columns_by_role(headed, {"air": "air temp"}), lambda: columns_by_role(headed, {"wear": "tool wear"})),
    }
    rows = orders.count()
    found = [(name, rows, not _raises(good), _raises(bad)) for name, (good, bad) in tried.items()]
    return spark.createDataFrame(found, "guard string, rows bigint, passes boolean, refuses boolean")


QUERIES = {
    "guards": guards,
    "shop_floor_files": shop_floor_files,
    "flatten_timeline": flatten_timeline,
    "route_parse": route_parse,
    "matrix_long": matrix_to_long,
    "matrix_lookup": lookup,
    "row_clock": row_clock,
    "row_clock_gaps": row_clock_gaps,
    "row_clock_text": row_clock_text,
    "row_clock_ties": row_clock_ties,
}

_CLOCK = """
    SELECT TIMESTAMP '2020-01-01 00:00:00'
             + to_seconds((row_number() OVER (ORDER BY {order}) - 1) * 10) AS "timestamp",
           {columns}
    FROM {table}
"""

ORACLES = {
    "guards": """
        SELECT guard, (SELECT count(*) FROM orders) AS rows, TRUE AS passes, TRUE AS refuses
        FROM (VALUES ('row_count'), ('required_columns'), ('empty_input'), ('column_by_text')) g(guard)
    """,
    "shop_floor_files": """
        WITH jobs AS (
            SELECT CAST(row_number() OVER (ORDER BY vec_id) AS INT) AS job_id, embedding,
                   CASE WHEN label = 0 THEN [] ELSE [1 + vec_id % 64, 1 + (vec_id * 7) % 64, 1 + (vec_id * 11) % 64] END AS route
            FROM embeddings
        ),
        visits AS (
            SELECT job_id, embedding, CAST(place AS INT) AS task_id, CAST(route[place] AS INT) AS machine_id
            FROM (SELECT *, unnest(range(1, len(route) + 1)) AS place FROM jobs)
        ),
        costs AS (
            SELECT job_id, task_id, machine_id,
                   CAST(floor(abs(CAST(embedding[machine_id] AS DOUBLE)) * 10) AS INT) AS setup_time,
                   CAST(floor(abs(CAST(embedding[machine_id] AS DOUBLE)) * 100) AS INT) AS processing_time
            FROM visits
        )
        SELECT TIMESTAMP '2020-01-01 00:00:00' + to_minutes(CAST(coalesce(sum(setup_time + processing_time) OVER (
                   PARTITION BY job_id ORDER BY task_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)) AS "timestamp",
               job_id, task_id, machine_id, setup_time, processing_time
        FROM costs
    """,
    "flatten_timeline": """
        SELECT TIMESTAMP '2020-01-01 00:00:00' + to_minutes(CAST(coalesce(sum(l_linenumber + CAST(l_quantity AS INT)) OVER before, 0) AS BIGINT))
                 AS "timestamp",
               l_orderkey AS job_id,
               CAST(row_number() OVER place AS INT) AS task_id,
               l_suppkey AS machine_id,
               l_linenumber AS setup_time,
               CAST(l_quantity AS INT) AS processing_time
        FROM lineitem
        WINDOW place AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey),
               before AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    """,
    "route_parse": f"""
        WITH cells AS (
            SELECT {LINE_ORDER},
                   [trim(c) FOR c IN string_split(concat(' ', l_orderkey, ', ,x,', l_partkey, ' ,-1,', l_suppkey, ',2.5,'), ',')
                    IF regexp_full_match(trim(c), '[0-9]+')] AS route
            FROM lineitem
        )
        SELECT {LINE_ORDER}, CAST(place AS INT) AS task_id, CAST(route[place] AS INT) AS machine_id
        FROM (SELECT *, unnest(range(1, len(route) + 1)) AS place FROM cells)
    """,
    "matrix_long": """
        SELECT vec_id, CAST(place AS INT) AS position, embedding[place] AS value
        FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS place FROM embeddings)
    """,
    "matrix_lookup": """
        SELECT vec_id, CAST(1 + vec_id % 64 AS INT) AS machine_id, embedding[1 + vec_id % 64] AS minutes FROM embeddings
    """,
    "row_clock": _CLOCK.format(order="c_custkey", columns="c_custkey, c_name", table="customer"),
    "row_clock_text": _CLOCK.format(order="c_name", columns="c_custkey, c_name", table="customer"),
    "row_clock_gaps": _CLOCK.format(order="doc_id", columns="doc_id, quality", table="labels"),
    "row_clock_ties": _CLOCK.format(
        order="l_linenumber, l_orderkey, l_partkey, l_suppkey",
        columns="l_linenumber, l_orderkey, l_partkey, l_suppkey",
        table="lineitem",
    ),
}
