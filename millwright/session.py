"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F


#: Folders of local sessions without ``spark.checkpoint.dir``, by application.
LOCAL_FOLDERS: dict[str, str] = {}


def local_session(cores: str = "8", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark. On a cluster the submitter builds it."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millwright")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> str:
    """Send this package to the Python workers, for sessions whose executors do not have it installed."""
    folder = Path(__file__).resolve().parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='ship-')}/millwright", "zip", folder.parent, folder.name)
    spark.sparkContext.addPyFile(archive)
    return archive


def spread(df: DataFrame, least: int = 0, like: DataFrame | None = None) -> DataFrame:
    """Deal the rows of a table as read over all cores when few splits hold most of them.

    For steps that compute long on each row. A row group is read by one task, so a file of one row group
    comes in one part, whatever its size and the number of its splits. The rows of the splits are counted without
    reading a column. Inputs that come evenly, or have fewer than ``least`` rows, are left as they are, so there nothing
    is shuffled. With ``like``, the table that ``df`` is an even part of, its rows are counted instead.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    held = (df if like is None else like).groupBy(F.spark_partition_id().alias("split")).count().agg(F.max("count").alias("most"), F.sum("count").alias("rows")).first()
    if not held.rows or held.rows < least or held.most * cores <= 2 * held.rows:
        return df
    parts = max(4 * cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
    place = "_place"
    while place in {c.lower() for c in df.columns}:
        place = f"_{place}"
    return df.withColumn(place, F.monotonically_increasing_id()).repartition(parts, place).drop(place)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting: there, and only there, a
    fresh folder on this machine is used and kept for the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in LOCAL_FOLDERS:
        LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="millwright-")
    return LOCAL_FOLDERS[application]


def application_dir(spark: SparkSession) -> str:
    """The part of the shared folder that only this application writes to."""
    return f"{shared_dir(spark).rstrip('/')}/millwright-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder; ``drop_intermediates`` deletes all of them."""
    return f"{application_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back: its lineage ends there."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_intermediates(spark: SparkSession) -> bool:
    """Delete everything this application wrote with ``fresh_path``; results not yet written are lost."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(application_dir(spark))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
