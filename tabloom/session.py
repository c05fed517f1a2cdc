"""Session defaults, and the shared folder that pinned tables are written to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks on one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tabloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.files.openCostInBytes", str(1 << 20))
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="tabloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def row_bytes(df: DataFrame) -> Column:
    """Estimated bytes of a row in memory: a fixed width plus what texts and arrays hold."""
    size = F.lit(16 * len(df.columns))
    for f in df.schema.fields:
        name = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(name), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
            size = size + F.coalesce(F.size(name), F.lit(0)) * 64
    return size.cast("long")


def pin(df: DataFrame) -> DataFrame:
    """Write df to reliable storage once, so that every later use sees the same rows and
    partition numbers, whatever executors are lost in between."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def driver_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of rows that the driver made, whose number is therefore known."""
    df = spark.createDataFrame(rows, schema)
    df._measured = (len(rows), 256 * len(rows))
    return df


def measured_size(df: DataFrame, up_to: int) -> tuple[int, int]:
    """(rows, bytes) of a table, remembered on the frame: two sums that every task makes of its own rows."""
    known = getattr(df, "_measured", None)
    if known is None:
        rows, size = df.agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
        known = df._measured = (rows, size or 0)
    return known
