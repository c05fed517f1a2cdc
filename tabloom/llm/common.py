"""What the operators of this subpackage share: stored stages, files in the shared folder, text columns,
components of a link table."""

from __future__ import annotations

import re
import uuid
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: it is computed once, and a lost
    executor costs no more than its unfinished tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """A text column; a missing text is the empty one."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def bounded_batches(df: DataFrame, rows: int = 500, size: int = 4 << 20) -> DataFrame:
    """df, after limiting the Arrow batches of its session to so many rows and bytes: texts differ in length by orders
    of magnitude, and a batch of the default 10,000 of them is what a Python worker would have to hold."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    return df


def id_bucket(name: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % modulus


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a file:, hdfs:, s3: ... URI or of an absolute path."""
    from pyarrow import fs

    if not urlsplit(uri).scheme:
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    return fs.FileSystem.from_uri(uri)


def new_file(folder: str, kind: str) -> str:
    """A file name below folder that no other attempt of the same task uses. The rows that a task returns name
    its files, so only the files of the attempt that Spark accepted are ever read."""
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}.{kind}"


def write_file(uri: str, data: bytes) -> None:
    system, path = filesystem(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        out.write(data)


def spread(files: DataFrame, name: str) -> DataFrame:
    """A stored list of files over as many tasks as there are files, but no more than four waves of shuffle tasks:
    adaptive execution would put a list so short into one task."""
    waves = 4 * int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(max(1, min(files.count(), waves)), name)


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, component) for every node of links (a, b): component is the smallest reachable node.

    Alternates large-star and small-star steps: every node hooks its neighbours to the smallest of them, until the
    links are stars. The number of rounds is logarithmic in the longest path. A hot node is aggregated before the
    shuffle, its links are joined by the node itself, which adaptive execution can split. Every round is written to
    the shared folder.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), name)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        # A node hangs on a root if its only neighbour is smaller; stars are all there is if nothing else hangs anywhere.
        if not edges.join(least.filter("m < a AND n > 1"), "a", "left_semi").head(1):
            break
        large = (edges.select(F.col("b").alias("u"), F.col("a").alias("v")).join(least.select(F.col("a").alias("u"), F.least("a", "m").alias("m")), "u")
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small, "a")
        edges = stored(joined.select(F.inline(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))))
                       .filter("a <> b").distinct(), name)
    up = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return up.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
