"""CSV scans and sinks, Parquet stages."""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..columns import col, listed, nan_to_null


# Quotes are doubled, as other tools write them. A missing value is an empty field and an empty text is written as "".
# A reader tells the two apart only if its own mark of a missing value is another text: \N, which is missing too.
_DIALECT = {"header": True, "encoding": "UTF-8", "quote": '"', "escape": '"', "nullValue": "", "emptyValue": '""'}


def _reader(multi_line: bool) -> dict:
    """Options of a scan. With multi_line a quoted value may hold line breaks, and a file is then one task; without, a
    file is split, and must hold a row to a line."""
    return {**_DIALECT, "nullValue": "\\N", "emptyValue": "", "multiLine": multi_line}


def csv_scan_typed(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = True) -> DataFrame:
    """CSV with a header and declared column types: no inference pass over the file."""
    return nan_to_null(spark.read.schema(schema).csv(path, enforceSchema=False, **_reader(multi_line)))


def csv_scan_inferred(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV with a header; types are inferred, which costs a second read of the file."""
    return nan_to_null(spark.read.csv(path, inferSchema=True, **_reader(multi_line)))


def csv_scan_renamed(spark: SparkSession, path: str, names: Sequence[str], multi_line: bool = True) -> DataFrame:
    """CSV whose header row is discarded in favour of the given names, by position."""
    return nan_to_null(spark.read.csv(path, inferSchema=True, **_reader(multi_line)).toDF(*names))


def csv_sink(df: DataFrame, path: str, stamp: bool = False) -> str:
    """Write CSV part files with a header; stamp appends the run time to the name. Missing and empty texts and line
    breaks come back from the scans above."""
    target = f"{path}_{time.strftime('%Y%m%d_%H%M%S')}" if stamp else path
    df.write.options(**_DIALECT, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(target)
    return target


def parquet_scan(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with NaN read as missing."""
    return nan_to_null(spark.read.parquet(path))


def stage_snapshot(df: DataFrame | None, path: str, source: str, spark: SparkSession | None = None) -> DataFrame:
    """A stage below path: 'function' computes, stores and reads it, 'stored' only reads it, 'fresh' reads it if it still says what df
    would, and otherwise computes it.

    The rows go to a folder of their own, and a manifest that names it is renamed into place after they all are written: until then,
    and if the writing fails, the stage is the one before. The manifest also holds the schema and fingerprints of df's plan and
    input files (paths, sizes, times of change). 'stored' refuses a stage without a manifest and, given df, one of other
    input, another plan or another schema.
    """
    if source not in ("function", "stored", "fresh"):
        raise ValueError(f"unknown source: {source}")
    session = spark or (df.sparkSession if df is not None else SparkSession.getActiveSession())
    stages = _Stages(session, path)
    if df is None and source != "stored":
        raise ValueError("a frame is needed to store the stage")
    held = stages.manifest()
    wanted = None if df is None else _fingerprint(df)
    if source == "function" or source == "fresh" and (held is None or stale_parts(held, wanted)):
        held = stages.store(df, wanted, held)
    elif held is None:
        raise ValueError(f"no finished stage at {path}")
    elif wanted and (parts := stale_parts(held, wanted)):
        raise ValueError(f"the stage at {path} is stale: other {', '.join(parts)}")
    return parquet_scan(session, f"{path.rstrip('/')}/{held['rows']}")


def stale_parts(held: dict, wanted: dict) -> list[str]:
    """What a manifest and a fingerprint do not agree in."""
    return [k for k in ("schema", "plan", "input") if held[k] != wanted[k]]


def _fingerprint(df: DataFrame) -> dict[str, str]:
    """Schema, plan (without the numbers of its expressions) and input files of a frame."""
    spark = df.sparkSession
    plan = re.sub(r"#\d+L?|\bplan_id=\d+", "", df._jdf.queryExecution().analyzed().canonicalized().toString())
    files = []
    for name in sorted(df.inputFiles()):
        where = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI.create(name))
        status = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where)
        files.append(f"{name} {status.getLen()} {status.getModificationTime()}")
    return {"schema": df.schema.json(), "plan": hashlib.sha256(plan.encode()).hexdigest(),
            "input": hashlib.sha256("\n".join(files).encode()).hexdigest()}


class _Stages:
    """The folder of a stage: rows-<id> folders and the manifest that names the one that counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def manifest(self) -> dict | None:
        where = self._at("manifest.json")
        if not where.getFileSystem(self.conf).exists(where):
            return None
        return json.loads(self.spark.read.text(where.toString(), wholetext=True).first()[0])

    def store(self, df: DataFrame, fingerprint: dict, before: dict | None) -> dict:
        name = f"rows-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{name}")
        held = {**fingerprint, "rows": name, "before": before["rows"] if before else None}
        draft, place = self._at(f"manifest-{uuid.uuid4().hex}.draft"), self._at("manifest.json")
        files = draft.getFileSystem(self.conf)
        out = files.create(draft, True)
        out.write(bytearray(json.dumps(held).encode()))
        out.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self.conf).rename(draft, place, how)
        # The stage before stays for those who still read it; the one before that goes.
        if before and before.get("before"):
            files.delete(self._at(before["before"]), True)
        return held


def preview_shape(df: DataFrame, n: int, order: str | Sequence[str]) -> tuple[DataFrame, int, int]:
    """First n rows in the given order, number of rows, number of columns."""
    head = df.orderBy(*[col(c).asc_nulls_last() for c in listed(order)]).limit(n)
    return head, df.count(), len(df.columns)
