"""Reading and writing tables.

State is kept in Parquet folders. A job returns new frames and the caller writes them: log-like
outputs are appended, by run where a run may be repeated; replaced state goes to a fresh folder, and a pointer that
readers follow is switched after it has been written, so that a failed run never leaves a half-written table behind.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class TableFolder:
    """Parquet tables lying side by side in one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        """The table as a frame; its schema is read from the files once."""
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]


def append_rows(frame: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Insert: add rows to a log-like table."""
    writer = frame.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def replace_partitions(frame: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions that occur in ``frame``."""
    (
        frame.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def append_once(frame: DataFrame, path: str, run: str, column: str = "run") -> None:
    """Insert that may be repeated: the rows of one run replace those that an earlier try of this run left.

    ``run`` names the run, as a date or a batch number does; rows of other runs are not touched. A try that
    failed leaves nothing behind, and a repeated one doubles nothing.
    """
    frame.withColumn(column, F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


POINTER = "_current"  # readers of Parquet skip names that begin with an underscore


def write_version(frame: DataFrame, base: str, version: str) -> str:
    """Write a whole new state beside the old one, then switch readers to it; returns its folder.

    Until the pointer is replaced, in one step, readers see the old state. What a try that stopped in
    between has written is replaced by the next try of the version. The current version is never written again.
    """
    spark, target = frame.sparkSession, f"{base.rstrip('/')}/version={version}"
    if current_version(spark, base) == version:
        raise ValueError(f"version {version} is in use")
    frame.write.mode("overwrite").parquet(target)
    _point_to(spark, base, version)
    return target


def read_version(spark: SparkSession, base: str) -> DataFrame:
    """The state that the pointer names."""
    version = current_version(spark, base)
    if version is None:
        raise FileNotFoundError(f"no version of {base} has been committed")
    return spark.read.parquet(f"{base.rstrip('/')}/version={version}")


def current_version(spark: SparkSession, base: str) -> str | None:
    """Name of the committed version, None before the first one."""
    jvm, pointer, files = _files(spark, f"{base.rstrip('/')}/{POINTER}")
    if not files.util().exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _point_to(spark: SparkSession, base: str, version: str) -> None:
    """Replace the pointer by a rename, which readers see before or after but never halfway."""
    jvm, pointer, files = _files(spark, f"{base.rstrip('/')}/{POINTER}")
    fresh = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{POINTER}-{uuid.uuid4().hex}")
    system = fresh.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    stream = system.create(fresh, True)
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(fresh, pointer, over)


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    configuration = spark._jsparkSession.sessionState().newHadoopConf()
    place = place.getFileSystem(configuration).makeQualified(place)
    return jvm, place, jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), configuration)


def export_csv(frame: DataFrame, path: str) -> None:
    """Bill rows for an insurer, as delimited text with a header."""
    frame.write.mode("overwrite").option("header", True).csv(path)
