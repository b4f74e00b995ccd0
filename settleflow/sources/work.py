"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_written: dict[str, None] = {}


def work_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names. Only a local session may do without: it gets one of its own.

    A cluster run without a shared folder is an error: files in a machine-local one are lost with their
    machine and seen by no other.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    own = tempfile.mkdtemp(prefix="settleflow-work-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage and freezes the rows: a lost executor takes nothing with it, and later steps read only
    the columns they use. ``dropped`` removes a table that has been consumed; the rest goes when the driver ends.
    """
    path = f"{work_folder(frame.sparkSession)}/settleflow-{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_clean)
    _written[path] = None
    frame.write.parquet(path)
    table = frame.sparkSession.read.schema(frame.schema).parquet(path)
    table._stored_at = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Remove stored tables that no later step reads."""
    for table in tables:
        path = getattr(table, "_stored_at", None)
        if path in _written:
            _delete(path)
            del _written[path]


def _delete(path: str) -> None:
    jvm = SparkContext._gateway.jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(SparkSession.getActiveSession()._jsparkSession.sessionState().newHadoopConf()
                        if SparkSession.getActiveSession() else jvm.org.apache.hadoop.conf.Configuration()).delete(place, True)


def _clean() -> None:
    for path in _written:
        try:
            _delete(path)
        except Exception:  # the JVM has already gone; what is left is in the shared work folder
            return
