"""Reading, writing and the streaming register."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from settleflow.sources import tables, work
from settleflow.sources.tables import (
    TableFolder, append_once, append_rows, current_version, export_csv, read_version, replace_partitions, write_version,
)
from settleflow.streaming.register import register_new_documents


def test_table_folder_and_pruned_scan(spark, small):
    orders = TableFolder(spark, small)("orders").select("o_orderkey").filter("o_orderkey > 10")
    plan = orders._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderkey,10)" in plan and "o_totalprice" not in plan


def test_append_and_replace(spark, tmp_path):
    path = str(tmp_path / "log")
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "i int, p string")
    append_rows(frame, path, ["p"])
    append_rows(frame.filter("i = 1"), path, ["p"])
    assert spark.read.parquet(path).count() == 3
    replace_partitions(spark.createDataFrame([(9, "a")], "i int, p string"), path, ["p"])
    assert sorted(r["i"] for r in spark.read.parquet(path).collect()) == [2, 9]


def test_readers_follow_the_committed_version(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "state")
    make = lambda *values: spark.createDataFrame([(v,) for v in values], "i int")
    seen = lambda: sorted(r["i"] for r in read_version(spark, base).collect())
    with pytest.raises(FileNotFoundError):
        read_version(spark, base)
    write_version(make(1), base, "1")
    assert seen() == [1] and current_version(spark, base) == "1"
    with pytest.raises(ValueError):
        write_version(make(9), base, "1")

    def stops(*_):
        raise RuntimeError("stopped between write and switch")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(tables, "_point_to", stops)
        write_version(make(2, 3), base, "2")
    assert seen() == [1] and current_version(spark, base) == "1"
    write_version(make(2, 4), base, "2")  # the next try replaces what was left
    assert seen() == [2, 4]
    assert spark.read.parquet(base).count() == 3  # the pointer is no table file


def test_a_repeated_append_doubles_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "i int, p string")
    append_once(rows, path, "2024-01-01")
    append_once(rows.filter("i = 1"), path, "2024-01-02")
    append_once(rows.filter("i = 1"), path, "2024-01-02")
    found = sorted((r["i"], str(r["run"])) for r in spark.read.parquet(path).collect())
    assert found == [(1, "2024-01-01"), (1, "2024-01-02"), (2, "2024-01-01")]


def test_csv_export(spark, tmp_path):
    export_csv(spark.createDataFrame([("BQ1", "ก")], "bill string, name string"), str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).first()["name"] == "ก"


def test_work_tables_lie_in_the_shared_folder(spark, monkeypatch):
    table = work.stored(spark.range(5), "five")
    assert table.inputFiles()[0].removeprefix("file://").startswith(spark.conf.get("spark.checkpoint.dir")) and table.count() == 5
    work.dropped(table)
    with pytest.raises(Exception):
        spark.read.parquet(table._stored_at).count()


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Session:
        class conf:
            get = staticmethod(lambda name, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError):
        work.work_folder(Session)


def test_register_stream_takes_each_document_once(spark, tmp_path):
    docs, claims, register, progress = (str(tmp_path / n) for n in ("docs", "claims", "register", "progress"))
    spark.createDataFrame([("c1",), ("c2",), ("c3",)], "claim_code string").write.parquet(claims)
    empty = spark.createDataFrame([("d0", "c3", 2, dt.datetime(2024, 1, 1), True)], "document_id string, claim_code string, status_id int, updated_at timestamp_ntz, is_active boolean")
    empty.write.parquet(register)
    schema = "document_id string, claim_code string, filed_at timestamp_ntz"

    def arrive(*rows):
        spark.createDataFrame([(d, c, dt.datetime(2024, 1, 2)) for d, c in rows], schema).write.mode("append").parquet(docs)
        query = register_new_documents(spark, docs, spark.read.schema(schema).parquet(docs).schema, claims, register, progress)
        query.awaitTermination(120)
        assert query.exception() is None
        return sorted(r["document_id"] for r in spark.read.parquet(register).collect())

    assert arrive(("d1", "c1"), ("d2", "c1"), ("d3", "unknown"), ("d4", "c3")) == ["d0", "d1", "d2"]
    assert arrive(("d5", "c2"), ("d6", "c1")) == ["d0", "d1", "d2", "d5"]
