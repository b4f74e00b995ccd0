"""Helpers on literal frames, with skewed keys and against brute force."""

import datetime as dt
import os
import random
import re
import subprocess
import sys
import tempfile
from decimal import Decimal as D
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from settleflow.functions import scalars as S
from settleflow.functions.codes import running_codes
from settleflow.operators import numbering, packing, state
from settleflow.operators.aggregates import distinct_text, first_row_per_group, latest_per_key, ordered_lines, text_list
from settleflow.operators.filters import code_list, half_open, keep_where
from settleflow.operators.joins import or_join, values_table
from settleflow.operators.numbering import REPEATED, global_dense_rank, global_row_number, keyed_row_number, places
from settleflow.operators.numbering import small as numbering_small
from settleflow.operators.packing import next_fit
from settleflow.operators.paging import page, sort_columns


@pytest.fixture
def many_partitions(spark):
    """Small data in many partitions, as large data would lie."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def brute_next_fit(amounts, ceiling):
    group, total, out = 1, D(0), []
    for amount in amounts:
        if total + amount > ceiling:
            group, total = group + 1, D(0)
        total += amount
        out.append(group)
    return out


def test_next_fit_example(spark):
    frame = spark.createDataFrame([("a", i, D(x)) for i, x in enumerate([40, 70, 30, 30])], "k string, i int, x decimal(16,2)")
    assert [r[1] for r in rows(next_fit(frame, "k", ["i"], F.col("x"), 100), "i", "group_no")] == [1, 2, 2, 3]


def test_next_fit_first_item_above_ceiling_opens_group_two(spark):
    frame = spark.createDataFrame([("a", 1, D(150)), ("a", 2, D(10))], "k string, i int, x decimal(16,2)")
    assert [r[1] for r in rows(next_fit(frame, "k", ["i"], F.col("x"), 100), "i", "group_no")] == [2, 3]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_next_fit_splits_one_large_list(spark, many_partitions, seed):
    rng = random.Random(seed)
    data = [("hot", i, D(rng.randint(1, 9000)) / 100) for i in range(4000)]
    data += [(f"k{i % 300}", i, D(rng.randint(1, 9000)) / 100) for i in range(3000)]
    rng.shuffle(data)
    frame = spark.createDataFrame(data, "k string, i int, x decimal(16,2)")
    # the large list really lies in several partitions
    assert places(frame, ["k", "i"]).filter("k = 'hot'").select("_part").distinct().count() > 2
    got = {(r["k"], r["i"]): r["group_no"] for r in next_fit(frame, "k", ["i"], F.col("x"), 100, piece=150).collect()}
    for key in {k for k, _, _ in data}:
        mine = sorted((i, x) for k, i, x in data if k == key)
        want = brute_next_fit([x for _, x in mine], D(100))
        assert [got[(key, i)] for i, _ in mine] == want


@pytest.mark.parametrize("piece", [1, 7, 100, 100_000])
def test_next_fit_small_steps_travel_far(spark, many_partitions, piece):
    # amounts that never fall into step with a fresh start
    data = [("hot", i, D("33.33") if i % 7 else D("0.01")) for i in range(800)]
    frame = spark.createDataFrame(data, "k string, i int, x decimal(16,2)")
    got = [r[1] for r in rows(next_fit(frame, "k", ["i"], F.col("x"), 1000, piece=piece), "i", "group_no")]
    assert got == brute_next_fit([x for _, _, x in data], D(1000))


@pytest.mark.parametrize("low", [0, -40])
def test_next_fit_of_odd_amounts(spark, many_partitions, low):
    """NULL amounts count as nothing; amounts above the ceiling, zero and, in one run, below zero; a list without a key."""
    rng = random.Random(low)
    data = [(rng.choice([None, "a", "b", "c"]), i, rng.choice([None, D(0), D(250), D(100)] + [D(rng.randint(low * 100, 9000)) / 100] * 6)) for i in range(900)]
    frame = spark.createDataFrame(data, "k string, i int, x decimal(16,2)").withColumn("note", F.lit("kept")).withColumn("_at", F.lit(1))
    for piece in (2, 64, 100_000):
        got = {r["i"]: r["group_no"] for r in next_fit(frame, "k", ["i"], F.col("x"), 100, piece=piece).collect()}
        for key in (None, "a", "b", "c"):
            mine = [(i, x or D(0)) for k, i, x in data if k == key]
            assert [got[i] for i, _ in mine] == brute_next_fit([x for _, x in mine], D(100))


def test_steps_give_the_walk_from_every_total():
    rng = random.Random(3)
    for low in (0, -30):
        for _ in range(40):
            cents = np.array([rng.randint(low, 60) for _ in range(rng.randint(1, 25))])
            steps = packing._steps(cents, 100)
            for total in range(0, 101, 3):
                sums, opened = total, 0
                for x in cents.tolist():
                    if sums + x > 100:
                        sums, opened = 0, opened + 1
                    sums += x
                _, ends, groups, moves = [s for s in steps if s[0] <= total][-1]
                assert (total + ends if moves else ends, groups) == (sums, opened)


def test_packing_runs_in_workers_without_the_library(tmp_path):
    """Started from another folder, with the library on the driver's path only."""
    code = ("import sys; sys.path.insert(0, %r)\n"
            "from settleflow.session import build_session\nfrom settleflow.operators.packing import next_fit\nfrom pyspark.sql import functions as F\n"
            "spark = build_session('t', 'local[2]', **{'spark.ui.enabled': 'false', 'spark.checkpoint.dir': %r})\n"
            "frame = spark.range(50).select(F.lit(1).alias('k'), F.col('id').alias('i'), F.lit(30).cast('decimal(16,2)').alias('x'))\n"
            "print(next_fit(frame, 'k', ['i'], F.col('x'), 100).agg(F.max('group_no')).first()[0])\n") % (str(Path(__file__).parent.parent), str(tmp_path / "shared"))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.split()[-1:] == ["17"], done.stderr[-2000:]


def test_next_fit_of_nothing(spark):
    frame = spark.createDataFrame([], "k string, i int, x decimal(16,2)")
    assert next_fit(frame, "k", ["i"], F.col("x"), 100).count() == 0


@pytest.mark.parametrize("partitions", ["1", "6", "200"])
def test_numbering_does_not_depend_on_partitions(spark, many_partitions, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        data = [("hot" if i % 3 else f"k{i % 5}", i) for i in range(2000)]
        frame = spark.createDataFrame(data, "k string, i int")
        number = {(k, i): n for k, i, n in rows(global_row_number(frame, ["k", "i"]), "k", "i", "row_no")}
        assert number == {pair: n for n, pair in enumerate(sorted(data), 1)}
        keyed = {(k, i): n for k, i, n in rows(keyed_row_number(frame, ["k"], ["i"]), "k", "i", "row_no")}
        for key in {k for k, _ in data}:
            mine = sorted(i for k, i in data if k == key)
            assert [keyed[(key, i)] for i in mine] == list(range(1, len(mine) + 1))
        ranks = dict(rows(global_dense_rank(frame, ["k"]).select("k", "rank_no").distinct(), "k", "rank_no"))
        assert ranks == {k: n for n, k in enumerate(sorted({k for k, _ in data}), 1)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_numbering_keeps_only_keys_and_uses_the_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(tempfile, "mkdtemp", lambda *a, **k: pytest.fail("a machine-local folder"))
    frame = spark.range(500).select((F.col("id") % 7).alias("k"), "id", F.lit("wide").alias("a"), F.lit("wide").alias("b"))
    plan = keyed_row_number(frame, ["k"], ["id"])._jdf.queryExecution().optimizedPlan().toString()
    reads = [line for line in plan.splitlines() if "Relation [" in line]
    assert reads and not any(re.search(r"\b[ab]#", line) for line in reads)
    assert places(frame, ["k", "id"]).inputFiles()[0].removeprefix("file://").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_rows_that_the_order_does_not_tell_apart_are_refused(spark):
    frame = spark.createDataFrame([(1, "x"), (1, "y")], "i int, v string")
    with pytest.raises(Exception, match=REPEATED):
        global_row_number(frame, ["i"]).collect()


def test_whole_rows_are_placed_without_a_join(spark):
    frame = spark.range(60).select((F.col("id") % 7).alias("k"), "id", F.lit("wide").alias("a"), F.lit(None).alias("nothing"))
    out = keyed_row_number(frame.drop("nothing"), ["k"], ["id"], whole=True)
    assert out.columns == ["k", "id", "a", "row_no"] and rows(out, "k", "id", "row_no") == [(k, i, i // 7 + 1) for k in range(7) for i in range(k, 60, 7)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (" not in plan and plan.count("Join ") == 1  # the spans
    assert keyed_row_number(frame, ["k"], ["id"], whole=True).count() == 60  # a column without a type cannot be stored
    assert places(frame, ["k", "id"], ["a"]).columns == ["k", "id", "a", "_part", "_at"]


def test_spans_that_are_too_many_to_send_are_joined(spark, monkeypatch):
    frame = spark.range(300).select((F.col("id") % 40).alias("k"), "id")
    monkeypatch.setattr(numbering, "small", lambda table: numbering_small(table, 10))
    found = rows(keyed_row_number(frame, ["k"], ["id"]), "k", "id", "row_no")
    assert found == [(k, i, i // 40 + 1) for k in range(40) for i in range(k, 300, 40)]


def test_running_codes_do_not_shuffle_by_prefix(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet").select("o_orderkey", "o_totalprice", F.lit("P").alias("prefix"))
    counters = spark.createDataFrame([("P", "68", "05", 3)], "prefix string, year string, month string, running int")
    coded, _ = running_codes(orders, "prefix", ["o_orderkey"], 8, dt.date(2025, 5, 9), counters)
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\((prefix|_key_prefix)#\w+, \d+\)", plan)
    assert coded.agg(F.count_distinct("code"), F.min("code"), F.max("code")).first()[:2] == (orders.count(), "P680500000004")


def test_keyed_numbering_with_null_key(spark):
    frame = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, i int")
    assert rows(keyed_row_number(frame, ["k"], ["i"]), "i", "row_no") == [(1, 1), (2, 2), (3, 1)]


def test_or_join_matches_like_a_disjunction(spark):
    left = spark.createDataFrame([(1, 10, 20), (2, 10, 10), (3, None, 20), (4, 99, 98), (5, None, None), (6, 98, 10)], "id int, a int, b int")
    right = spark.createDataFrame([(10, "x"), (20, "y"), (30, "z")], "k int, name string")
    want = left.join(right, (right.k == left.a) | (right.k == left.b), "left")
    assert rows(or_join(left, right, ["a", "b"], "k").fillna("-"), "id", "name") == rows(want.fillna("-"), "id", "name")


def test_text_lists_and_ordered_lines_are_whole(spark, many_partitions):
    data = [("hot", i, f"v{i}") for i in range(5000)] + [("one", 1, "x"), ("two", 2, "b"), ("two", 1, "a"), (None, 2, "z"), (None, 1, "y"), ("none", 1, None), ("part", 1, None), ("part", 2, "")]
    frame = spark.createDataFrame(data, "k string, o int, v string").repartition(7)
    got = {r["k"]: r["t"] for r in text_list(frame, ["k"], "v", ["o"], ",", "t").collect()}
    assert got == {"hot": ",".join(f"v{i}" for i in range(5000)), "one": "x", "two": "a,b", None: "y,z", "part": ""}
    same = {r["k"]: r["t"] for r in text_list(frame.withColumnRenamed("v", "o2"), ["k"], "o2", ["o"], ",", "t").collect()}
    assert same == got
    lines = [(r["o"], r["v"]) for r in ordered_lines(frame, ["k"], ["o"]).filter("k = 'hot'").orderBy("line_no").collect()]
    assert lines == [(i, f"v{i}") for i in range(5000)]


def test_rank_filter_limits_before_the_shuffle(spark, small):
    frame = spark.read.parquet(f"{small}/lineitem.parquet")
    plan = latest_per_key(frame, ["l_returnflag"], [F.col("l_shipdate").desc(), "l_orderkey"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_no_global_window_over_the_data(spark, small):
    frame = spark.read.parquet(f"{small}/orders.parquet").select("o_orderkey")
    plan = global_row_number(frame, ["o_orderkey"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan  # the table of spans was made before


def test_first_row_and_distinct_text(spark):
    frame = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 5, "z"), ("b", 6, "z")], "k string, o int, v string")
    assert rows(first_row_per_group(frame, ["k"], ["o"]), "k", "v") == [("a", "x"), ("b", "z")]
    assert rows(distinct_text(frame, ["k"], "v", ",", "t"), "k", "t") == [("a", "x,y"), ("b", "z")]


def test_filters(spark):
    frame = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2, 23, 59)), (3, dt.datetime(2024, 1, 3))], "i int, t timestamp_ntz")
    assert [r[0] for r in rows(frame.filter(half_open("t", "2024-01-01", "2024-01-02")), "i")] == [1, 2]
    assert frame.filter(half_open("t", None, None)).count() == 3
    assert keep_where(frame, i=[1, 3]).count() == 2 and keep_where(frame, i=None).count() == 3
    assert [r[0] for r in rows(code_list(spark, "b, a,,b , ", "code"), "code")] == ["a", "b"]


def test_sort_and_page(spark):
    frame = spark.createDataFrame([(i, i % 3, None if i == 4 else i) for i in range(25)], "i int, g int, x int")
    default = [F.col("i").asc()]
    cut = page(frame, sort_columns(None, "ASC", {"x": "x"}, default, []), 20, 10)
    assert [(r["i"], r["total_count"]) for r in cut.collect()] == [(i, 25) for i in range(20, 25)]
    assert page(frame, sort_columns("x", "ASC", {"x": "x"}, default, ["i"])).first()["i"] == 4
    with pytest.raises(ValueError):
        sort_columns("drop table", "ASC", {"x": "x"}, default, [])


# ---- state changes

def test_update_keeps_others_and_raises_on_two_changes(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = state.update_rows(old, spark.createDataFrame([(2, None)], "k int, v string"), ["k"])
    assert {r["k"]: r["v"] for r in new.collect()} == {1: "a", 2: None}
    double = spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string")
    with pytest.raises(Exception, match="more than one change"):
        state.update_rows(old, double, ["k"]).collect()


def test_upsert_delete_and_soft_delete(spark):
    old = spark.createDataFrame([(1, "a", True), (2, "b", True)], "k int, v string, is_active boolean")
    new = spark.createDataFrame([(2, "B", True), (3, "C", True)], "k int, v string, is_active boolean")
    assert rows(state.upsert_rows(old, new, ["k"]), "k", "v") == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(state.delete_then_insert(old, new, ["k"]), "k", "v") == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(state.soft_delete(old, new, ["k"]), "k", "is_active") == [(1, True), (2, False)]
    assert rows(state.consume_rows(old, new, ["k"]), "k") == [(1,)]


# ---- scalar functions

def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return frame.select(column.alias("x")).first()["x"]


def test_due_date_each_weekday(spark):
    for day in range(1, 15):
        start = dt.date(2024, 9, day)
        weekday = start.isoweekday() % 7 + 1
        assert one(spark, S.due_date(F.lit(start))) == start + dt.timedelta(days=19 + (weekday >= 3))
        count, at = 0, start
        while count < 15:
            at += dt.timedelta(days=1)
            count += at.isoweekday() <= 5
        assert one(spark, S.due_date(F.lit(start), working_days=True)) == at


def test_due_date_other_lengths(spark):
    for days in (1, 4, 6, 11):
        for day in range(1, 8):
            start, count = dt.date(2024, 9, day), 0
            at = start
            while count < days:
                at += dt.timedelta(days=1)
                count += at.isoweekday() <= 5
            assert one(spark, S.due_date(F.lit(start), days, working_days=True)) == at
    # a remainder of zero: a Friday start gets the extra day
    assert one(spark, S.due_date(F.lit(dt.date(2024, 9, 6)), 6)) == dt.date(2024, 9, 6) + dt.timedelta(days=9)


def test_text_functions(spark):
    assert one(spark, S.join_text(F.lit("a"), F.lit(None), F.lit(1))) == "a1"
    assert one(spark, F.concat(F.lit("a"), F.lit(None).cast("string"))) is None
    assert one(spark, S.zero_pad(F.lit(42), 5)) == "00042" and one(spark, S.zero_pad(F.lit(123456), 3)) == "123456"
    assert one(spark, S.code_part(F.lit("A-1-2-3"), 4)) == "A" and one(spark, S.code_part(F.lit("A-1-2"), 4)) is None
    assert one(spark, S.code_part(F.lit("A-1-2-3-4"), 1)) is None
    assert one(spark, S.code_part_int(F.lit("A-x-2-3"), 3)) is None and one(spark, S.code_part_int(F.lit("A-07-2-3"), 3)) == 7
    assert one(spark, S.buddhist_year2(F.lit(dt.date(2025, 5, 1)))) == "68"
    assert one(spark, S.link_token(F.lit("CL1"))) == "Q0wx"
    assert one(spark, S.if_null(F.lit(None).cast("string"), "abc", "string")) == "abc"
    assert one(spark, S.messages((F.lit(True), "a"), (F.lit(None).cast("boolean"), "b"), (F.lit(True), "c"))) == "a, c"


def test_running_codes_are_gapless_and_continue(spark):
    data = spark.createDataFrame([("P", i) for i in range(50)] + [("Q", i) for i in range(3)], "prefix string, i int")
    counters = values_table(spark, ["prefix", "year", "month", "running"], [("P", "68", "05", 7), ("P", "68", "04", 99), ("Q", "67", "05", 4)])
    coded, raised = running_codes(data, "prefix", ["i"], 4, dt.date(2025, 5, 9), counters)
    assert [r[0] for r in rows(coded, "code")] == [f"P6805{n:04d}" for n in range(8, 58)] + [f"Q6805{n:04d}" for n in (1, 2, 3)]
    assert rows(raised, "prefix", "year", "month", "running") == [("P", "68", "05", 57), ("Q", "68", "05", 3)]
    yearly, _ = running_codes(data.filter("prefix = 'Q'"), "prefix", ["i"], 5, dt.date(2025, 5, 9), counters, with_month=False)
    assert [r[0] for r in rows(yearly, "code")] == [f"Q68{n:05d}" for n in (1, 2, 3)]
