"""The derived tables: how many rows one task groups or sorts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from qalake import adapter


def _tables(spark, path, lines=6000):
    """Orders of one to six lines, with keys that repeat and null ones; the other tables are small."""
    day = dt.datetime(1997, 1, 1)
    line = [(None if i % 501 == 0 else i // 3 % 1900, i, i % 40, i % 8, float(i % 50), "RNA"[i % 3], day + dt.timedelta(days=i % 90))
            for i in range(lines)]
    order = [(None if i % 701 == 0 else i, i % 60, "FOP"[i % 3], 1000.0 * i, day, f"{1 + i % 4}-HIGH") for i in [*range(2000), *range(50)]]
    made = {
        "lineitem": (line, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp_ntz"),
        "orders": (order, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "customer": ([(1, 5.0, "c")], "c_custkey long, c_acctbal double, c_name string"),
        "events": ([(1, "click", day, 3)], "event_id long, event_type string, ts timestamp_ntz, user_id long"),
        "documents": ([(1, 9, "text")], "doc_id long, n_chars int, text string")}
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")


def _most_rows(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("task_rows", [300, 500])
def test_tasks_stay_small_and_rows_the_same(spark, tmpdir_path, monkeypatch, task_rows):
    _tables(spark, tmpdir_path)
    with_all = adapter.load(spark, tmpdir_path)
    want = {n: sorted(map(str, getattr(with_all, n).collect())) for n in ("posts", "answers")}
    monkeypatch.setattr(adapter, "TASK_ROWS", task_rows)
    qa = adapter.load(spark, tmpdir_path)
    for name, rows in want.items():
        assert sorted(map(str, getattr(qa, name).collect())) == rows
    assert _most_rows(qa.answers) <= 2 * task_rows
    plan = adapter.load(spark, tmpdir_path).answers._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial" in plan.split("Exchange")[0]  # grouped behind the shuffle only


def test_small_tables_are_not_dealt(spark, tmpdir_path):
    _tables(spark, tmpdir_path, 600)
    assert "REPARTITION" not in adapter.load(spark, tmpdir_path).posts._jdf.queryExecution().executedPlan().toString()
