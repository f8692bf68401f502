"""Ingest loses nothing in silence: counts, bad bytes, typed keys, repeats; scan and pattern plans."""

import logging

import pytest
from pyspark.sql import functions as F

from qalake.operators import staging, tables
from qalake.pipeline import PipelineArgs, run_pipeline, staged_manifest
from qalake.plans import content, timeline
from qalake.sources import dump
from qalake.specs import spec

TAGS = """<?xml version="1.0" encoding="utf-8"?>
<tags>
  <row Id="1" TagName="a" Count="1" />
  <row
 Id="2" TagName="b" Count="2" />
  <row Id="3"
 TagName="c" Count="3" />
</tags>
"""


def _args(tmp, **more):
    return PipelineArgs(source_dir=str(tmp / "src"), staging_dir=str(tmp / "staged"), tables=("tags",),
                        warehouse_dir=str(tmp / "wh"), **more)


def test_pipeline_warns_and_records_lost_rows(spark, tmp_path, caplog):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "Tags.xml").write_text(TAGS)
    with caplog.at_level(logging.WARNING, logger="qalake"):
        assert run_pipeline(spark, _args(tmp_path, site="lossy")) == {"tags": 2}
    assert "found 3 row(s), parsed 2, 1 of them without their end" in caplog.text
    m = staging.read_manifest(spark, staged_manifest(spark, str(tmp_path / "staged/lossy/tags")))
    assert (m.found_rows, m.total_rows, m.cut_rows) == (3, 2, 1)
    caplog.clear()
    with caplog.at_level(logging.WARNING, logger="qalake"):
        assert run_pipeline(spark, _args(tmp_path, site="whole", wrapped=True)) == {"tags": 3}
    assert "row(s)" not in caplog.text
    got = {(r["id"], r["tag_name"]) for r in spark.table("whole.tags").collect()}
    assert got == {(1, "a"), (2, "b"), (3, "c")}


def test_bad_bytes_fail(spark, tmp_path):
    (tmp_path / "Tags.xml").write_bytes(b'<row Id="1" TagName="a\xff\xfeb" Count="1" />\n')
    with pytest.raises(Exception, match="UTF8|UTF-8"):
        dump.read_dump(spark, str(tmp_path / "Tags.xml"), spec("tags")).collect()


def test_scan_has_one_regex_pass_and_no_python(spark, tmp_path):
    (tmp_path / "Tags.xml").write_text(TAGS)
    df = dump.read_dump(spark, str(tmp_path / "Tags.xml"), spec("tags"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("regexp_extract_all(") <= 2


def test_keys_are_compared_as_numbers(spark):
    df = spark.createDataFrame([("1",), ("01",), (" 1",), ("2",), ("x",), ("x",), (None,)], "id string")
    assert {tuple(r) for r in staging.duplicate_keys(df, "id").collect()} == {("1", 3), ("x", 2)}


def test_repeats_within_loaded_rows_are_rejected(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS repeats")
    name = tables.create_table(spark, spec("tags"), "repeats", str(tmp_path / "tags"))
    rows = spark.createDataFrame([(5, "a"), (5, "b")], "id int, tag_name string")
    rows = rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in spark.table(name).schema])
    for first in (False, True):
        with pytest.raises(ValueError, match="duplicate key"):
            tables.save_table(rows, spark, name, truncate_first=first, key="id")


@pytest.mark.parametrize("site, hits", [("abc!", {2}), ("a!%b", {3}), ("a_c", {1, 2}), ("abc", {1, 2}), ("a!!b", {4})])
def test_site_is_part_of_one_like_pattern(spark, site, hits):
    ts = F.lit("2020-01-10 00:00:00").cast("timestamp_ntz")
    users = spark.createDataFrame([(9, f"https://{site}/")], "id int, website_url string")
    posts = spark.createDataFrame([(1, 1, "see abc now"), (2, 1, "ends in abc%"), (3, 1, "xa%by"), (4, 1, "a!b")],
                                  "id int, owner_user_id int, body string").withColumn("last_activity_date", ts)
    comments = spark.createDataFrame([], "post_id int, user_id int, text string, creation_date timestamp_ntz")
    comments = comments.unionAll(spark.range(1).select(F.lit(1), F.lit(1), F.lit("none"), ts))
    got = content.q30_vanity_search(users, posts, comments, me=9).collect()
    assert {r["post_id"] for r in got} == hits


def test_date_bound_reaches_the_scan(spark, tmp_path):
    posts = spark.range(1000).select(F.col("id").cast("int"), F.lit(None).cast("int").alias("parent_id"),
                                     (F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))).alias("creation_date"))
    posts.write.parquet(str(tmp_path / "posts"))
    df = timeline.q16_monthly_totals(spark.read.parquet(str(tmp_path / "posts")))
    df.collect()
    # the bound is a scalar subquery: the scan gets its value when it runs
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = [x.split("], ", 1)[0] for x in plan.split("DataFilters: [")[1:]]
    assert any("creation_date" in f and ">= " in f and "ubquery" in f for f in filters), filters
