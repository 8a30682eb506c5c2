"""Shapes that must hold at scale, read off the physical plans."""

import pytest
from pyspark.sql import functions as F

from brinemark.operators import quantiles
from brinemark.workload.queries import QUERIES

LAZY = ["daily_summary", "daily_incremental", "unsummarised_days", "parse_quality", "quarantine_reasons", "class_share",
        "month_climatology", "recombine_by_month", "label_top_n", "seastate_matrix", "group_quantile_bracket",
        "extreme_profile", "decluster_peaks", "gpd_return_levels", "coast_rank", "describe_by", "wind_rose",
        "contingency", "exceedance_curve", "stratified_sample", "classification_metrics", "coast_payload"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_join_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert bad not in plan


@pytest.mark.parametrize("name, exchanges", [
    ("daily_summary", 1), ("class_share", 1), ("contingency", 1), ("parse_quality", 0), ("stratified_sample", 0)])
def test_shuffles(spark, sf_dir, name, exchanges):
    assert plan_of(QUERIES[name](spark, sf_dir)).count("Exchange ") == exchanges


@pytest.mark.parametrize("name, columns", [
    ("corr_matrix", {"l_quantity", "l_extendedprice", "l_discount"}),
    ("contingency", {"o_orderstatus", "o_orderdate"})])
def test_only_needed_columns_are_read(spark, sf_dir, name, columns):
    schema = plan_of(QUERIES[name](spark, sf_dir)).split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",")} == columns


def test_quantile_scans_read_two_columns(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = events.withColumn("_k", F.struct("event_type")).withColumn("_v", F.col("value").cast("double"))
    plan = plan_of(quantiles._sketch(rows, ["event_type"], {"q": 0.5}, [], quantiles.MARGIN))
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",")} == {"event_type", "value"} and plan.count("Exchange ") == 1


def test_top_n_is_limited_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan_of(QUERIES["label_top_n"](spark, sf_dir))
