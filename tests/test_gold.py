"""Daily, share and climatology golden cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brinemark.operators import climate, daily, describe, forecast, metrics, payload, sampling, share


def observations(spark, rows):
    df = spark.createDataFrame(rows, "coast_name string, stamp string, wave_height_m double, wave_period_s double")
    return df.withColumn("datetime", F.to_timestamp("stamp"))


def test_tie_takes_the_earliest_row(spark):
    df = observations(spark, [
        ("a", "2000-01-01 05:00:00", 2.0, 50.0), ("a", "2000-01-01 01:00:00", 2.0, 10.0),
        ("a", "2000-01-01 09:00:00", None, 99.0), ("a", "2000-01-02 00:00:00", 1.0, 7.0)])
    got = {r["date"]: r for r in daily.daily_summary(df, attributes={"wave_period_s": "wave_period_s"}).collect()}
    first = got[dt.date(2000, 1, 1)]
    assert first["max_wave_period_s"] == 10 and first["min_wave_period_s"] == 10 and first["avg_wave_height_m"] == 2
    assert got[dt.date(2000, 1, 2)]["max_wave_height_m"] == 1


def test_attributes_come_from_one_row(spark):
    df = observations(spark, [("a", "2000-01-01 01:00:00", 2.0, None), ("a", "2000-01-01 02:00:00", 1.0, 5.0)])
    row = daily.daily_summary(df, attributes={"wave_period_s": "wave_period_s"}).first()
    assert row["max_wave_period_s"] is None and row["min_wave_period_s"] == 5


def test_incremental_equals_filtered_observations(spark):
    df = observations(spark, [("a", f"2000-01-{d:02d} 0{h}:00:00", float(d * h % 7), 1.0) for d in range(1, 9) for h in range(3)])
    attrs = {"wave_period_s": "wave_period_s"}
    done = daily.daily_summary(df, attributes=attrs).where(F.dayofmonth("date") < 4)
    late = daily.new_daily_rows(df, done, attributes=attrs)
    early = daily.daily_summary(daily.unsummarised(df, done), attributes=attrs)
    assert sorted(map(tuple, late.collect())) == sorted(map(tuple, early.collect())) and late.count() == 5


def test_class_share(spark):
    df = spark.createDataFrame([(1, "k", c) for c in "AAAB"] + [(2, "k", c) for c in ("A", "A", "A", "?")], "p int, k string, c string")
    got = {(r["p"], r["c"]): r["percentage"] for r in share.class_share(df, ["p"], "k", "c", ["A", "B", "C"]).collect()}
    assert got == {(1, "A"): 75, (1, "B"): 25, (1, "C"): 0, (2, "A"): 75, (2, "B"): 0, (2, "C"): 0}


def test_share_shuffles_once(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    out = share.class_share(orders, [F.year("o_orderdate").alias("y")], "o_orderpriority", "o_orderstatus", ["O", "F"])
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def monthly(spark, rows):
    return spark.createDataFrame(
        rows, "coast_name string, year int, month int, mean_hs double, max_hs double, mean_wind double, mean_power double, n long")


def test_recombine(spark):
    m = monthly(spark, [
        ("a", 2000, 1, 1.0, 5.0, 1.0, 1.0, 10), ("a", 2001, 1, 4.0, 3.0, None, 4.0, 20), ("a", 2005, 1, 100.0, 99.0, 1.0, 1.0, 5)])
    by_month = {r["month"]: r for r in climate.recombine(m, 2001, 2000).collect()}
    assert by_month[1]["mean_hs"] == 3.0 and by_month[1]["max_hs"] == 5.0 and by_month[1]["mean_wind"] == 1.0
    assert len(by_month) == 12 and by_month[2]["mean_hs"] is None
    assert climate.recombine(m, 2000, 2001, by=None).first()["mean_hs"] == 3.0


def test_top_five_keep_ties(spark):
    df = spark.createDataFrame([("a", y, v) for y, v in enumerate([7.0, 6.0, 5.0, 4.0, 3.0, 3.0, 1.0])] + [("b", 0, 2.0), ("b", 1, None)],
                               "coast_name string, year int, max_hs double")
    got = {(r["coast_name"], r["year"]): r["labelled"] for r in climate.label_top_n(df).collect()}
    assert [got[("a", y)] for y in range(7)] == [True] * 6 + [False]
    assert got[("b", 0)] is True and got[("b", 1)] is False


def test_fractions_are_scaled(spark):
    df = spark.createDataFrame(
        [("a", "01", "A", 0.25), ("a", "enero", "B", 0.75), ("b", "1", "A", 40.0), ("b", "x", "A", 1.0), ("c", "1", "?", 1.0)],
        "coast_name string, month string, wave_classification string, pct double")
    got = {(r["coast_name"], r["wave_classification"]): r["m01"] for r in climate.seastate_matrix(df, ["A", "B"]).collect()}
    assert got == {("a", "A"): 25.0, ("a", "B"): 75.0, ("b", "A"): 40.0, ("b", "B"): None}


def test_scaling_keeps_no_group_in_one_task(spark):
    df = spark.createDataFrame(
        [("a", 0.25), ("a", 1.5), ("b", 1.6), ("b", None), (None, 0.5), (None, None), ("c", None)], "k string, v double")
    scaled = climate.to_percent_scale(df, "v", "k")
    assert scaled.columns == ["k", "v"] and "Window" not in scaled._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, scaled.collect())) == sorted(map(str, spark.createDataFrame(
        [("a", 25.0), ("a", 150.0), ("b", 1.6), ("b", None), (None, 50.0), (None, None), ("c", None)], "k string, v double").collect()))


def test_dimension_keeps_coasts_without_data(spark):
    facts = spark.createDataFrame([("Tuxpan", 1)], "coast_name string, x int")
    got = {r["id"]: r["has_data"] for r in payload.with_dimension(facts, payload.coast_dimension(spark)).collect()}
    assert len(got) == 7 and sum(got.values()) == 1 and got["tuxpan"]


def test_payload_without_share_or_data(spark):
    df = observations(spark, [("Tuxpan", "2000-01-01 01:00:00", 2.0, 8.0)]).select(
        "*", F.lit(1.0).alias("wave_direction_deg"), F.lit(1.0).alias("wind_speed_ms"), F.lit(1.0).alias("wind_direction_deg"))
    none = spark.createDataFrame([], "year int, month string, coast_name string, wave_classification string, percentage float")
    got = {r["id"]: r for r in payload.coast_payload(daily.daily_summary(df), none).collect()}
    assert len(got) == 7 and got["tuxpan"]["has_data"] and not got["colonet"]["has_data"]


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "v double")
    rows = describe.fd_histogram(df, "v").collect()
    assert [(r["bin"], r["count"]) for r in rows] == [(0, 2)]
    assert describe.fd_histogram(df.where("v > 5"), "v").count() == 0


def test_histogram_with_one_far_value(spark):
    df = spark.range(999).select((F.col("id") % 10 / 1000).alias("v")).union(spark.range(1).select(F.lit(1e12)))
    rows = describe.fd_histogram(df, "v").collect()
    assert sum(r["count"] for r in rows) == 1000 and len(rows) < 20 and rows[0]["bins"] > 10**6


def test_describe_equals_percentiles(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    got = {r["l_returnflag"]: r for r in describe.describe(df, ["l_quantity"], "l_returnflag").collect()}
    want = df.groupBy("l_returnflag").agg(F.percentile("l_quantity", [0.25, 0.5, 0.75]).alias("q"), F.count("l_quantity").alias("n"))
    for r in want.collect():
        row = got[r["l_returnflag"]]
        assert [row["q25"], row["q50"], row["q75"]] == pytest.approx(r["q"]) and row["count"] == r["n"]


def test_every_period_has_every_metric(spark):
    rows = spark.createDataFrame([
        ("a", "10", "Power", 1.0), ("a", "100", "Power", 2.0), ("b", "10", "Height", 3.0), ("c", None, "Height", 3.0)],
        "coast_name string, period string, metric string, mean double").selectExpr(
        "*", "mean lower", "cast(null as double) upper", "0.0 err_plus", "0.0 err_minus")
    packed = {(r["period"], r["metric"]): [p["coast"] for p in r["points"]] for r in forecast.pack_points(rows).collect()}
    assert packed == {("10", "Height"): ["b"], ("10", "Power"): ["a"], ("100", "Height"): [], ("100", "Power"): ["a"]}
    doc = forecast.pack_forecast(rows).first()
    assert doc["metrics"] == ["Height", "Power"] and doc["periods"] == ["10", "100"] and doc["series"]["100"]["Height"] == []


def test_rose_sums_to_all_banded_rows(spark):
    df = spark.createDataFrame([(0.0, 1.0), (359.0, 0.0), (180.0, 99.0), (None, 1.0)], "d double, v double")
    rows = describe.direction_rose(df, "d", "v", [0, 2, 4]).collect()
    assert len(rows) == 64 and sum(r["count"] for r in rows) == 1
    assert sum(r["percentage"] for r in rows) == pytest.approx(100 / 3)


def test_metrics_of_a_known_table(spark):
    pairs = [(1, 1)] * 8 + [(1, 2)] * 2 + [(2, 2)] * 3 + [(2, 1)] + [(3, 1)]
    df = spark.createDataFrame(pairs, "t int, p int")
    row = metrics.classification_metrics(df, "t", "p").first()
    assert row["accuracy"] == pytest.approx(11 / 15) and row["min_recall"] == 0
    assert row["balanced_accuracy"] == pytest.approx((0.8 + 0.75 + 0) / 3)
    assert row["f1_macro"] == pytest.approx((2 * 8 / 20 + 2 * 3 / 9 + 0) / 3)


def test_splits_partition_the_rows(spark):
    df = spark.range(5000)
    train, test = sampling.split(df, 0.2, ["id"])
    assert train.count() + test.count() == 5000 and abs(test.count() - 1000) < 120
    assert train.join(test, "id").count() == 0
    assert sampling.stratified_sample(df, [F.col("id") % 2], 1.0, ["id"]).count() == 5000
    only_odd = sampling.stratified_sample(df, [F.col("id") % 2], {"1": 1.0}, ["id"])
    assert only_odd.count() == 2500
