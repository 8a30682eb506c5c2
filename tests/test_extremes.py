"""Storms, tail fits and return levels."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brinemark import fixed_values as fv
from brinemark.operators import extremes, forecast
from brinemark.plans import jobs

HOUR = 3600


def series(spark, rows):
    df = spark.createDataFrame(rows, "k string, hours double, v double")
    return df.withColumn("ts", F.timestamp_seconds(F.col("hours") * HOUR))


def storms(spark, rows, gap_hours=72):
    peaks = extremes.decluster(series(spark, rows), "k", "ts", "v", gap_hours * HOUR)
    return sorted((r["k"], r["storm_start_us"] / 3.6e9, r["storm_end_us"] / 3.6e9, r["n_over"], r["peak_us"] / 3.6e9, r["peak"])
                  for r in peaks.collect())


def test_gap_merges_up_to_its_length(spark):
    assert storms(spark, [("a", 0.0, 1.0), ("a", 72.0, 3.0), ("a", 145.0, 2.0)]) == [
        ("a", 0, 72, 2, 72, 3.0), ("a", 145, 145, 1, 145, 2.0)]


def test_first_of_equal_peaks(spark):
    assert storms(spark, [("a", 5.0, 3.0), ("a", 1.0, 3.0), ("b", 9.0, 1.0)]) == [
        ("a", 1, 5, 2, 1, 3.0), ("b", 9, 9, 1, 9, 1.0)]


def test_against_brute_force_with_a_hot_key_and_old_dates(spark):
    rng = np.random.default_rng(11)
    rows = [("hot", float(h), float(v)) for h, v in zip(rng.uniform(-50_000, 50_000, 4000).round(2), rng.normal(size=4000))]
    rows += [("cold", float(h), float(v)) for h, v in zip(rng.uniform(0, 3000, 20).round(2), rng.normal(size=20))]
    expected = []
    for key in ("hot", "cold"):
        points = sorted((h, v) for k, h, v in rows if k == key)
        group = [points[0]]
        for p in points[1:] + [(1e12, 0)]:
            if p[0] - group[-1][0] > 24 + 1e-9:
                top = max(group, key=lambda x: (x[1], -x[0]))
                expected.append((key, group[0][0], group[-1][0], len(group), top[0], top[1]))
                group = [p]
            else:
                group.append(p)
    got = storms(spark, rows, 24)
    assert len(got) == len(expected)
    for a, b in zip(got, sorted(expected)):
        assert a[0] == b[0] and a[3] == b[3] and np.allclose(a[1:3] + a[4:], b[1:3] + b[4:])


def gpd_sample(shape, scale, n, seed=1):
    u = np.random.default_rng(seed).uniform(size=n)
    return scale * (np.power(u, -shape) - 1) / shape


@pytest.mark.parametrize("method", ["pwm", "mle"])
@pytest.mark.parametrize("shape", [-0.2, 0.1, 0.3])
def test_fit_recovers_parameters(spark, method, shape):
    y = np.sort(gpd_sample(shape, 2.0, 20_000))
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "excess": y, "rank": np.arange(1, len(y) + 1), "n": len(y)}))
    row = extremes.gpd_fit(df, ["k"], method).first()
    assert row["shape"] == pytest.approx(shape, abs=0.04) and row["scale"] == pytest.approx(2.0, abs=0.07)


def test_weighted_fit_equals_repeated_rows(spark):
    y = np.sort(np.repeat(gpd_sample(0.1, 2.0, 40), 3))
    plain = pd.DataFrame({"k": "a", "excess": y, "rank": np.arange(1, 121), "n": 120})
    folded = pd.DataFrame({"k": "a", "excess": y[::3], "rank": np.arange(3, 121, 3), "n": 120, "w": 3})
    for method in ("pwm", "mle"):
        a = extremes.gpd_fit(spark.createDataFrame(plain), ["k"], method).first()
        b = extremes.gpd_fit(spark.createDataFrame(folded), ["k"], method).first()
        assert a["shape"] == pytest.approx(b["shape"], abs=1e-6) and a["scale"] == pytest.approx(b["scale"], abs=1e-6)
        assert a["n_peaks"] == b["n_peaks"] == 120


def test_too_few_peaks_give_no_fit(spark):
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "excess": [1.0, 2.0, 4.0], "rank": [1, 2, 3], "n": 3}))
    for method in ("pwm", "mle"):
        assert extremes.gpd_fit(df, ["k"], method).first()["shape"] is None


def test_zero_shape_uses_the_exponential_limit(spark):
    fit = spark.createDataFrame([("a", 100, 0.0, 2.0)], "k string, n_peaks long, shape double, scale double")
    year = int(fv.DAYS_PER_YEAR * 86400e6)
    thr = spark.createDataFrame([("a", 5.0, 0, 10 * year)], "k string, threshold double, first_us long, last_us long")
    got = {r["period"]: r["level"] for r in extremes.return_level(fit, thr, "k").collect()}
    assert got[50] == pytest.approx(5 + 2 * np.log(500), rel=1e-6)


@pytest.fixture(scope="module")
def waves_frame(spark):
    """Twenty years, three coasts; one holds most rows, one is too short to fit."""
    rng = np.random.default_rng(2)
    parts = []
    for coast, n, span in (("hot", 30_000, 20 * 8766), ("mid", 8_000, 20 * 8766), ("short", 40, 400)):
        parts.append(pd.DataFrame({
            "coast_name": coast, "hours": rng.uniform(0, span, n).round(1), "wave_power_kW_m": rng.exponential(60, n),
            "wave_period_s": rng.uniform(4, 14, n), "wave_height_m": 1.0, "wave_direction_deg": 2.0}))
    return spark.createDataFrame(pd.concat(parts)).withColumn("datetime", F.timestamp_seconds(F.col("hours") * HOUR))


@pytest.mark.parametrize("method", ["pwm", "mle"])
def test_forecast_rows(waves_frame, method):
    rows, failures = jobs.forecast_rows(waves_frame, resamples=60, method=method)
    got = rows.collect()
    assert [r["coast_name"] for r in failures.collect()] == ["short"]
    assert len(got) == 2 * 2 * 2
    for r in got:
        assert r["lower"] <= r["mean"] * 1.05 and r["mean"] <= r["upper"] * 1.05
        assert r["err_plus"] == pytest.approx(r["upper"] - r["mean"])
        assert r["err_minus"] == pytest.approx(r["mean"] - r["lower"])
    by = {(r["coast_name"], r["metric"], r["period"]): r["mean"] for r in got}
    assert all(by[(c, "Power", "100")] > by[(c, "Power", "50")] for c in ("hot", "mid"))
    again = {tuple(r) for r in jobs.forecast_rows(waves_frame.repartition(7), resamples=60, method=method)[0].collect()}
    assert {tuple(map(str, r)) for r in again} == {tuple(map(str, r)) for r in got}


def test_period_falls_back_to_the_overall_median(spark):
    periods = spark.createDataFrame([("bajo", 4.0), (None, 9.0)], "band string, median_period double")
    df = spark.createDataFrame([(10.0,), (70.0,), (0.0,)], "p double")
    got = extremes.assoc_period(df, "p", periods).collect()
    assert [r["assoc_period"] for r in got] == [4.0, 9.0, 9.0]


def test_clean_forecast(spark):
    df = spark.createDataFrame(
        [(" A ", "1.236", "Power", "50"), ("B", "x", "Power", "50"), ("", "1", "Power", "50"), ("C", "1", None, "50")],
        "coast_name string, mean string, metric string, period string")
    got = sorted((r["coast_name"], r["mean"], r["err_plus"]) for r in forecast.clean_forecast(df).collect())
    assert got == [("A", 1.24, None), ("B", None, None)]
    with pytest.raises(ValueError, match="metric"):
        forecast.clean_forecast(df.drop("metric"))


def test_period_labels_sort_by_number(spark):
    rows = [("a", "Power", p, 1.0) for p in ("100", "50", "never", "T=7")]
    df = spark.createDataFrame(rows, "coast_name string, metric string, period string, mean double")
    assert [r["period"] for r in forecast.order_forecast(df).collect()] == ["T=7", "50", "100", "never"]
    packed = forecast.pack_forecast(forecast.clean_forecast(df)).first()
    assert packed["periods"] == ["T=7", "50", "100", "never"]


def test_empty_forecast_packs_to_nothing(spark):
    df = spark.createDataFrame([], "coast_name string, metric string, period string, mean double")
    assert forecast.pack_forecast(forecast.clean_forecast(df)).count() == 0


def test_likelihood_without_a_maximum_is_no_fit(spark):
    # Nearly uniform with a sharp end: the likelihood only rises towards shape -1.
    y = np.r_[np.linspace(8.0, 9.9, 9), 10.0, 10.0]
    assert extremes._mle_shape_scale(y, np.ones(len(y))) is None
    rows = pd.DataFrame({"k": "a", "excess": y}).assign(n=len(y))
    df = spark.createDataFrame(rows)
    fit = extremes.gpd_fit(df, ["k"], "mle")
    assert fit.first().asDict() == {"k": "a", "n_peaks": 11, "shape": None, "scale": None}
    thresholds = spark.createDataFrame([("a",), ("b",)], "k string")
    failed = {r["k"]: (r["n_peaks"], r["error"]) for r in extremes.fit_failures(fit, thresholds, "k", "mle").collect()}
    assert failed == {"a": (11, "no maximum of the likelihood above shape -1"), "b": (0, "fewer than 10 peaks")}


def test_fit_is_a_maximum_wherever_there_is_one():
    rng = np.random.default_rng(4)
    found = 0
    for _ in range(150):
        y = gpd_sample(rng.uniform(-0.6, 0.6) or 0.1, 2.0, int(rng.integers(10, 60)), int(rng.integers(1 << 30)))
        fit = extremes._mle_shape_scale(y, np.ones(len(y)))
        if fit is None:
            continue
        found += 1

        def gain(shape, scale):
            z = 1 + shape * y / scale
            return -len(y) * np.log(scale) - (1 + 1 / shape) * np.log(z).sum() if z.min() > 0 else -np.inf

        best = gain(*fit)
        assert fit[0] > -1
        for ds, dg in ((1e-3, 0), (-1e-3, 0), (0, 1e-3), (0, -1e-3), (1e-3, 1e-3), (-1e-3, -1e-3)):
            assert gain(fit[0] + ds, fit[1] + dg) <= best + 1e-9
    assert found > 100
