"""Quantile selection against brute force, with hot groups and awkward values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brinemark.operators import quantiles

QS = {"q00": 0.0, "q01": 0.01, "q50": 0.5, "q95": 0.95, "q99": 0.999, "q100": 1.0}


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, one has few, one has ties only, one no value."""
    rng = np.random.default_rng(3)
    hot = rng.exponential(40, 60_000).round(3)
    pdf = pd.concat([
        pd.DataFrame({"k": "hot", "v": hot}),
        pd.DataFrame({"k": "few", "v": rng.normal(0, 5, 7)}),
        pd.DataFrame({"k": "ties", "v": np.full(15_000, 2.5)}),
        pd.DataFrame({"k": "steps", "v": rng.integers(0, 4, 20_000).astype(float)}),
    ])
    df = spark.createDataFrame(pdf)
    none = spark.createDataFrame([("empty", None), (None, 1.0), (None, 2.0), ("hot", None)], "k string, v double")
    return pdf, df.unionByName(none).repartition(6)


def test_per_group(skewed):
    pdf, df = skewed
    got = {r["k"]: r for r in quantiles.exact_quantiles(df, ["k"], "v", QS).collect()}
    assert set(got) == {"hot", "few", "ties", "steps", "empty", None}
    for key, part in pdf.groupby("k"):
        for name, q in QS.items():
            assert got[key][name] == pytest.approx(np.quantile(part["v"], q), abs=1e-9), (key, name)
    assert got[None]["q50"] == 1.5
    assert got["empty"]["q50"] is None


def test_whole_table_with_extras(skewed):
    pdf, df = skewed
    row = quantiles.exact_quantiles(
        df, [], "v", {"q": 0.95}, extra=[F.count("v").alias("n"), F.min("v").alias("lo")]).first()
    every = np.append(pdf["v"].to_numpy(), [1.0, 2.0])
    assert row["q"] == pytest.approx(np.quantile(every, 0.95), abs=1e-9)
    assert row["n"] == len(every) and row["lo"] == pytest.approx(every.min())


def test_no_rows(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert quantiles.exact_quantiles(empty, ["k"], "v", {"q": 0.5}).count() == 0
    assert quantiles.exact_quantiles(empty, [], "v", {"q": 0.5}).first()["q"] is None


def test_many_groups_shuffle_instead_of_broadcast(spark):
    df = spark.range(3000).select((F.col("id") % 50).alias("k"), F.col("id").cast("double").alias("v"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = quantiles.exact_quantiles(df, ["k"], "v", {"q": 0.5}).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert {r["k"]: r["q"] for r in got} == {k: 1475.0 + k for k in range(50)}


def test_equal_bits_however_the_rows_are_split(skewed):
    _, df = skewed
    one, many = (
        {r["k"]: [r[n] for n in QS] for r in quantiles.exact_quantiles(df.repartition(n), ["k"], "v", QS).collect()}
        for n in (1, 60))
    assert one == many


def test_a_missed_rank_widens_its_bracket(skewed, monkeypatch):
    """Cuts that are far off steer wrongly at first; the result is right all the same."""
    pdf, df = skewed
    real, margins = quantiles._sketch, []

    def off(rows, keys, qs, extra, margin):
        margins.append(margin)
        table = real(rows, keys, qs, extra, margin)
        if margin >= 0.01:
            return table
        return table.withColumn("_cuts", F.transform("_cuts", lambda c: c + 1000.0))

    monkeypatch.setattr(quantiles, "_sketch", off)
    got = {r["k"]: r for r in quantiles.exact_quantiles(df, ["k"], "v", {"q": 0.9}).where("k is not null").collect()}
    assert len(margins) == 3
    for key, part in pdf.groupby("k"):
        assert got[key]["q"] == pytest.approx(np.quantile(part["v"], 0.9), abs=1e-9)


def test_bracket_shuffles_few_rows(skewed):
    """Outside the brackets a group collapses before the shuffle."""
    _, df = skewed
    out = quantiles.exact_quantiles(df.where("k = 'hot'"), ["k"], "v", {"q": 0.95})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan


def test_running_count(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": rng.choice(["a", "b"], 9000, p=[0.95, 0.05]), "v": rng.normal(0, 1, 9000).round(2)})
    counted = spark.createDataFrame(pdf).groupBy("k", "v").count()
    got = quantiles.running_count(counted, ["k"], "v", "count").collect()
    expected = pdf.assign(r=pdf.groupby("k")["v"].rank(method="min").astype(int) - 1).drop_duplicates(["k", "v"])
    want = {(r.k, r.v): r.r for r in expected.itertuples()}
    assert {(r["k"], r["v"]): r["n_before"] for r in got} == want


def test_nan_values_have_no_rank(spark):
    rows = [("a", float(v)) for v in range(11)] + [("a", float("nan"))] * 50 + [("b", float("nan")), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r["median"] for r in quantiles.group_median(df, ["k"], "v").collect()}
    assert got == {"a": 5.0, "b": None}
