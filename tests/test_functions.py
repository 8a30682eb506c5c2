"""Golden cases of the scalar functions."""

import math

from pyspark.sql import functions as F

from brinemark import fixed_values as fv
from brinemark.functions import text, waves


def one(spark, column, **values):
    cols = [F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("_")]
    return spark.range(1).select(*cols).select(column.alias("out")).first()["out"]


def many(spark, values, fn, dtype="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r["out"] for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_sector_wraps_to_north(spark):
    degrees = [0.0, 5.624, 5.625, 354.374, 354.375, 360.0]
    assert many(spark, degrees, waves.sector) == [0, 0, 11.25, 348.75, 0, 0]


def test_band_is_right_closed(spark):
    got = many(spark, [0.0, 50.0, 50.1, 500.0, 501.0, None, float("nan")],
               lambda c: waves.band(c, fv.POWER_EDGES, fv.POWER_LABELS))
    assert got == [None, "bajo", "medio", "muy_alto", "extremo", None, None]


def test_band_has_an_upper_limit_unless_open(spark):
    assert many(spark, [10.0, 10.1], lambda c: waves.band(c, fv.WAVE_EDGES)) == [">5 - 10", None]


def test_band_labels_follow_edges():
    assert waves.band_labels([0, 0.4, 0.6, None]) == ["<=0.4", ">0.4 - 0.6", ">0.6"]


def test_height_from_power(spark):
    assert math.isclose(one(spark, waves.height_from_power(F.lit(35.28), F.lit(8.0))), 3.0)
    assert one(spark, waves.height_from_power(F.lit(35.28), F.lit(0.0))) is None


def test_energy_and_power(spark):
    assert round(one(spark, waves.wave_energy(F.lit(1.5))), 4) == 2830.7981
    assert math.isclose(one(spark, waves.wave_power(F.lit(1.5), F.lit(8.0))), 8.82)
    assert one(spark, waves.wave_steepness(F.lit(1.5), F.lit(0.0))) is None


def test_month_names(spark):
    names = ["1", "01", " Enero ", "DIC", "september", "setiembre", "Sep", "13", "x", None]
    assert many(spark, names, text.norm_month, "string") == [1, 1, 1, 12, 9, 9, 9, None, None, None]


def test_safe_round(spark):
    assert many(spark, ["1.005", "x", "NaN", None], lambda c: waves.safe_round(c, 2), "string") == [1.01, None, None, None]


def test_sea_state_names(spark):
    assert many(spark, [1.0, 7.0, 8.0, None], text.sea_state_name) == [
        "Mar calmado", "Mar extremo", fv.UNKNOWN_SEA_STATE, fv.UNKNOWN_SEA_STATE]


def test_coast_from_path(spark):
    paths = ["dbfs:/a/Tuxpan.txt", "/x/tuxpan.v2.txt", "acapulco.txt", None]
    assert many(spark, paths, text.coast_from_path, "string") == ["Tuxpan", "Tuxpan", "", ""]


def test_embedded_integer(spark):
    assert many(spark, ["T=50 y", "100", "none", None], text.embedded_integer, "string") == [50, 100, None, None]


def test_unit_hash_is_repeatable_and_even(spark):
    df = spark.range(20000).select(text.unit_hash(7, F.col("id")).alias("u"))
    row = df.agg(F.min("u").alias("lo"), F.max("u").alias("hi"), F.avg("u").alias("mean")).first()
    assert 0 <= row["lo"] < 0.01 and 0.99 < row["hi"] < 1 and abs(row["mean"] - 0.5) < 0.01
    assert one(spark, text.unit_hash(7, F.lit(3))) == one(spark, text.unit_hash(7, F.lit(3)))


def test_wind_modes(spark):
    assert one(spark, waves.wind_proxy("max", F.lit(4.0), F.lit(2.0))) == 4.0
    assert one(spark, waves.wind_proxy("mid", F.lit(4.0), F.lit(2.0))) == 3.0


def test_observed_at_rejects_impossible_dates(spark):
    parts = [(1980, 2, 29, 3), (1981, 2, 29, 3), (1980, 1, 1, 24), (80, 1, 1, 1), (None, 1, 1, 1)]
    df = spark.createDataFrame(parts, "y int, m int, d int, h int")
    got = [r[0] for r in df.select(waves.observed_at(*[F.col(c) for c in "ymdh"])).collect()]
    assert str(got[0]) == "1980-02-29 03:00:00" and got[1:] == [None] * 4


def test_rounding_equals_round(spark):
    values = [0.00005, 0.00015, 1.00005, -1.00005, 2.5, -0.00001, 0.0, 1e12 + 0.123456, -7.12345, float("nan"),
              float("inf"), None, 0.12345, 0.123450001, 0.1234499999999, 123456.78905, 399999.99995]
    df = spark.createDataFrame([(v,) for v in values], "v double").unionByName(
        spark.range(20000).select(((F.col("id") - 10000) * 0.00005 + F.rand(1) * F.lit(1e-9)).alias("v"))).unionByName(
        spark.range(20000).select(((F.col("id") - 10000) * 0.00005).alias("v")))
    same = df.where(~waves.round_half_up(F.col("v"), 4).eqNullSafe(F.round("v", 4)))
    assert same.count() == 0
    # Zero is never negative.
    assert many(spark, [-0.00001], lambda c: waves.measure(c).cast("string")) == ["0.0"]
