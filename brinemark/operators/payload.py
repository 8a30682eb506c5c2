"""Nested documents per coast from the climatology tables.

What is nested is bounded by the calendar: 12 months, the years, 7 classes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brinemark import fixed_values as fv
from brinemark.functions import waves
from brinemark.operators import climate

MONTHS = range(1, 13)


def coast_dimension(spark) -> DataFrame:
    return spark.createDataFrame(fv.COAST_DIMENSION, "coast_name string, id string, region string, state string, num string")


def with_dimension(df: DataFrame, dimension: DataFrame, key: str = "coast_name") -> DataFrame:
    """Every coast of the dimension, with its facts if it has any."""
    facts = df.withColumn("has_data", F.lit(True))
    joined = dimension.join(facts, key, "left")
    return joined.withColumn("has_data", F.coalesce("has_data", F.lit(False)))


def _slots(names_dp: dict[str, int], entry: str):
    """Twelve-slot vectors out of a map month -> struct; NULL for absent months."""
    def vector(name, dp):
        def slot(m):
            value = F.try_element_at(F.col(entry), m)[name]
            return waves.safe_round(value, dp) if dp is not None else value
        return F.transform(F.sequence(F.lit(1), F.lit(12)), slot).alias(name)
    return [vector(name, dp) for name, dp in names_dp.items()]


def pack_monthly_by_year(monthly: DataFrame) -> DataFrame:
    """Per coast a map year -> twelve-slot vectors."""
    measures = {"mean_hs": 3, "max_hs": 3, "mean_wind": 3, "mean_power": 2, "n": None}
    entries = F.map_from_entries(F.collect_list(F.struct("month", F.struct(*measures))))
    per_year = monthly.groupBy("coast_name", "year").agg(entries.alias("_m"))
    slotted = per_year.select("coast_name", "year", F.struct(*_slots(measures, "_m")).alias("_slots"))
    pairs = F.sort_array(F.collect_list(F.struct(F.col("year").cast("string").alias("y"), "_slots")))
    return slotted.groupBy("coast_name").agg(F.map_from_entries(pairs).alias("monthly_by_year"))


def _vectors(df: DataFrame, order: str, order_name: str, names_dp: dict[str, int], out: str) -> DataFrame:
    """Per coast one struct of parallel arrays, ordered by ``order``."""
    points = F.array_sort(F.collect_list(F.struct(F.col(order).cast("int").alias("_o"), *names_dp)))
    grouped = df.groupBy("coast_name").agg(points.alias("_p"))

    def column(name, dp):
        return F.transform("_p", lambda p: waves.safe_round(p[name], dp)).alias(name)

    arrays = [F.transform("_p", lambda p: p["_o"]).alias(order_name)]
    return grouped.select("coast_name", F.struct(*arrays, *[column(n, d) for n, d in names_dp.items()]).alias(out))


def pack_seastate(matrix: DataFrame, cls: str = "wave_classification") -> DataFrame:
    """Per coast: the months, and class -> twelve percentages in class order."""
    vector = F.array(*[F.col(f"m{m:02d}") for m in MONTHS])
    rows = F.sort_array(F.collect_list(F.struct("position", F.col(cls).alias("c"), vector.alias("v"))))
    series = F.map_from_entries(F.transform(rows, lambda x: F.struct(x["c"], x["v"])))
    return matrix.groupBy("coast_name").agg(series.alias("_s")).select(
        "coast_name", F.struct(F.sequence(F.lit(1), F.lit(12)).alias("months"), F.col("_s").alias("series")).alias("seastate"))


def coast_payload(daily: DataFrame, share: DataFrame, wind_mode: str = "max", domain: list[str] = fv.SEA_STATES,
                  dimension: DataFrame | None = None) -> DataFrame:
    """One row per coast of the dimension: ``id`` and its ``json`` document.

    The daily table is reduced to month-of-year rows by one aggregate; the coarser
    tables need days only for their own means.
    """
    days = climate.daily_measures(daily, wind_mode)
    kpis = climate.coast_kpis(days).select(
        "coast_name",
        waves.safe_round(F.col("mean_hs"), 2).alias("kpi_mean"),
        waves.safe_round(F.col("max_hs"), 2).alias("kpi_max"),
        waves.safe_round(F.col("mean_wind"), 2).alias("kpi_wind"),
        "year_min", "year_max", "n_records",
    )
    monthly = _vectors(climate.month_climatology(days), "month", "months",
                       {"mean_hs": 3, "max_hs": 3, "mean_wind": 3, "mean_power": 2}, "monthly")
    annual = _vectors(climate.annual_maxima(days), "year", "years",
                      {"max_hs": 2, "max_period": 1, "max_wind": 1}, "annual")
    by_year = pack_monthly_by_year(climate.monthly_by_year(days))
    states = pack_seastate(climate.seastate_matrix(climate.seastate_climatology(share), domain))
    facts = kpis.join(monthly, "coast_name").join(annual, "coast_name").join(by_year, "coast_name")
    dimension = dimension if dimension is not None else coast_dimension(daily.sparkSession)
    whole = with_dimension(facts, dimension).join(states, "coast_name", "left")
    document = F.struct(
        F.col("coast_name").alias("name"), "region", "state", "num",
        F.lit(fv.WIND_LABELS[wind_mode]).alias("wind_label"), "seastate", "has_data",
        "kpi_mean", "kpi_max", "kpi_wind", "year_min", "year_max", "n_records", "monthly", "annual", "monthly_by_year",
    )
    return whole.select("id", F.col("coast_name"), "has_data", F.to_json(document, {"ignoreNullFields": "false"}).alias("json"))
