"""Climatology over the daily summary: KPIs, months, years, year windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, Window as W

from brinemark.functions import text, waves
from brinemark.operators.quality import year_range
from brinemark.session import stored


@dataclass(frozen=True)
class DailyColumns:
    """Names of the daily columns the climatology reads."""

    key: str = "coast_name"
    date: str = "date"
    mean_height: str = "avg_wave_height_m"
    max_height: str = "max_wave_height_m"
    max_period: str = "max_wave_period_s"
    min_period: str = "min_wave_period_s"
    max_wind: str = "max_wave_wind_speed_ms"
    min_wind: str = "min_wave_wind_speed_ms"


GOLD = DailyColumns()


def calendar_parts(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumns({"year": F.year(date), "month": F.month(date)})


def daily_measures(daily: DataFrame, wind_mode: str = "max", cols: DailyColumns = GOLD) -> DataFrame:
    """Daily rows reduced to what the climatology aggregates, in doubles."""

    def double(name):
        return F.col(name).cast("double")

    power = waves.daily_power(double(cols.mean_height), double(cols.max_period), double(cols.min_period))
    return calendar_parts(daily, cols.date).select(
        F.col(cols.key).alias("coast_name"),
        "year",
        "month",
        double(cols.mean_height).alias("hs"),
        double(cols.max_height).alias("hs_max"),
        double(cols.max_period).alias("period_max"),
        double(cols.max_wind).alias("wind_max"),
        waves.wind_proxy(wind_mode, double(cols.max_wind), double(cols.min_wind)).alias("wind"),
        power.alias("power"),
    )


def coast_kpis(days: DataFrame) -> DataFrame:
    return days.groupBy("coast_name").agg(
        F.avg("hs").alias("mean_hs"),
        F.max("hs_max").alias("max_hs"),
        F.avg("wind").alias("mean_wind"),
        F.min("year").alias("year_min"),
        F.max("year").alias("year_max"),
        F.count(F.lit(1)).alias("n_records"),
    )


def _sea_means():
    return [
        F.avg("hs").alias("mean_hs"),
        F.max("hs_max").alias("max_hs"),
        F.avg("wind").alias("mean_wind"),
        F.avg("power").alias("mean_power"),
    ]


def month_climatology(days: DataFrame) -> DataFrame:
    return days.groupBy("coast_name", "month").agg(*_sea_means())


def monthly_by_year(days: DataFrame) -> DataFrame:
    """Month values of each year, with the number of days for later weighting."""
    return days.groupBy("coast_name", "year", "month").agg(*_sea_means(), F.count(F.lit(1)).alias("n"))


def annual_maxima(days: DataFrame) -> DataFrame:
    return days.groupBy("coast_name", "year").agg(
        F.max("hs_max").alias("max_hs"),
        F.max("period_max").alias("max_period"),
        F.max("wind_max").alias("max_wind"),
    )


def recombine(monthly: DataFrame, first: int, last: int, by: str | None = "month") -> DataFrame:
    """Monthly-by-year rows recombined over a window of years.

    Means are weighted by days, months without a mean carry no weight, and
    maxima are maxima of maxima. ``by='month'`` gives all 12 months of every key
    (NULL where the window has no data); ``by=None`` one row per key.
    """
    means = ["mean_hs", "mean_wind"] + (["mean_power"] if by else [])

    def weighted(name):
        weight = F.when(F.col(name).isNotNull(), F.col("n"))
        return F.try_divide(F.sum(F.col(name) * weight), F.sum(weight)).alias(name)

    if by != "month":
        window = year_range(monthly, first, last).groupBy("coast_name")
        return window.agg(*[weighted(m) for m in means], F.max("max_hs").alias("max_hs"))
    # Years outside the window carry no values, but name their coast: one read of the rows.
    inside = F.col("year").between(min(first, last), max(first, last))
    values = [*means, "max_hs"]
    held = monthly.select("coast_name", "month", "n", *[F.when(inside, F.col(c)).alias(c) for c in values])
    months = held.groupBy("coast_name", "month").agg(*[weighted(m) for m in means], F.max("max_hs").alias("max_hs"))
    # At most twelve entries a coast.
    packed = months.groupBy("coast_name").agg(F.map_from_entries(F.collect_list(F.struct("month", F.struct(*values)))).alias("_m"))
    every = packed.select("coast_name", "_m", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    return every.select("coast_name", "month", F.try_element_at("_m", F.col("month")).alias("_v")).select("coast_name", "month", "_v.*")


def label_top_n(annual: DataFrame, n: int = 5, key: str = "coast_name", value: str = "max_hs") -> DataFrame:
    """Flag values at or above the key's ``n``-th largest (its smallest if fewer).

    Ranks are limited to ``n`` before the shuffle, so only ``n`` rows per key and
    task are moved to find the bar.
    """
    order = W.partitionBy(key).orderBy(F.col(value).desc())
    top = annual.where(F.col(value).isNotNull()).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n)
    bar = top.groupBy(key).agg(F.min(value).alias("_bar"))
    flagged = annual.join(bar, key, "left")
    return flagged.withColumn("labelled", F.coalesce(F.col(value) >= F.col("_bar"), F.lit(False))).drop("_bar")


def seastate_climatology(share: DataFrame, key: str = "coast_name", month: str = "month",
                         cls: str = "wave_classification", pct: str = "percentage") -> DataFrame:
    """Mean share over the years per (key, month, class)."""
    return share.groupBy(key, month, cls).agg(F.avg(F.col(pct).cast("double")).alias("pct"))


def to_percent_scale(df: DataFrame, value: str, over: str) -> DataFrame:
    """Values as percentages at one decimal.

    A key whose largest value is at most 1.5 holds fractions and is scaled by 100. The
    largest values are aggregated and joined, so that no task holds the rows of a key.
    """
    top = stored(df.groupBy(F.col(over).alias("_over")).agg(F.max(value).alias("_top")), "largest-values")
    scaled = F.when(F.coalesce(F.col("_top"), F.lit(0.0)) <= 1.5, F.col(value) * 100).otherwise(F.col(value))
    joined = df.join(top, F.col(over).eqNullSafe(F.col("_over")), "left")
    return joined.withColumn(value, F.round(scaled, 1)).select(*df.columns)


def seastate_matrix(climatology: DataFrame, domain: list[str], key: str = "coast_name", month: str = "month",
                    cls: str = "wave_classification", pct: str = "pct") -> DataFrame:
    """One row per (key, class of the domain) with columns ``m01``..``m12``.

    Unknown classes and months are skipped; every class of the domain appears for
    each key that has any known row. The class list is literal, so the matrix is
    densified by an aggregate and an inline of constants, not by a join.
    """
    usable = climatology.select(
        F.col(key), text.norm_month(F.col(month)).alias("_m"), F.col(cls).alias("_c"),
        waves.safe_round(F.col(pct), 4).alias("_p"),
    ).where(F.col("_m").isNotNull() & F.col("_c").isin(domain))
    scaled = to_percent_scale(usable, "_p", key)
    cells = [
        F.max(F.when((F.col("_c") == c) & (F.col("_m") == m), F.col("_p"))).alias(f"_{i}_{m}")
        for i, c in enumerate(domain) for m in range(1, 13)
    ]
    wide = scaled.groupBy(key).agg(*cells)
    rows = F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias(cls),
                 *[F.col(f"_{i}_{m}").alias(f"m{m:02d}") for m in range(1, 13)])
        for i, c in enumerate(domain)
    ])
    return wide.select(key, F.inline(rows))
