"""The forecast table: tidy rows, cleaning, ranking and packing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, Window as W

from brinemark.functions import text, waves

REQUIRED = ("coast_name", "mean", "metric", "period")
LAST = 10 ** 9


def tidy_forecast(levels: DataFrame, key: str = "coast_name") -> DataFrame:
    """Power and height levels of each period as rows of the forecast schema."""
    power = F.struct(F.col("mean"), F.col("lower"), F.col("upper"), F.lit("Power").alias("metric"))
    height = F.struct(
        F.col("height_mean").alias("mean"), F.col("height_lower").alias("lower"),
        F.col("height_upper").alias("upper"), F.lit("Height").alias("metric"))
    rows = levels.select(F.col(key), F.col("period").cast("string").alias("period"), F.inline(F.array(power, height)))
    return error_bars(rows).select(key, "mean", "lower", "upper", "metric", "period", "err_plus", "err_minus")


def error_bars(df: DataFrame, keep_given: bool = False, dp: int | None = None) -> DataFrame:
    """Distances from the mean up and down; given ones can take precedence."""
    plus, minus = F.col("upper") - F.col("mean"), F.col("mean") - F.col("lower")
    if dp is not None:
        plus, minus = F.round(plus, dp), F.round(minus, dp)
    if keep_given:
        plus, minus = F.coalesce("err_plus", plus), F.coalesce("err_minus", minus)
    return df.withColumn("err_plus", plus).withColumn("err_minus", minus)


def clean_forecast(df: DataFrame, dp: int = 2) -> DataFrame:
    """Trimmed, rounded forecast rows with a coast, a metric and a period.

    Raises when a required column is missing; optional columns may be absent.
    """
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"forecast lacks columns: {', '.join(missing)}")
    names = ["coast_name", "metric", "period"]
    numbers = ["mean", "lower", "upper", "err_plus", "err_minus"]
    none = F.lit(None).cast("double")
    shaped = df.select(
        *[F.trim(F.col(c).cast("string")).alias(c) for c in names],
        *[(waves.safe_round(F.col(c), dp) if c in df.columns else none).alias(c) for c in numbers],
    )
    for c in names:
        shaped = shaped.where(F.col(c) != "")
    return error_bars(shaped, keep_given=True, dp=dp)


def select_forecast(df: DataFrame, metric: str, period: str) -> DataFrame:
    return df.where((F.col("metric") == metric) & (F.col("period") == period) & F.col("mean").isNotNull())


def coast_rank(df: DataFrame, key: str = "coast_name", by: Sequence[str] = ("metric", "period")) -> DataFrame:
    """Rank by mean, strongest first, within each (metric, period).

    The table has one row per coast in each group.
    """
    order = W.partitionBy(*by).orderBy(F.col("mean").desc(), F.col(key))
    return df.where(F.col("mean").isNotNull()).select(
        key, *by, "mean",
        F.row_number().over(order).alias("rank"),
        F.count(F.lit(1)).over(W.partitionBy(*by)).alias("total"),
    )


def period_order(period: str = "period"):
    """Sort key of a period label: its number, labels without one last."""
    return F.coalesce(text.embedded_integer(F.col(period)), F.lit(LAST))


def order_forecast(df: DataFrame, key: str = "coast_name") -> DataFrame:
    """Rows with a mean, by metric, period number and ascending mean."""
    return df.where(F.col("mean").isNotNull()).orderBy("metric", period_order(), "period", "mean", key)


def pack_points(clean: DataFrame) -> DataFrame:
    """One row per (period, metric): its points, ascending by coast.

    Every period has every metric; a pair without points has an empty array. A
    group holds one point per coast.
    """
    point = F.struct(F.col("coast_name").alias("coast"), "mean", "lower", "upper", "err_plus", "err_minus")
    named = clean.where(F.col("period").isNotNull() & F.col("metric").isNotNull())
    packed = named.groupBy("period", "metric").agg(F.sort_array(F.collect_list(point)).alias("points"))
    metrics = F.array(*[F.lit(r["metric"]) for r in named.select("metric").distinct().orderBy("metric").collect()])
    pairs = named.select("period").distinct().select("period", F.explode(metrics.cast("array<string>")).alias("metric"))
    return pairs.join(packed, ["period", "metric"], "left").select(
        "period", "metric", F.coalesce("points", F.array().cast(packed.schema["points"].dataType)).alias("points"))


def pack_forecast(clean: DataFrame) -> DataFrame:
    """One row: metrics, periods in order, and period -> metric -> points.

    For a bounded forecast table (coasts x metrics x periods); ``pack_points`` gives
    the same as a row per pair. Rows without a period or metric are left out.
    """
    pairs = pack_points(clean)
    per_period = pairs.groupBy("period").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", "points")))).alias("by_metric"),
        F.collect_set("metric").alias("metrics"))
    ordered = F.struct(period_order().alias("o"), F.col("period").alias("p"), F.col("by_metric").alias("m"))
    packed = per_period.groupBy().agg(
        F.collect_list(ordered).alias("_all"), F.flatten(F.collect_list("metrics")).alias("_metrics"))
    by_number = F.array_sort("_all", lambda a, b: F.when(
        (a["o"] < b["o"]) | ((a["o"] == b["o"]) & (a["p"] < b["p"])), -1).when(a["p"] == b["p"], 0).otherwise(1))
    return packed.where(F.size("_all") > 0).select(
        F.sort_array(F.array_distinct("_metrics")).alias("metrics"),
        F.transform(by_number, lambda x: x["p"]).alias("periods"),
        F.map_from_entries(F.transform(by_number, lambda x: F.struct(x["p"], x["m"]))).alias("series"),
    )
