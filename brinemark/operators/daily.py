"""Daily extremes per key, whole or incremental."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

SILVER_ATTRIBUTES = {
    "wave_period_s": "wave_period_s",
    "wave_direction_deg": "wave_direction_deg",
    "wind_speed_ms": "wave_wind_speed_ms",
    "wind_direction_deg": "wave_wind_direction_deg",
}


def daily_summary(
    df: DataFrame,
    ts: str = "datetime",
    key: str = "coast_name",
    value: str = "wave_height_m",
    attributes: Mapping[str, str] = SILVER_ATTRIBUTES,
    dtype: str = "float",
    windowed: bool = False,
) -> DataFrame:
    """Per day and key: highest, lowest and mean value, with the attributes found
    at the highest and at the lowest.

    Ties go to the earliest row (then to the smallest attributes), and one row
    supplies all attributes. The aggregate combines map-side: what is shuffled is
    one row per (key, day) and task, whatever the skew of keys or days.
    ``attributes`` maps source columns to output labels; ``dtype`` None keeps types.
    ``windowed`` groups by event-time windows, so that a stream can close its days.
    """
    v = F.col(value)
    detail = [F.col(ts).alias("_ts"), *[F.col(source).alias(label) for source, label in attributes.items()]]
    known = v.isNotNull()
    highest = F.min(F.when(known, F.struct((-v).alias("_v"), *detail)))
    lowest = F.min(F.when(known, F.struct(v.alias("_v"), *detail)))
    day = F.window(ts, "1 day").alias("_day") if windowed else F.to_date(ts).alias("date")
    grouped = df.groupBy(day, F.col(key)).agg(highest.alias("_hi"), lowest.alias("_lo"), F.avg(v).alias("_mean"))
    if windowed:
        grouped = grouped.withColumn("date", F.to_date("_day.start"))

    def typed(column, name):
        return (column.cast(dtype) if dtype else column).alias(name)

    return grouped.select(
        "date",
        key,
        typed(-F.col("_hi._v"), f"max_{value}"),
        *[typed(F.col(f"_hi.{label}"), f"max_{label}") for label in attributes.values()],
        typed(F.col("_lo._v"), f"min_{value}"),
        *[typed(F.col(f"_lo.{label}"), f"min_{label}") for label in attributes.values()],
        typed(F.col("_mean"), f"avg_{value}"),
    )


def unsummarised(
    metrics: DataFrame, summary: DataFrame, ts: str = "datetime", key: str = "coast_name", date: str = "date"
) -> DataFrame:
    """Rows whose (day, key) has no summary yet.

    A left-anti join: the optimizer broadcasts the summary's keys while their
    size allows it.
    """
    done = summary.select(F.col(date).alias("_day"), F.col(key).alias("_key"))
    same = (F.to_date(metrics[ts]) == F.col("_day")) & (metrics[key] == F.col("_key"))
    return metrics.join(done, same, "left_anti")


def new_daily_rows(
    metrics: DataFrame,
    summary: DataFrame,
    ts: str = "datetime",
    key: str = "coast_name",
    value: str = "wave_height_m",
    attributes: Mapping[str, str] = SILVER_ATTRIBUTES,
    dtype: str = "float",
) -> DataFrame:
    """Summaries of the days that have none yet.

    Days are wholly summarised or not at all, so filtering days after the
    aggregate gives the same rows as filtering observations before it, and the
    anti join then sees one row per (day, key) instead of every observation.
    """
    fresh = daily_summary(metrics, ts, key, value, attributes, dtype)
    return fresh.join(summary.select("date", key), ["date", key], "left_anti")
