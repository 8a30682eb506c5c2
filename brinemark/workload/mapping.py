"""Series tables derived from the star-schema tables.

``observed`` gives ``lineitem`` the shape of the clean observation table (seven
line numbers for seven coasts); ``raw_lines`` writes the same rows as landing
text, some of them broken in known ways.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brinemark.fixed_values import COASTS
from brinemark.functions import waves

STEMS = list(COASTS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def measures() -> dict:
    """Wind and wave columns out of lineitem columns (doubles)."""
    return {
        "wind_speed_ms": F.col("l_quantity") / 2,
        "wind_direction_deg": (F.col("l_partkey") % 3600) / 10.0,
        "wave_height_m": F.floor(F.col("l_extendedprice") / 10) / 1000.0,
        "wave_direction_deg": (F.col("l_orderkey") % 3600) / 10.0,
        "wave_period_s": (22 + 4 * (F.col("l_suppkey") % 30)) / 10.0,
    }


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean observations: coast, time, year and measures at silver precision."""
    names = F.array(*[F.lit(COASTS[s]) for s in STEMS])
    base = table(spark, sf_dir, "lineitem").select(
        F.element_at(names, F.col("l_linenumber")).alias("coast_name"),
        (F.date_trunc("day", F.col("l_shipdate")).cast("timestamp_ntz")
         + F.make_dt_interval(hours=(F.col("l_suppkey") % 24).cast("int"))).alias("datetime"),
        F.year("l_shipdate").alias("year"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        *[c.alias(n) for n, c in measures().items()],
    )
    height, period = F.col("wave_height_m"), F.col("wave_period_s")
    return base.select(
        *[c for c in base.columns if c not in measures()],
        *[waves.measure(F.col(c)).alias(c) for c in measures()],
        waves.measure(waves.wave_energy(height)).alias("wave_energy"),
        waves.measure(waves.wave_power(height, period)).alias("wave_power_kW_m"),
    )


def raw_lines(spark: SparkSession, sf_dir: str, version: int = 1, late: bool | None = None) -> DataFrame:
    """Landing lines with their file (its ``version`` is in the name): ``data`` and ``source_file``.

    ``late`` takes only the lines that arrive late, a fifth by supplier, or only the others.

    The remainder of the order key by 50 decides how a line is broken.
    """
    kind = F.col("l_orderkey") % 50
    m = measures()
    stems = F.array(*[F.lit(s) for s in STEMS])
    stem = F.element_at(stems, F.col("l_linenumber"))
    fields = [
        F.when(kind == 5, F.lit("2")).otherwise(F.month("l_shipdate").cast("string")),
        F.when(kind == 5, F.lit("30")).otherwise(F.dayofmonth("l_shipdate").cast("double").cast("string")),
        F.when(kind == 9, F.lit("24")).otherwise((F.col("l_suppkey") % 24).cast("string")),
        F.when(kind == 2, F.lit("x")).otherwise(m["wind_speed_ms"].cast("string")),
        F.when(kind == 3, F.lit("400.5")).otherwise(m["wind_direction_deg"].cast("string")),
        F.when(kind == 4, F.lit("NaN")).otherwise(m["wave_height_m"].cast("string")),
        F.when(kind == 7, F.lit("-1")).otherwise(m["wave_direction_deg"].cast("string")),
        F.when(kind == 7, F.lit("99")).otherwise(m["wave_period_s"].cast("string")),
        F.lit("0"), F.lit("0"), F.lit("0"),
    ]
    filler = F.when(F.col("l_linenumber") % 2 == 0, F.lit("0"))
    whole_line = F.concat_ws(" ", *fields, filler, F.year("l_shipdate").cast("string"))
    line = (
        F.when(kind == 0, F.concat_ws(" ", *fields[:3]))
        .when(kind == 8, F.concat(F.lit("\t"), whole_line))
        .otherwise(whole_line)
    )
    file_name = F.when(kind == 6, F.lit("acapulco")).otherwise(F.initcap(stem))
    rows = table(spark, sf_dir, "lineitem")
    if late is not None:
        rows = rows.where((F.col("l_suppkey") % 5 == 0) == F.lit(late))
    return rows.select(
        line.alias("data"), F.concat(F.lit("/landing/swell/"), file_name, F.lit(f".v{version}.txt")).alias("source_file"))
