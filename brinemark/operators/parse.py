"""Raw lines to typed measures, in one pass over the lines.

Later filters on parsed values would be pushed under the projections and parse
every line again for each use of a value. Two one-row generators stop that: what
lies under them is evaluated once per line. The steps between are kept small
enough for the JVM to compile each generated method.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brinemark import fixed_values as fv
from brinemark.functions import text, waves


def tokenize(df: DataFrame, line: str = "data", reference_trim: bool = False) -> DataFrame:
    """Append ``tokens``, split once per line."""
    once = F.explode(F.array(text.tokens(F.col(line), reference_trim)))
    return df.select("*", once.alias("tokens"))


def with_struct_check(df: DataFrame, allowed=fv.LINE_WIDTHS) -> DataFrame:
    """Flag lines with an expected token count; a NULL line counts as bad."""
    right_width = F.size("tokens").isin(*allowed)
    return df.withColumn("well_formed", F.coalesce(right_width, F.lit(False)))


def decode(df: DataFrame, dp: int = 4, steepness: bool = False) -> DataFrame:
    """Typed columns of tokenised lines.

    Both line layouts agree on the leading tokens and keep the year last, so one
    projection serves both. Tokens that do not parse give NULL.
    """

    def token(i):
        return F.get("tokens", F.lit(i))

    numbers = df.select(
        "*",
        waves.whole(F.get("tokens", F.size("tokens") - 1)).alias("year"),
        waves.whole(token(fv.TOKEN_MONTH)).alias("_month"),
        waves.whole(token(fv.TOKEN_DAY)).alias("_day"),
        waves.whole(token(fv.TOKEN_HOUR)).alias("_hour"),
        waves.number(token(fv.TOKEN_WIND_SPEED)).alias("_wind"),
        waves.number(token(fv.TOKEN_WIND_DIR)).alias("_wind_dir"),
        waves.number(token(fv.TOKEN_HEIGHT)).alias("_height"),
        waves.number(token(fv.TOKEN_WAVE_DIR)).alias("_wave_dir"),
        waves.number(token(fv.TOKEN_PERIOD)).alias("_period"),
    )
    height, period = F.col("_height"), F.col("_period")
    wind_cos, wind_sin = waves.circular(F.col("_wind_dir"))
    wave_cos, wave_sin = waves.circular(F.col("_wave_dir"))
    measures = {
        "wind_speed_ms": F.col("_wind"),
        "wind_direction_deg": F.col("_wind_dir"),
        "wind_cos_direction": wind_cos,
        "wind_sin_direction": wind_sin,
        "wave_height_m": height,
        "wave_direction_deg": F.col("_wave_dir"),
        "wave_cos_direction": wave_cos,
        "wave_sin_direction": wave_sin,
        "wave_period_s": period,
        "wave_energy": waves.wave_energy(height),
        "wave_power_kW_m": waves.wave_power(height, period),
    }
    if steepness:
        measures["wave_steepness"] = waves.wave_steepness(height, period)
    stamp = waves.observed_at(F.col("year"), F.col("_month"), F.col("_day"), F.col("_hour"))
    coast = text.coast_from_path(F.col("source_file"))
    exact = numbers.select(
        *df.columns, "year", coast.alias("coast_name"), stamp.alias("_stamp"),
        *[column.alias(f"_{name}") for name, column in measures.items()])
    narrowed = F.struct(
        F.col("_stamp").alias("datetime"), *[waves.measure(F.col(f"_{name}"), dp).alias(name) for name in measures])
    once = exact.select(*df.columns, "coast_name", "year", F.inline(F.array(narrowed)))
    identity = F.col("line_id") if "line_id" in df.columns else row_key("source_file", "data")
    return once.select(
        *df.columns, identity.alias("id"), "coast_name", "datetime", "year", *measures)


def row_key(*cols: str):
    """An identity from content, for lines without one of their own; equal lines share it."""
    return F.sha2(F.to_json(F.struct(*cols)), 256)


def parse_lines(df: DataFrame, reference_trim: bool = False, dp: int = 4, steepness: bool = False) -> DataFrame:
    """``data`` and ``source_file`` in; decoded columns and ``well_formed`` out."""
    checked = with_struct_check(tokenize(df, "data", reference_trim))
    return decode(checked, dp, steepness).drop("tokens")
