"""Expressions over wind and wave measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from brinemark.fixed_values import (
    GRAVITY,
    POWER_COEFFICIENT_KW,
    POWER_COEFFICIENT_W,
    SEA_WATER_DENSITY,
)


def number(token: Column) -> Column:
    """A token as double; NULL when it is not a number."""
    return token.try_cast("double")


def whole(token: Column) -> Column:
    """A numeric token ('5.0' included) as int; NULL when it is not a number."""
    return number(token).try_cast("int")


def observed_at(year: Column, month: Column, day: Column, hour: Column) -> Column:
    """Timestamp of integer parts; NULL for impossible dates.

    The year must have four digits, as in the pattern ``yyyy-M-d H``.
    """
    zero = F.lit(0)
    valid_year = F.when(year.between(1000, 9999), year)
    stamp = F.try_make_timestamp_ntz(valid_year, month, day, hour, zero, zero.cast("decimal(16,6)"))
    return stamp.cast("timestamp")


def round_half_up(value: Column, dp: int) -> Column:
    """``round`` of a double, without its decimal arithmetic where that is safe.

    Away from a tie and within the exact range of the product, the nearest
    multiple is the same by either way; all other values take ``round``.
    """
    scale = 10.0 ** dp
    shifted = value * scale
    nearest = F.rint(shifted)
    safe = (F.abs(shifted - nearest) < 0.499999) & (F.abs(shifted) < 4e9)
    # Adding zero turns a negative zero into zero, as ``round`` gives it.
    return F.when(safe, nearest / scale + F.lit(0.0)).otherwise(F.round(value, dp))


def measure(value: Column, dp: int = 4) -> Column:
    """A measure at ``dp`` decimals (half up), narrowed to float."""
    return round_half_up(value.cast("double"), dp).cast("float")


def circular(degrees: Column) -> tuple[Column, Column]:
    """Cosine and sine of a direction in degrees."""
    angle = F.radians(degrees)
    return F.cos(angle), F.sin(angle)


def wave_energy(height: Column) -> Column:
    """Energy density (J/m²) of waves of this height."""
    return F.lit(GRAVITY * SEA_WATER_DENSITY / 8) * height * height


def wave_power(height: Column, period: Column) -> Column:
    """Energy flux (kW per metre of crest)."""
    return POWER_COEFFICIENT_W * height * height * period / 1000


def wave_steepness(height: Column, period: Column) -> Column:
    """Height over squared period; NULL for a zero period."""
    return F.try_divide(height, period * period)


def daily_power(mean_height: Column, period_a: Column, period_b: Column) -> Column:
    """Daily power proxy: mean height with the midpoint of two periods."""
    return POWER_COEFFICIENT_KW * mean_height * mean_height * (period_a + period_b) / 2


def height_from_power(power: Column, period: Column) -> Column:
    """Height that carries this power at this period; NULL for no period."""
    return F.sqrt(F.try_divide(power, POWER_COEFFICIENT_KW * period))


def wind_proxy(mode: str, at_max: Column, at_min: Column) -> Column:
    """Daily wind: at the highest wave (``max``) or between the two (``mid``)."""
    if mode == "max":
        return at_max
    if mode == "mid":
        return (at_max + at_min) / 2
    raise ValueError(f"wind mode must be 'max' or 'mid', not {mode!r}")


def safe_round(value: Column, dp: int) -> Column:
    """Value as a rounded double; NULL when not a number (rounds half up)."""
    v = value.try_cast("double")
    return F.round(F.when(~F.isnan(v), v), dp)


def band_labels(edges: Sequence[float | None]) -> list[str]:
    """Readable labels for right-closed bands, derived from their edges."""
    first, *rest = [f"{e:g}" if e is not None else None for e in edges[1:]]
    labels = [f"<={first}"]
    low = first
    for high in rest:
        labels.append(f">{low} - {high}" if high is not None else f">{low}")
        low = high
    return labels


def band(value: Column, edges: Sequence[float | None], labels: Sequence[str] | None = None) -> Column:
    """Label of the right-closed band (low, high] holding the value.

    A final edge of None means no upper limit. Values at or under the lowest
    edge, or over the highest, get NULL.
    """
    labels = list(labels) if labels is not None else band_labels(edges)
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per band is needed")
    chosen = F.when(value.isNull() | F.isnan(value) | (value <= edges[0]), F.lit(None).cast("string"))
    for high, label in zip(edges[1:], labels):
        chosen = chosen.when(value <= high, label) if high is not None else chosen.otherwise(F.lit(label))
    return chosen


def sector(degrees: Column, n: int = 32) -> Column:
    """Centre of the directional sector; sector 0 is centred on north."""
    step = 360.0 / n
    index = F.pmod(F.floor((degrees + step / 2) / step), F.lit(n))
    return index * F.lit(step)
