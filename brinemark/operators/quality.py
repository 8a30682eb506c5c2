"""Rule tables, and the split of rows into clean and quarantined."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from brinemark import fixed_values as fv


@dataclass(frozen=True)
class Rule:
    """A named condition every clean row meets, and the message if it does not."""

    name: str
    predicate: Callable[[], Column]
    message: str

    def holds(self) -> Column:
        """The condition, with NULL counted as failed."""
        return F.coalesce(self.predicate(), F.lit(False))


def _in_range(column: str, bounds: tuple[float, float]) -> Callable[[], Column]:
    return lambda: F.col(column).between(*bounds)


def observation_rules(bounds: Mapping[str, tuple] = fv.BOUNDS, period: tuple[str, str] | None = None) -> list[Rule]:
    """Rules of the observation table, in the order their messages appear."""

    def dated():
        valid = F.col("datetime").isNotNull()
        if period:
            start, end = [F.lit(day).cast("timestamp") for day in period]
            valid = valid & (F.col("datetime") >= start) & (F.col("datetime") < end)
        return valid

    messages = {
        "wind_speed_ms": fv.MSG_WIND_SPEED,
        "wind_direction_deg": fv.MSG_WIND_DIR,
        "wave_height_m": fv.MSG_HEIGHT,
        "wave_direction_deg": fv.MSG_WAVE_DIR,
        "wave_period_s": fv.MSG_PERIOD,
    }
    rules = [
        Rule("coast", lambda: F.col("coast_name") != "", fv.MSG_COAST),
        Rule("datetime", dated, fv.MSG_DATE),
    ]
    rules += [Rule(name, _in_range(name, bounds[name]), text) for name, text in messages.items()]
    return rules


RULES = observation_rules()
STRICT_RULES = observation_rules(fv.STRICT_BOUNDS, fv.STRICT_PERIOD)


def apply_rules(df: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One ``ok_<rule>`` column per rule, and ``ok`` for all of them."""
    flagged = df.select("*", *[rule.holds().alias(f"ok_{rule.name}") for rule in rules])
    return flagged.withColumn("ok", reduce(lambda a, b: a & b, [F.col(f"ok_{r.name}") for r in rules]))


def error_reason(rules: Sequence[Rule] = RULES, structure: str | None = "well_formed") -> Column:
    """Messages of all failed rules in order; '' for a clean row.

    A line that is not even well formed gets the structural message alone.
    """
    reasons = F.concat(*[F.when(rule.holds(), "").otherwise(rule.message) for rule in rules])
    if structure is None:
        return reasons
    return F.when(F.col(structure), reasons).otherwise(F.lit(fv.MSG_STRUCTURE))


def split_quality(
    parsed: DataFrame, rules: Sequence[Rule] = RULES, structure: str | None = "well_formed"
) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected): every row is in exactly one of them.

    Rejected rows keep the original line and say why. A row is clean exactly if
    no rule has a message for it.
    """
    passed = reduce(lambda a, b: a & b, [rule.holds() for rule in rules])
    if structure:
        passed = F.coalesce(F.col(structure), F.lit(False)) & passed
    clean = parsed.where(passed).drop(*([structure] if structure else []))
    # A one-row generator: the filter then reads the reason instead of repeating it.
    judged = parsed.select("*", F.explode(F.array(error_reason(rules, structure))).alias("error_reason"))
    return clean, judged.where(F.col("error_reason") != "")


def quarantine_rows(rejected: DataFrame) -> DataFrame:
    """Columns of the quarantine table; nothing is resolved yet."""
    return rejected.select(
        "data",
        "source_file",
        "error_reason",
        "ingestion_timestamp",
        F.current_timestamp().alias("transformation_timestamp"),
        F.lit(False).alias("resolved"),
    )


def drop_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def every_n_years(df: DataFrame, n: int, year: str = "year") -> DataFrame:
    """Years divisible by ``n``; on a partition column this prunes directories."""
    return df.where(F.col(year) % n == 0)


def year_range(df: DataFrame, first: int, last: int, year: str = "year") -> DataFrame:
    """Rows of the years first..last inclusive, whichever order they are given in."""
    return df.where(F.col(year).between(min(first, last), max(first, last)))
