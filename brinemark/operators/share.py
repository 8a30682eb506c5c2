"""Share of each class of a fixed domain per period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brinemark.fixed_values import SEA_STATES


def class_share(
    df: DataFrame,
    periods: Sequence[str | Column],
    key: str | Column,
    cls: str,
    domain: Sequence[str] = SEA_STATES,
    out: str = "percentage",
) -> DataFrame:
    """Percentage of records per class, for every class of the domain.

    Absent classes get 0; records outside the domain count in the total only.
    The domain is a literal, so one aggregate with a conditional count per class
    holds everything: one shuffle of one row per (period, key) and task, and the
    classes are unfolded afterwards without a join.
    """
    domain = list(domain)
    counts = [F.count_if(F.col(cls) == c).alias(f"_n{i}") for i, c in enumerate(domain)]
    grouped = df.groupBy(*periods, key).agg(F.count(F.lit(1)).alias("_total"), *counts)
    names = [c for c in grouped.columns if c != "_total" and not c.startswith("_n")]
    exact = "decimal(38,14)"

    def percent(i):
        share = F.col(f"_n{i}").cast("decimal(18,0)") * F.lit(100) / F.col("_total").cast("decimal(18,0)")
        return F.round(share.cast(exact), 2).cast("float")

    rows = F.array(*[F.struct(F.lit(c).alias(cls), percent(i).alias(out)) for i, c in enumerate(domain)])
    return grouped.select(*names, F.inline(rows))


def sea_state_share(classified: DataFrame) -> DataFrame:
    """The monthly share of the gold table, month as two digits."""
    month = F.date_format("datetime", "MM").alias("month")
    shared = class_share(classified, ["year", month], "coast_name", "wave_classification")
    return shared.select("year", "month", "coast_name", "wave_classification", "percentage")
