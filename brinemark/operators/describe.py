"""Descriptive statistics, histograms, roses and distribution curves."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, functions as F, Window as W

from brinemark.functions import waves
from brinemark.operators.quantiles import exact_quantiles, running_count
from brinemark.session import stored

EULER_GAMMA = 0.5772156649015329


def describe(df: DataFrame, cols: Sequence[str], by: str | None = None) -> DataFrame:
    """Profile of each column: counts, moments, extremes and quartiles.

    Columns become rows of (variable, value), so all of them share one scan.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in cols])
    keys = ([by] if by else []) + ["variable"]
    long = df.select(*([by] if by else []), F.inline(pairs))
    moments = [
        F.count("value").alias("count"),
        F.count_if(F.col("value").isNull()).alias("null_count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]
    quartiles = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    profile = exact_quantiles(long, keys, "value", quartiles, extra=moments)
    return profile.select(*keys, "count", "null_count", "mean", "std", "min", "q25", "q50", "q75", "max")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlations as rows (variable, other, corr), from one aggregate.

    Rows with a NULL in either column of a pair are left out of that pair.
    """
    pairs = list(combinations(cols, 2))
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for a in cols:
        for b in cols:
            if a == b:
                value = F.lit(1.0)
            else:
                value = F.col(f"_{pairs.index((a, b) if (a, b) in pairs else (b, a))}")
            cells.append(F.struct(F.lit(a).alias("variable"), F.lit(b).alias("other"), value.alias("corr")))
    return one.select(F.inline(F.array(*cells)))


def preview(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """First rows of a series in time order; each task keeps only ``n``."""
    return df.orderBy(*order).limit(n)


def month_mean_std(df: DataFrame, month: str, value: str) -> DataFrame:
    return df.groupBy(month).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


def fd_histogram(df: DataFrame, value: str) -> DataFrame:
    """Histogram of even bins, their number by Freedman and Diaconis.

    Width 2·IQR·n^(-1/3) gives ceil(range / width) bins; a zero width gives one.
    The last bin is closed. Only bins with rows are listed, each with their number
    ``bins``: one far value can make millions of empty ones.
    """
    shape = exact_quantiles(
        df, [], value, {"q25": 0.25, "q75": 0.75},
        extra=[F.count(value).alias("n"), F.min(F.col(value).cast("double")).alias("lo"),
               F.max(F.col(value).cast("double")).alias("hi")],
    ).first()
    if not shape["n"]:
        return df.sparkSession.createDataFrame([], "bin bigint, bin_lo double, bin_hi double, count bigint, bins bigint")
    lo, hi = shape["lo"], shape["hi"]
    width = 2.0 * (shape["q75"] - shape["q25"]) / shape["n"] ** (1.0 / 3.0)
    bins = max(1, -int(-((hi - lo) / width) // 1)) if width > 0 else 1
    step = (hi - lo) / bins
    v = F.col(value).cast("double")
    index = F.least(F.floor((v - lo) / step).cast("long"), F.lit(bins - 1).cast("long")) if step > 0 else F.lit(0).cast("long")
    counts = df.where(v.isNotNull()).groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return counts.select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(step)).alias("bin_lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(step)).alias("bin_hi"),
        "count", F.lit(bins).cast("long").alias("bins"),
    )


def direction_rose(
    df: DataFrame, direction: str, value: str, edges: Sequence[float], labels: Sequence[str] | None = None, n: int = 32
) -> DataFrame:
    """Percentage of rows per (sector, band), every combination listed.

    Values outside the bands stay in the denominator. The scan is reduced to one
    row per sector, with a conditional count per band.
    """
    labels = list(labels) if labels is not None else waves.band_labels(edges)
    placed = df.dropna(subset=[direction, value]).select(
        waves.sector(F.col(direction).cast("double"), n).alias("sector"),
        waves.band(F.col(value).cast("double"), edges, labels).alias("_band"),
    )
    counts = placed.groupBy("sector").agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(F.col("_band") == label).alias(f"_n{i}") for i, label in enumerate(labels)],
    )
    step = 360.0 / n
    grid = df.sparkSession.range(n).select((F.col("id") * F.lit(step)).alias("sector"))
    filled = grid.join(counts, "sector", "left").na.fill(0)
    # At most ``n`` rows are left here, so an unpartitioned window is harmless.
    total = F.sum("_all").over(W.partitionBy())
    cells = F.array(*[
        F.struct(F.lit(i).alias("band_no"), F.lit(label).alias("band"), F.col(f"_n{i}").alias("count"))
        for i, label in enumerate(labels)
    ])
    return filled.withColumn("_total", total).select("sector", "_total", F.inline(cells)).select(
        "sector", "band_no", "band", "count",
        F.coalesce(F.try_divide(F.col("count") * 100.0, F.col("_total")), F.lit(0.0)).alias("percentage"),
    )


def band_counts(df: DataFrame, value: str, edges, labels=None) -> DataFrame:
    return df.groupBy(waves.band(F.col(value).cast("double"), edges, labels).alias("band")).agg(
        F.count(F.lit(1)).alias("count"))


def contingency(df: DataFrame, rows: str, cols: str, values: Sequence, normalize: bool = False) -> DataFrame:
    """Counts per (row, column value), one output column per listed value.

    ``normalize`` divides by the row total over all column values.
    """
    counted = df.groupBy(rows).agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(F.col(cols) == v).alias(str(v)) for v in values],
    )
    if normalize:
        return counted.select(rows, *[(F.col(f"`{v}`") / F.col("_all")).alias(str(v)) for v in values])
    return counted.drop("_all")


def gumbel_moments(df: DataFrame, key: str, value: str) -> DataFrame:
    """Gumbel location and scale by the method of moments (extension)."""
    grouped = df.groupBy(key).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count(value).alias("n"))
    scale = F.col("std") * F.lit(6.0 ** 0.5) / F.pi()
    return grouped.withColumn("scale", scale).withColumn("location", F.col("mean") - F.lit(EULER_GAMMA) * F.col("scale"))


def gumbel_histogram(df: DataFrame, value: str) -> DataFrame:
    """Histogram with the count a fitted Gumbel distribution expects per bin (extension)."""
    fit = gumbel_moments(df.withColumn("_all", F.lit("all")), "_all", value).first()
    bins = fd_histogram(df, value)
    if fit is None or not fit["scale"]:
        return bins.withColumn("expected", F.lit(None).cast("double"))

    def below(x):
        return F.exp(-F.exp(-(x - F.lit(fit["location"])) / F.lit(fit["scale"])))

    return bins.withColumn("expected", F.lit(fit["n"]) * (below(F.col("bin_hi")) - below(F.col("bin_lo"))))


def exceedance_curve(df: DataFrame, key: str, value: str) -> DataFrame:
    """Per key and distinct value: share of rows strictly above it (extension).

    Rows are first folded into distinct values with their multiplicity.
    """
    counted = stored(df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("n")), "value-counts")
    ranked = running_count(counted, [key], value, "n", "below")
    totals = counted.groupBy(key).agg(F.sum("n").alias("total"))
    return ranked.join(totals, key).select(
        key, value, (1.0 - (F.col("below") + F.col("n")) / F.col("total")).alias("p_exceed"))
