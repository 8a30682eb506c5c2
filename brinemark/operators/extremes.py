"""Peaks over threshold: storms, tail fit, return levels, intervals.

All rows above the threshold are folded, before any shuffle, into one row per
(key, gap-long time bucket): rows of one bucket are closer than the gap and hence
of the same storm. What is left per key is bounded by the calendar (record span
divided by the gap, about 4 900 rows for 40 years at 72 hours), not by the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, Window as W

from brinemark import fixed_values as fv
from brinemark.functions import waves
from brinemark.functions.text import hash_32
from brinemark.operators.quantiles import exact_quantiles
from brinemark.session import stored

MIN_PEAKS = 10
SMALL_SHAPE = 1e-8
GRID = 257
MICROS = 1_000_000


def _micros(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def series_thresholds(
    df: DataFrame, key: str, ts: str, value: str, q: float = fv.THRESHOLD_QUANTILE
) -> DataFrame:
    """Per key: threshold quantile, and first and last record time."""
    return stored(exact_quantiles(
        df, [key], value, {"threshold": q},
        extra=[F.min(_micros(ts)).alias("first_us"), F.max(_micros(ts)).alias("last_us")],
    ), "thresholds")


def exceedances(df: DataFrame, thresholds: DataFrame, key: str, value: str, strict: bool = False) -> DataFrame:
    """Rows at or above (``strict``: above) their key's threshold.

    Thresholds are one row per key; stored, they are broadcast if their bytes allow it.
    """
    joined = df.join(thresholds.select(key, "threshold"), key)
    over = F.col(value) > F.col("threshold") if strict else F.col(value) >= F.col("threshold")
    return joined.where(over)


def extreme_profile(df: DataFrame, thresholds: DataFrame, key: str, value: str, attributes: Sequence[str]) -> DataFrame:
    return exceedances(df, thresholds, key, value).select(key, *attributes, value)


def decluster(over: DataFrame, key: str, ts: str, value: str, gap_seconds: float) -> DataFrame:
    """Storms of rows above threshold, separated by more than the gap.

    A gap of exactly ``gap_seconds`` merges. Each storm keeps its peak, the
    earliest one on ties.
    """
    gap = int(gap_seconds * MICROS)
    at = _micros(ts)
    folded = (
        over.where(F.col(value).isNotNull())
        .withColumn("_at", at)
        .groupBy(key, F.floor(F.col("_at") / gap).alias("_bucket"))
        .agg(
            F.min("_at").alias("_from"),
            F.max("_at").alias("_to"),
            F.count(F.lit(1)).alias("_n"),
            F.max(F.struct(F.col(value).alias("v"), (-F.col("_at")).alias("t"))).alias("_peak"),
        )
    )
    timeline = W.partitionBy(key).orderBy("_bucket")
    apart = F.col("_from") - F.lag("_to").over(timeline) > gap
    starts = F.when(F.coalesce(apart, F.lit(False)), 1).otherwise(0)
    storms = folded.withColumn("_new", starts).withColumn("_storm", F.sum("_new").over(timeline))
    return storms.groupBy(key, "_storm").agg(
        F.min("_from").alias("storm_start_us"),
        F.max("_to").alias("storm_end_us"),
        F.sum("_n").alias("n_over"),
        F.max("_peak").alias("_peak"),
    ).select(
        key, "storm_start_us", "storm_end_us", "n_over",
        (-F.col("_peak.t")).alias("peak_us"), F.col("_peak.v").cast("double").alias("peak"),
    )


def storm_peaks(
    df: DataFrame, key: str, ts: str, value: str, gap_hours: float = fv.STORM_GAP_HOURS,
    q: float = fv.THRESHOLD_QUANTILE,
) -> tuple[DataFrame, DataFrame]:
    """(thresholds, peaks): thresholds as one small table, peaks above it."""
    thresholds = series_thresholds(df, key, ts, value, q)
    narrow = df.select(key, ts, value)
    over = exceedances(narrow, thresholds, key, value, strict=True)
    return thresholds, decluster(over, key, ts, value, gap_hours * 3600)


def ranked_excesses(peaks: DataFrame, thresholds: DataFrame, key: str) -> DataFrame:
    """Excess over threshold with its ascending rank and the key's peak count.

    Peaks per key are bounded by the calendar (see the module text).
    """
    excess = peaks.join(thresholds.select(key, "threshold"), key).select(
        key, "peak_us", (F.col("peak") - F.col("threshold")).alias("excess"))
    order = W.partitionBy(key).orderBy("excess", "peak_us")
    whole = W.partitionBy(key)
    return excess.select(
        key, "excess", F.row_number().over(order).alias("rank"), F.count(F.lit(1)).over(whole).alias("n"))


def _pwm_shape_scale(b0, a1):
    """Generalised-Pareto shape and scale from the first two weighted moments."""
    spread = b0 - 2 * a1
    return F.try_divide(-b0, spread) + 2, F.try_divide(2 * b0 * a1, spread)


def gpd_fit_pwm(excesses: DataFrame, keys: Sequence[str], min_peaks: int = MIN_PEAKS) -> DataFrame:
    """Probability-weighted-moment fit (Hosking and Wallis 1987), all in Spark.

    Needs ``excess``, ``rank`` and ``n``; an optional ``w`` is the multiplicity of
    a value whose last rank is ``rank``. Fewer than ``min_peaks`` give no fit.
    """
    weight = F.col("w") if "w" in excesses.columns else F.lit(1)
    n = F.col("n")
    # Ranks rank-w+1 .. rank share the value: their plotting positions add up.
    mean_rank = F.col("rank") - (weight - 1) / F.lit(2.0)
    rest = 1 - (mean_rank - 0.35) / n
    moments = excesses.groupBy(*keys).agg(
        F.max("n").alias("n_peaks"),
        (F.sum(weight * F.col("excess")) / F.max("n")).alias("_b0"),
        (F.sum(weight * rest * F.col("excess")) / F.max("n")).alias("_a1"),
    )
    shape, scale = _pwm_shape_scale(F.col("_b0"), F.col("_a1"))
    enough = F.col("n_peaks") >= min_peaks
    return moments.select(
        *keys, "n_peaks", F.when(enough, shape).alias("shape"), F.when(enough, scale).alias("scale"))


def _profile(v: np.ndarray, y: np.ndarray, w: np.ndarray):
    """Shape, scale and slope of the profile likelihood at t = shape / scale = expm1(v) / max(y).

    ``w`` are weights that add up to 1. In ``v`` the largest excess stays exact however
    close 1 + t max(y) comes to zero.
    """
    top = y.max()
    inner = 1 + np.multiply.outer(np.expm1(v), y / top)
    inner[:, y == top] = np.exp(v)[:, None]
    logs = np.log(inner)
    logs[:, y == top] = v[:, None]
    shape, slope, t = logs @ w, (y / inner) @ w, np.expm1(v) / top
    flat = np.abs(v) < 1e-7  # an exponential tail: limits for t to 0
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        score = np.where(flat, (y * y) @ w / (2 * (y @ w)) - y @ w, 1 / t - slope * (1 + 1 / shape))
        scale = np.where(flat, y @ w, shape / t)
    return shape, scale, score


def _mle_shape_scale(y: np.ndarray, w: np.ndarray) -> tuple[float, float] | None:
    """Interior maximum of the likelihood (one-parameter profile, Grimshaw 1993), or None.

    The slope of the profile must change its sign from plus to minus where the shape is
    above -1; below, the likelihood has no bound, and a sample whose likelihood only
    rises towards that edge has no fit. No root lies beyond 2 (mean - min) / min^2. Of
    several maxima the highest counts.
    """
    w = w / w.sum()
    top, least, mean = y.max(), y.min(), y @ w
    if not 0 < least < top:
        return None
    v = np.linspace(-30.0, np.log1p(top * 2 * (mean - least) / least**2) + 1e-3, GRID)
    shape, _, score = _profile(v, y, w)
    found = np.flatnonzero((shape[:-1] > -1) & (score[:-1] > 0) & (score[1:] <= 0))
    fits = []
    for k in found:
        low, high = v[k], v[k + 1]
        for _ in range(11):
            cuts = np.linspace(low, high, 17)
            score = _profile(cuts, y, w)[2]
            at = int(np.argmax(score <= 0))
            low, high = cuts[max(at - 1, 0)], cuts[max(at, 1)]
        shape, scale, _ = (float(x[0]) for x in _profile(np.array([(low + high) / 2]), y, w))
        if shape > -1 and scale > 0:
            fits.append((-np.log(scale) - shape, shape, scale))
    return max(fits)[1:] if fits else None


def gpd_fit_mle(excesses: DataFrame, keys: Sequence[str], min_peaks: int = MIN_PEAKS) -> DataFrame:
    """Maximum-likelihood fit; NULL shape and scale where there are fewer than ``min_peaks`` or no maximum.

    A group is one row of declustered peaks, bounded by the calendar; one call fits the
    groups of an Arrow batch.
    """
    weight = F.col("w") if "w" in excesses.columns else F.lit(1).cast("long")
    tasks = int(excesses.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # An explicit number: a few bytes are much work here, so they must not be coalesced.
    groups = excesses.select(*keys, F.struct(F.col("excess").cast("double").alias("y"), weight.alias("w")).alias("_p"))
    groups = groups.repartition(tasks, *keys).groupBy(*keys).agg(F.sort_array(F.collect_list("_p")).alias("_p"))

    @F.pandas_udf("shape double, scale double")
    def fitted(excess: pd.Series, times: pd.Series) -> pd.DataFrame:
        fits = []
        for y, w in zip(excess, times):
            y, w = np.asarray(y, float), np.asarray(w, float)
            enough = w.sum() >= min_peaks and y.max() > 0
            fits.append((_mle_shape_scale(y, w) if enough else None) or (None, None))
        return pd.DataFrame(fits, columns=["shape", "scale"], dtype=float)

    n_peaks = F.aggregate("_p.w", F.lit(0).cast("long"), lambda s, n: s + n)
    fits = groups.select(*keys, n_peaks.alias("n_peaks"), fitted(F.col("_p.y"), F.col("_p.w")).alias("_fit"))
    # NaN is how a missing number comes back from NumPy.
    return fits.select(*keys, "n_peaks", *[F.nanvl(f"_fit.{c}", F.lit(None).cast("double")).alias(c) for c in ("shape", "scale")])


def gpd_fit(excesses: DataFrame, keys: Sequence[str], method: str = "pwm", min_peaks: int = MIN_PEAKS) -> DataFrame:
    if method not in ("pwm", "mle"):
        raise ValueError(f"fit method must be 'pwm' or 'mle', not {method!r}")
    return (gpd_fit_pwm if method == "pwm" else gpd_fit_mle)(excesses, keys, min_peaks)


def return_level(fit: DataFrame, thresholds: DataFrame, key: str, periods: Sequence[int] = fv.RETURN_PERIODS) -> DataFrame:
    """Level exceeded once per period (years) on average; one row per period.

    The rate is peaks per year of record (Coles 2001, chapter 4); a shape near 0
    uses the exponential limit.
    """
    years = (F.col("last_us") - F.col("first_us")) / F.lit(fv.DAYS_PER_YEAR * 86400 * MICROS)
    rows = fit.join(thresholds, key).withColumn("rate", F.try_divide(F.col("n_peaks").cast("double"), years))
    spread = rows.select(
        *[c for c in fit.columns], "threshold", "rate",
        F.explode(F.array(*[F.lit(int(p)) for p in periods])).alias("period"))
    shape, scale = F.col("shape"), F.col("scale")
    expected = F.col("rate") * F.col("period")
    tail = F.when(F.abs(shape) < SMALL_SHAPE, F.log(expected)).otherwise(
        (F.pow(expected, shape) - 1) / shape)
    return spread.withColumn("level", F.col("threshold") + scale * tail)


def bootstrap_draws(excesses: DataFrame, key: str, resamples: int, seed: int = 0) -> DataFrame:
    """Resamples of each key's excesses, with multiplicities and final ranks.

    Draw i of resample b takes the excess whose rank is a hash of (seed, key, b,
    i), so a lost executor's tasks draw the same again. Multiplicity stands for
    repeated draws; resamples are spread over tasks by (key, b).
    """
    counts = excesses.groupBy(key).agg(F.max("n").alias("n"))
    # An explicit number: the few rows to spread out must not be coalesced again.
    tasks = int(excesses.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    draws = (
        counts.withColumn("b", F.explode(F.sequence(F.lit(1), F.lit(resamples))))
        .repartition(tasks, key, "b")
        .withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
        .withColumn("rank", F.coalesce(hash_32(F.lit(seed), F.col(key), F.col("b"), F.col("_i")) % F.col("n"), F.lit(0)) + 1)
        .groupBy(key, "b", "n", "rank").agg(F.count(F.lit(1)).alias("w"))
    )
    values = excesses.select(key, "rank", "excess")
    upto = W.partitionBy(key, "b").orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    return draws.join(values, [key, "rank"]).select(
        key, "b", "n", "w", "excess", F.sum("w").over(upto).alias("rank"))


def return_level_ci(
    excesses: DataFrame, thresholds: DataFrame, key: str, periods: Sequence[int] = fv.RETURN_PERIODS,
    resamples: int = fv.BOOTSTRAP_RESAMPLES, confidence: float = fv.CONFIDENCE, seed: int = 0, method: str = "pwm",
    min_peaks: int = MIN_PEAKS,
) -> DataFrame:
    """Bootstrap percentile interval of each return level (``lower``, ``upper``).

    Refits follow the rule of the fit itself: those that are not ``usable`` stay out,
    and ``resamples`` says how many went in.
    """
    fits = gpd_fit(bootstrap_draws(excesses, key, resamples, seed), [key, "b"], method, min_peaks).where(usable())
    levels = stored(return_level(fits, thresholds, key, periods).select(key, "period", "level"), "bootstrap")
    tail = (1 - confidence) / 2
    return exact_quantiles(
        levels, [key, "period"], "level", {"lower": tail, "upper": 1 - tail}, extra=[F.count("level").alias("resamples")])


def usable():
    """Whether a tail fit can give levels."""
    return F.col("shape").isNotNull() & F.col("scale").isNotNull() & (F.col("scale") > 0)


def fit_failures(fit: DataFrame, thresholds: DataFrame, key: str, method: str = "pwm", min_peaks: int = MIN_PEAKS) -> DataFrame:
    """Keys of ``thresholds`` without a usable ``fit``: key, n_peaks and the reason."""
    peaks = F.coalesce("n_peaks", F.lit(0)).cast("long")
    unfit = "no maximum of the likelihood above shape -1" if method == "mle" else "no positive scale"
    failed = thresholds.select(key).join(fit.where(usable()).select(key), key, "left_anti")
    return failed.join(fit.select(key, "n_peaks"), key, "left").select(
        key, peaks.alias("n_peaks"), F.when(peaks < min_peaks, F.lit(f"fewer than {min_peaks} peaks")).otherwise(unfit).alias("error"))


def forecast_levels(
    excesses: DataFrame, thresholds: DataFrame, key: str, periods: Sequence[int] = fv.RETURN_PERIODS,
    resamples: int = fv.BOOTSTRAP_RESAMPLES, confidence: float = fv.CONFIDENCE, seed: int = 0, method: str = "pwm",
    min_peaks: int = MIN_PEAKS,
) -> tuple[DataFrame, DataFrame]:
    """(levels, failures): mean, lower and upper per (key, period); and the keys
    whose tail could not be fitted, with the reason."""
    fit = stored(gpd_fit(excesses, [key], method, min_peaks), "tail-fits")
    point = return_level(fit.where(usable()), thresholds, key, periods)
    interval = return_level_ci(excesses, thresholds, key, periods, resamples, confidence, seed, method, min_peaks)
    levels = point.select(key, "period", F.col("level").alias("mean")).join(interval.drop("resamples"), [key, "period"])
    return levels, fit_failures(fit, thresholds, key, method, min_peaks)


def band_periods(
    profile: DataFrame, power: str, period: str, edges=fv.POWER_EDGES, labels=fv.POWER_LABELS
) -> DataFrame:
    """Median wave period of the extreme rows per power band, and over all rows
    (band NULL). Bands pool all keys."""
    band = waves.band(F.col(power).cast("double"), edges, labels)
    # Each row counts in its band and overall (NULL); a row without a band once.
    both = F.explode(F.array_distinct(F.array(band, F.lit(None).cast("string"))))
    banded = profile.select(both.alias("band"), F.col(period).alias("_t"))
    return exact_quantiles(banded, ["band"], "_t", {"median_period": 0.5})


def assoc_period(df: DataFrame, power: str, periods: DataFrame, edges=fv.POWER_EDGES, labels=fv.POWER_LABELS,
                 out: str = "assoc_period") -> DataFrame:
    """Attach the median period of the value's band.

    Falls back to the overall median when the value has no band or the band has
    no rows. The lookup has one row per band plus one, so it is fetched and used
    as literals.
    """
    found = {row["band"]: row["median_period"] for row in periods.limit(len(labels) + 2).collect()}
    name = waves.band(F.col(power).cast("double"), edges, labels)
    chosen = F.lit(None).cast("double")
    for label in labels:
        if found.get(label) is not None:
            chosen = F.when(name == label, F.lit(float(found[label]))).otherwise(chosen)
    return df.withColumn(out, F.coalesce(chosen, F.lit(found.get(None)).cast("double")))


def design_heights(levels: DataFrame, periods: DataFrame) -> DataFrame:
    """Heights that carry the mean, lower and upper power levels."""
    out = levels
    periods = stored(periods, "band-periods")
    for bound in ("mean", "lower", "upper"):
        out = assoc_period(out, bound, periods, out=f"_t_{bound}")
        out = out.withColumn(f"height_{bound}", waves.height_from_power(F.col(bound), F.col(f"_t_{bound}")))
    return out.drop("_t_mean", "_t_lower", "_t_upper")
