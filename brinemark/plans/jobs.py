"""The jobs a user runs, each over one base folder of tables.

    ingest -> refine -> train -> classify -> daily, monthly_share, forecast -> payload

``base`` must be a folder that all executors reach.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from brinemark import fixed_values as fv
from brinemark.operators import daily as daily_ops, describe, extremes, forecast as forecast_ops
from brinemark.operators import metrics as metric_ops, payload as payload_ops, quality, sampling, seastate, share
from brinemark.session import cut_lineage, spread, stored
from brinemark.sources import schemas, tables
from brinemark.streaming.runs import classify, ingest, refine

__all__ = ["ingest", "refine", "classify", "daily", "monthly_share", "forecast", "forecast_rows", "train",
           "train_rows", "payload", "explore"]

GOLD_DAILY_FOLDER = schemas.GOLD_DAILY.partition_by
PROGRESS = "refined_until timestamp"


def silver(spark: SparkSession, base: str) -> DataFrame:
    return tables.read_table(spark, schemas.SILVER_METRICS.path(base), schemas.SILVER_METRICS.schema)


def read_daily(spark: SparkSession, base: str) -> DataFrame:
    """The daily table; its folder column ``year`` is kept for pruning."""
    return tables.read_or_empty(spark, schemas.GOLD_DAILY.path(base), schemas.GOLD_DAILY.schema)


def progress_path(base: str, late: str) -> str:
    return f"{base.rstrip('/')}/progress/{schemas.GOLD_DAILY.layer}_{schemas.GOLD_DAILY.name}_{late}"


def read_progress(spark: SparkSession, base: str, late: str) -> datetime | None:
    """When the newest row was refined that the daily table takes account of in the sense of ``late``; None if unknown."""
    marks = tables.read_or_empty(spark, progress_path(base, late), PROGRESS)
    return marks.agg(F.max("refined_until")).first()[0]


def daily(spark: SparkSession, base: str, late: str = "skip", since: str | None = None) -> None:
    """Daily extremes of observations to gold; a run costs what is new.

    Observations refined after a mark are new. The mark is kept in ``progress`` and
    moves when the daily table has been written, so a run that dies is repeated;
    ``since`` (a timestamp) overrides it. ``late='skip'`` appends days without a summary
    and leaves the others alone, so rows that arrive for a summarised day are never
    seen. ``late='recompute'`` rebuilds the days that got observations and no others:
    of the observations only the folders of their coasts and years are read, and only
    their year folders of the daily table are replaced. The two ways keep a mark each;
    without one, all history is new.
    """
    if late not in ("skip", "recompute"):
        raise ValueError(f"late must be 'skip' or 'recompute', not {late!r}")
    path, observed = schemas.GOLD_DAILY.path(base), silver(spark, base)
    first_run = not tables.table_exists(spark, path)
    since = F.lit(since).cast("timestamp") if since is not None else F.lit(read_progress(spark, base, late))
    fresh = observed.where(since.isNull() | (F.col("transformation_timestamp") > since))
    until = fresh.agg(F.max("transformation_timestamp")).first()[0]
    if late == "skip":
        rows = daily_ops.new_daily_rows(fresh, read_daily(spark, base))
        tables.append_table(rows.withColumn("year", F.year("date")), path, GOLD_DAILY_FOLDER)
    else:
        _rebuild_days(spark, base, observed, fresh)
    schemas.recover_partitions(spark, schemas.GOLD_DAILY)
    if until is not None:
        for name in {late, "skip", *(["recompute"] if first_run else [])}:
            mark = spark.createDataFrame([(until,)], PROGRESS)
            tables.overwrite_table(mark, progress_path(base, name))


def _rebuild_days(spark: SparkSession, base: str, observed: DataFrame, fresh: DataFrame) -> None:
    days = fresh.select("coast_name", F.to_date("datetime").alias("date"), "year").distinct()
    touched = stored(days, "touched-days")
    # As many values as there are years and coasts: they name the folders to read.
    years = [r["year"] for r in touched.select("year").distinct().collect()]
    coasts = [r["coast_name"] for r in touched.select("coast_name").distinct().collect()]
    day = touched.select(F.col("coast_name").alias("_coast"), F.col("date").alias("_day"))
    again = observed.where(F.col("year").isin(years) & F.col("coast_name").isin(coasts))
    again = again.join(day, (F.col("coast_name") == F.col("_coast")) & (F.to_date("datetime") == F.col("_day")), "left_semi")
    kept = read_daily(spark, base).where(F.col("year").isin(years)).join(
        day, (F.col("coast_name") == F.col("_coast")) & (F.col("date") == F.col("_day")), "left_anti")
    rebuilt = daily_ops.daily_summary(again).withColumn("year", F.year("date"))
    # Written first: a folder cannot be replaced by what is read from it.
    rows = stored(kept.select(*rebuilt.columns).unionByName(rebuilt), "rebuilt-days")
    tables.overwrite_partitions(rows, schemas.GOLD_DAILY.path(base), GOLD_DAILY_FOLDER)


def monthly_share(spark: SparkSession, base: str) -> None:
    classes = tables.read_table(spark, schemas.SILVER_CLASSES.path(base), schemas.SILVER_CLASSES.schema)
    tables.overwrite_table(share.sea_state_share(classes), schemas.GOLD_MONTHLY.path(base))


def forecast_rows(
    observed: DataFrame, *, key: str = "coast_name", ts: str = "datetime", power: str = "wave_power_kW_m",
    period: str = "wave_period_s", attributes: Sequence[str] = ("wave_height_m", "wave_direction_deg"),
    gap_hours: float = fv.STORM_GAP_HOURS, q: float = fv.THRESHOLD_QUANTILE,
    return_periods: Sequence[int] = fv.RETURN_PERIODS, resamples: int = fv.BOOTSTRAP_RESAMPLES,
    method: str = "mle", seed: int = 0, min_peaks: int = extremes.MIN_PEAKS,
) -> tuple[DataFrame, DataFrame]:
    """(forecast, failures) of a series table.

    ``method``: ``mle`` (maximum likelihood) or ``pwm`` (weighted moments). Keys with
    fewer than ``min_peaks`` storms, or without a usable fit, are in ``failures``.

    The series is scanned three times for a few columns: twice for the threshold,
    once for the rows at or above it. Those, about a twentieth, are written once;
    peaks and band medians come from them.
    """
    thresholds = extremes.series_thresholds(observed, key, ts, power, q)
    narrow = observed.select(key, ts, power, *[c for c in (*attributes, period) if c in observed.columns])
    over = stored(extremes.exceedances(narrow, thresholds, key, power), "exceedances")
    peaks = extremes.decluster(over.where(F.col(power) > F.col("threshold")), key, ts, power, gap_hours * 3600)
    excesses = stored(extremes.ranked_excesses(peaks, thresholds, key), "excesses")
    levels, failures = extremes.forecast_levels(
        excesses, thresholds, key, return_periods, resamples, seed=seed, method=method, min_peaks=min_peaks)
    periods = extremes.band_periods(over.select(key, *attributes, period, power), power, period)
    heights = extremes.design_heights(levels, periods)
    return forecast_ops.tidy_forecast(heights, key), failures


def forecast(spark: SparkSession, base: str, **options) -> DataFrame:
    """Design levels to gold, and the coasts without any to their own table; returns those.

    Both tables are replaced, not appended.
    """
    rows, failures = forecast_rows(silver(spark, base), **options)
    tables.overwrite_table(rows, schemas.GOLD_FORECAST.path(base))
    tables.overwrite_table(failures, schemas.GOLD_FAILURES.path(base))
    return tables.read_table(spark, schemas.GOLD_FAILURES.path(base), schemas.GOLD_FAILURES.schema)


def train_rows(
    frame: DataFrame, ids: Sequence[str], *, features: Sequence[str] = fv.MODEL_FEATURES,
    extreme_features: Sequence[str] = fv.EXTREME_FEATURES, k: int = fv.GMM_COMPONENTS, trees: int = fv.FOREST_TREES,
    max_depth: int = 30, max_iter: int = 100, seed: int = fv.TRAIN_SEED, enforce_gates: bool = True,
) -> seastate.TrainingResult:
    """Cluster, label and learn from a frame of complete feature rows.

    ``ids`` name the columns that identify a row; the split hashes them. With
    ``enforce_gates`` off, the gates stop nothing and the model comes back all the
    same; ``accepted`` always tells whether both were passed. Mixture and forest are
    fitted on all training rows, gates and figures use all that were held out.
    """
    train, test = sampling.split(frame, fv.TEST_SHARE, ids, seed)
    bounds = seastate.extreme_thresholds(train, extreme_features)
    extreme = seastate.extreme_mask(bounds)
    mixture = seastate.fit_mixture(train.where(~extreme), features, k, seed, max_iter)
    scored_train = seastate.apply_mixture(mixture, train.where(~extreme))
    order = {r["cluster"]: r["label"] for r in seastate.order_clusters(scored_train, extreme_features).collect()}
    gate = seastate.gmm_gate(seastate.apply_mixture(mixture, test.where(~extreme))).withColumn(
        "label", mapped("cluster", order))
    if enforce_gates and not all(r["passed"] for r in gate.select("passed").collect()):
        return seastate.TrainingResult(None, gate, None, None, False)
    columns = [*ids, *features, "label"]
    labelled = seastate.label_rows(train, mixture, order, extreme, k + 1).select(*columns)
    model = seastate.fit_forest(labelled, features, trees, max_depth, seed=seed)
    held_out = seastate.label_rows(test, mixture, order, extreme, k + 1).select(*columns)
    points = seastate.split_points(model, features)
    cells = stored(seastate.cell_labels(held_out, model, features, points), "cell-labels")
    predicted = seastate.predict(held_out, model, cells, features, points).select(*columns, F.col("prediction").cast("int").alias("prediction"))
    figures = metric_ops.forest_gate(metric_ops.classification_metrics(predicted, "label", "prediction"))
    passed = figures.first()["accepted"] and all(r["passed"] for r in gate.select("passed").collect())
    return seastate.TrainingResult(model if passed or not enforce_gates else None, gate, figures, predicted, passed)


def mapped(column: str, mapping: dict[int, int]):
    """The column's values replaced by a small mapping; NULL for others."""
    chosen = F.lit(None).cast("int")
    for value, label in mapping.items():
        chosen = F.when(F.col(column) == value, F.lit(label)).otherwise(chosen)
    return chosen


def training_source(observed: DataFrame, coast: str | None = None, fraction: float = 1.0, ids: Sequence[str] = ("id",)) -> DataFrame:
    """Every third year, of one coast if named; ``fraction`` of each coast's months."""
    years = quality.every_n_years(observed, fv.TRAIN_EVERY_N_YEARS)
    if coast is not None:
        years = years.where(F.col("coast_name") == coast)
    strata = [F.col("coast_name"), F.date_format("datetime", "yyyyMM")]
    return sampling.stratified_sample(years, strata, fraction, list(ids), fv.TRAIN_SEED)


def train(spark: SparkSession, base: str, model_path: str, fraction: float = 1.0, coast: str | None = None,
          force: bool = False, **options) -> seastate.TrainingResult:
    """Train on every third year and save the model if both gates are passed, or by ``force``.

    ``coast`` limits training to one coast. Year and coast are folder columns, so
    other folders are not read. ``fraction`` bounds the labelled rows for fitting.
    """
    kept = training_source(silver(spark, base), coast, fraction)
    frame = cut_lineage(spread(seastate.training_frame(kept, extra=["id"])))
    result = train_rows(frame, ["id"], enforce_gates=not force, **options)
    if result.accepted or force:
        seastate.save_model(result.model, model_path)
    return result


def payload(spark: SparkSession, base: str, out: str, wind_mode: str = "max") -> None:
    """Gold tables to one JSON document per coast, and one for the design levels."""
    days = read_daily(spark, base)
    shares = tables.read_or_empty(spark, schemas.GOLD_MONTHLY.path(base), schemas.GOLD_MONTHLY.schema)
    levels = tables.read_or_empty(spark, schemas.GOLD_FORECAST.path(base), schemas.GOLD_FORECAST.schema)
    tables.write_payload(payload_ops.coast_payload(days, shares, wind_mode), f"{out}/coasts")
    design = forecast_ops.pack_forecast(forecast_ops.clean_forecast(levels))
    tables.write_payload(design.select(F.to_json(F.struct(*design.columns), {"ignoreNullFields": "false"}).alias("json")), f"{out}/design")


def explore(observed: DataFrame, *, month: str, wind: str, wind_dir: str, height: str, wave_dir: str, period: str,
            ids: Sequence[str], fraction: float = 0.05) -> dict[str, DataFrame]:
    """The descriptive tables of one observation file."""
    return {
        "summary": describe.describe(observed, [wind, wind_dir, height, wave_dir, period]),
        "height_histogram": describe.fd_histogram(observed, height),
        "wind_by_month": describe.month_mean_std(observed, month, wind),
        "correlation": describe.corr_matrix(observed, [wind, height]),
        "scatter_sample": sampling.sample(quality.drop_nulls(observed, [height, period]), fraction, ids),
        "wind_rose": describe.direction_rose(observed, wind_dir, wind, fv.WIND_EDGES),
        "wave_rose": describe.direction_rose(observed, wave_dir, height, fv.WAVE_EDGES),
    }
