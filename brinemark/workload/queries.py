"""One Spark query per operator, over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from brinemark import fixed_values as fv
from brinemark.functions import text, waves
from brinemark.operators import climate, daily, describe, extremes, forecast, metrics, parse, payload, quality
from brinemark.operators import quantiles, sampling, seastate, share
from brinemark.plans import jobs
from brinemark.session import cut_lineage, spread, work_folder
from brinemark.sources import schemas, tables
from brinemark.streaming import runs
from brinemark.workload.mapping import observed, raw_lines, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, dp: int, *skip: str) -> DataFrame:
    """Doubles at ``dp`` decimals: sums differ in the last bits between engines."""
    return df.select(*[
        F.round(f.name, dp).alias(f.name) if f.dataType.simpleString() == "double" and f.name not in skip else F.col(f.name)
        for f in df.schema
    ])


EVENT_ATTRIBUTES = {"event_id": "event_id", "user_id": "user_id"}


def events_daily(spark, sf) -> DataFrame:
    return daily.daily_summary(table(spark, sf, "events"), "ts", "event_type", "value", EVENT_ATTRIBUTES, None)


def observed_daily(spark, sf) -> DataFrame:
    return daily.daily_summary(observed(spark, sf))


def observed_days(spark, sf, wind_mode="max") -> DataFrame:
    return climate.daily_measures(observed_daily(spark, sf), wind_mode)


# --- daily ---------------------------------------------------------------------


@query
def daily_summary(spark, sf):
    return rounded(events_daily(spark, sf), 9)


@query
def daily_summary_observed(spark, sf):
    return observed_daily(spark, sf)


@query
def unsummarised_days(spark, sf):
    done = events_daily(spark, sf).where(F.dayofmonth("date") % 2 == 0)
    return daily.unsummarised(table(spark, sf, "events"), done, "ts", "event_type").select(
        "event_id", "event_type", "ts", "value")


@query
def daily_incremental(spark, sf):
    done = observed_daily(spark, sf).where(F.dayofmonth("date") % 2 == 0)
    return daily.new_daily_rows(observed(spark, sf), done)


# --- parsing and quality -------------------------------------------------------


@query
def parse_quality(spark, sf):
    good, _ = quality.split_quality(parse.parse_lines(raw_lines(spark, sf)))
    return good.select(
        "coast_name", F.col("datetime").cast("timestamp_ntz").alias("datetime"), "year",
        "wind_speed_ms", "wind_direction_deg", "wind_cos_direction", "wind_sin_direction",
        "wave_height_m", "wave_direction_deg", "wave_cos_direction", "wave_sin_direction",
        "wave_period_s", "wave_energy", "wave_power_kW_m")


@query
def parse_strict_rules(spark, sf):
    parsed = parse.parse_lines(raw_lines(spark, sf), dp=2, steepness=True)
    good, _ = quality.split_quality(parsed, quality.STRICT_RULES)
    return good.groupBy("coast_name", "year").agg(
        F.count(F.lit(1)).alias("n"), F.max("wave_height_m").alias("max_h"), F.max("wave_steepness").alias("max_steep"))


@query
def quarantine_reasons(spark, sf):
    lines = raw_lines(spark, sf).withColumn("ingestion_timestamp", F.current_timestamp())
    _, bad = quality.split_quality(parse.parse_lines(lines))
    return quality.quarantine_rows(bad).select("data", "source_file", "error_reason", "resolved")


@query
def rule_flags(spark, sf):
    parsed = parse.parse_lines(raw_lines(spark, sf)).where("well_formed")
    judged = quality.apply_rules(parsed)
    flags = [f"ok_{r.name}" for r in quality.RULES] + ["ok"]
    return judged.groupBy("coast_name").agg(*[F.count_if(F.col(c)).alias(c) for c in flags])


@query
def every_n_years(spark, sf):
    kept = quality.every_n_years(observed(spark, sf), fv.TRAIN_EVERY_N_YEARS)
    return kept.groupBy("coast_name", "year").agg(F.count(F.lit(1)).alias("n"))


@query
def month_names(spark, sf):
    spelled = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "MMMM").alias("name"), F.date_format("o_orderdate", "MM").alias("digits"))
    return spelled.groupBy(
        text.norm_month(F.upper("name")).alias("by_name"), text.norm_month(F.col("digits")).alias("by_digits"),
    ).agg(F.count(F.lit(1)).alias("n"))


# --- shares and climatology ----------------------------------------------------

STATUS_DOMAIN = ["O", "F", "X"]


def order_share(spark, sf, domain=STATUS_DOMAIN) -> DataFrame:
    orders = table(spark, sf, "orders")
    return share.class_share(
        orders, [F.year("o_orderdate").alias("year"), F.date_format("o_orderdate", "MM").alias("month")],
        "o_orderpriority", "o_orderstatus", domain)


@query
def class_share(spark, sf):
    return order_share(spark, sf)


@query
def coast_kpis(spark, sf):
    return rounded(climate.coast_kpis(observed_days(spark, sf)), 6)


@query
def coast_kpis_wind_mid(spark, sf):
    return rounded(climate.coast_kpis(observed_days(spark, sf, "mid")), 6)


@query
def month_climatology(spark, sf):
    return rounded(climate.month_climatology(observed_days(spark, sf)), 7)


@query
def annual_maxima(spark, sf):
    return climate.annual_maxima(observed_days(spark, sf))


@query
def monthly_by_year(spark, sf):
    return rounded(climate.monthly_by_year(observed_days(spark, sf)), 9)


@query
def recombine_by_month(spark, sf):
    return rounded(climate.recombine(climate.monthly_by_year(observed_days(spark, sf)), 1996, 1999), 7)


@query
def recombine_kpis(spark, sf):
    return rounded(climate.recombine(climate.monthly_by_year(observed_days(spark, sf)), 1999, 1996, by=None), 7)


@query
def label_top_n(spark, sf):
    return climate.label_top_n(climate.annual_maxima(observed_days(spark, sf)))


@query
def seastate_climatology(spark, sf):
    return rounded(climate.seastate_climatology(
        order_share(spark, sf), "o_orderpriority", "month", "o_orderstatus"), 6)


@query
def seastate_matrix(spark, sf):
    months = climate.seastate_climatology(order_share(spark, sf), "o_orderpriority", "month", "o_orderstatus")
    return climate.seastate_matrix(months, STATUS_DOMAIN, "o_orderpriority", "month", "o_orderstatus")


# --- quantiles -----------------------------------------------------------------

QS = [0.05, 0.10, 0.15, 0.5, 0.95]


@query
def group_quantile(spark, sf):
    return rounded(quantiles.group_quantile(table(spark, sf, "events"), "event_type", "value", QS), 9)


@query
def group_quantile_bracket(spark, sf):
    return rounded(quantiles.group_quantile(table(spark, sf, "events"), "event_type", "value", QS), 9)


@query
def table_quantile_bracket(spark, sf):
    return rounded(quantiles.exact_quantiles(
        table(spark, sf, "lineitem"), [], "l_extendedprice", {"q05": 0.05, "q95": 0.95}), 9)


@query
def group_median(spark, sf):
    return rounded(quantiles.group_median(
        table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice"), 9)


# --- extremes ------------------------------------------------------------------


@query
def extreme_profile(spark, sf):
    events = table(spark, sf, "events")
    thresholds = extremes.series_thresholds(events, "event_type", "ts", "value")
    return extremes.extreme_profile(events, thresholds, "event_type", "value", ["event_id", "user_id"])


def event_peaks(spark, sf):
    return extremes.storm_peaks(table(spark, sf, "events"), "event_type", "ts", "value", gap_hours=1)


def event_excesses(spark, sf):
    thresholds, peaks = event_peaks(spark, sf)
    return thresholds, cut_lineage(extremes.ranked_excesses(peaks, thresholds, "event_type"))


def _clock(column):
    return F.timestamp_micros(F.col(column)).cast("timestamp_ntz")


@query
def decluster_peaks(spark, sf):
    _, peaks = event_peaks(spark, sf)
    return peaks.select(
        "event_type", _clock("storm_start_us").alias("storm_start"), _clock("storm_end_us").alias("storm_end"),
        "n_over", _clock("peak_us").alias("peak_at"), "peak")


@query
def storm_peaks_observed(spark, sf):
    _, peaks = extremes.storm_peaks(observed(spark, sf), "coast_name", "datetime", "wave_power_kW_m")
    return peaks.select(
        "coast_name", _clock("storm_start_us").alias("storm_start"), _clock("storm_end_us").alias("storm_end"),
        "n_over", _clock("peak_us").alias("peak_at"), "peak")


@query
def gpd_fit_pwm(spark, sf):
    thresholds, peaks = event_peaks(spark, sf)
    excesses = extremes.ranked_excesses(peaks, thresholds, "event_type")
    return rounded(extremes.gpd_fit(excesses, ["event_type"]), 6)


@query
def gpd_fit_mle(spark, sf):
    thresholds, peaks = event_peaks(spark, sf)
    excesses = extremes.ranked_excesses(peaks, thresholds, "event_type")
    return rounded(extremes.gpd_fit(excesses, ["event_type"], "mle"), 6)


@query
def gpd_return_levels(spark, sf):
    thresholds, peaks = event_peaks(spark, sf)
    excesses = extremes.ranked_excesses(peaks, thresholds, "event_type")
    return rounded(extremes.return_level(extremes.gpd_fit(excesses, ["event_type"]), thresholds, "event_type"), 6)


@query
def return_level_ci(spark, sf):
    thresholds, excesses = event_excesses(spark, sf)
    return rounded(extremes.return_level_ci(excesses, thresholds, "event_type").drop("resamples"), 6)


@query
def band_periods(spark, sf):
    series = observed(spark, sf)
    thresholds = extremes.series_thresholds(series, "coast_name", "datetime", "wave_power_kW_m")
    profile = extremes.extreme_profile(series, thresholds, "coast_name", "wave_power_kW_m", ["wave_period_s"])
    return rounded(extremes.band_periods(profile, "wave_power_kW_m", "wave_period_s"), 6)


@query
def gpd_mle_scores(spark, sf):
    """Derivatives of the mean log-likelihood at the fitted tails: zero at a maximum."""
    thresholds, excesses = event_excesses(spark, sf)
    fit = extremes.gpd_fit(excesses, ["event_type"], "mle").where(extremes.usable())
    rows = excesses.join(fit, "event_type")
    z = F.col("excess") / F.col("scale")
    part = z / (1 + F.col("shape") * z)
    by_scale = F.avg((1 + F.col("shape")) * part) - 1
    by_shape = F.avg(F.log1p(F.col("shape") * z) / F.col("shape") ** 2 - (1 + 1 / F.col("shape")) * part)
    return rounded(rows.groupBy("event_type").agg(by_scale.alias("by_scale"), by_shape.alias("by_shape")).select(
        "event_type", F.abs("by_scale").alias("by_scale"), F.abs("by_shape").alias("by_shape")), 3)


@query
def forecast_failures(spark, sf):
    """Event types without a level when 88 storms are asked for, and why."""
    thresholds, excesses = event_excesses(spark, sf)
    fit = extremes.gpd_fit(excesses, ["event_type"], min_peaks=88)
    return extremes.fit_failures(fit, thresholds, "event_type", min_peaks=88)


@query
def hourly_tails_mle(spark, sf):
    """Tails of each event type by hour of the day, some of which have no maximum."""
    thresholds, peaks = event_peaks(spark, sf)
    hour = F.hour(F.timestamp_micros("peak_us")).cast("long").alias("hour")
    excesses = peaks.join(thresholds, "event_type").select("event_type", hour, (F.col("peak") - F.col("threshold")).alias("excess"))
    fit = extremes.gpd_fit(excesses, ["event_type", "hour"], "mle", min_peaks=4)
    return rounded(fit.withColumn("fitted", extremes.usable()), 5)


@query
def forecast_mle(spark, sf):
    """The forecast by maximum likelihood, as the job makes it."""
    rows, _ = jobs.forecast_rows(observed(spark, sf))
    return rounded(rows, 5)


@query
def forecast_tidy(spark, sf):
    rows, _ = jobs.forecast_rows(observed(spark, sf), method="pwm")
    return rounded(rows, 5)


# --- forecast table ------------------------------------------------------------


def year_levels(spark, sf) -> DataFrame:
    """Annual maxima in the shape of forecast rows: the year is the period."""
    annual = climate.annual_maxima(observed_days(spark, sf))
    height = F.struct(F.lit("Height").alias("metric"), F.col("max_hs").alias("mean"))
    wind = F.struct(F.lit(" Wind ").alias("metric"), F.col("max_wind").alias("mean"))
    rows = annual.select("coast_name", F.concat(F.lit("y"), "year").alias("period"), F.inline(F.array(height, wind)))
    return rows.select("*", (F.col("mean") * 0.5).alias("lower"), (F.col("mean") * 2).alias("upper"))


@query
def clean_forecast(spark, sf):
    return forecast.clean_forecast(year_levels(spark, sf), dp=9)


@query
def coast_rank(spark, sf):
    return forecast.coast_rank(forecast.clean_forecast(year_levels(spark, sf), dp=9))


@query
def select_forecast(spark, sf):
    clean = forecast.clean_forecast(year_levels(spark, sf), dp=9)
    return forecast.order_forecast(forecast.select_forecast(clean, "Height", "y1997"))


@query
def pack_forecast(spark, sf):
    packed = forecast.pack_forecast(forecast.clean_forecast(year_levels(spark, sf)))
    return packed.select(F.to_json(F.struct("metrics", "periods", "series"), {"ignoreNullFields": "false"}).alias("json"))


@query
def pack_points(spark, sf):
    """Coasts and sums of the packed points; one coast has no heights, so that a pair may be empty."""
    rows = forecast.clean_forecast(year_levels(spark, sf), dp=9).where("not (metric = 'Height' and period = 'y1997')")
    points = forecast.pack_points(rows)
    return points.select(
        "period", "metric", F.array_join(F.transform("points", lambda p: p["coast"]), ",").alias("coasts"),
        F.round(F.aggregate("points", F.lit(0.0), lambda s, p: s + p["mean"]), 2).alias("total"))


# --- descriptive ---------------------------------------------------------------

PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query
def describe_table(spark, sf):
    return rounded(describe.describe(table(spark, sf, "lineitem"), PROFILED), 6)


@query
def describe_by(spark, sf):
    return rounded(describe.describe(table(spark, sf, "lineitem"), PROFILED, by="l_returnflag"), 6)


@query
def corr_matrix(spark, sf):
    return rounded(describe.corr_matrix(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]), 9)


@query
def fd_histogram(spark, sf):
    return rounded(describe.fd_histogram(table(spark, sf, "events"), "value"), 6)


@query
def gumbel_histogram(spark, sf):
    return rounded(describe.gumbel_histogram(table(spark, sf, "events"), "value"), 5)


@query
def month_mean_std(spark, sf):
    items = table(spark, sf, "lineitem").withColumn("month", F.month("l_shipdate"))
    return rounded(describe.month_mean_std(items, "month", "l_extendedprice"), 5)


@query
def preview(spark, sf):
    return describe.preview(table(spark, sf, "events"), ["ts", "event_id"]).select("event_id", "ts", "event_type", "value")


@query
def wind_rose(spark, sf):
    return rounded(describe.direction_rose(observed(spark, sf), "wind_direction_deg", "wind_speed_ms", fv.WIND_EDGES), 8)


@query
def wave_rose(spark, sf):
    return rounded(describe.direction_rose(observed(spark, sf), "wave_direction_deg", "wave_height_m", fv.WAVE_EDGES), 8)


@query
def power_bands(spark, sf):
    return describe.band_counts(observed(spark, sf), "wave_power_kW_m", fv.POWER_EDGES, fv.POWER_LABELS)


@query
def contingency(spark, sf):
    orders = table(spark, sf, "orders").withColumn("month", F.month("o_orderdate"))
    return describe.contingency(orders, "month", "o_orderstatus", STATUS_DOMAIN)


@query
def contingency_shares(spark, sf):
    orders = table(spark, sf, "orders")
    return rounded(describe.contingency(orders, "o_orderpriority", "o_orderstatus", STATUS_DOMAIN, normalize=True), 9)


@query
def gumbel_moments(spark, sf):
    return rounded(describe.gumbel_moments(table(spark, sf, "events"), "event_type", "value"), 6)


@query
def exceedance_curve(spark, sf):
    return rounded(describe.exceedance_curve(table(spark, sf, "events"), "event_type", "value"), 9, "value")


# --- samples -------------------------------------------------------------------


@query
def random_sample(spark, sf):
    return sampling.sample(table(spark, sf, "events"), 0.05, ["event_id"]).select("event_id", "event_type", "value")


@query
def stratified_sample(spark, sf):
    events = table(spark, sf, "events")
    strata = [F.col("event_type"), F.date_format("ts", "yyyyMM")]
    return sampling.stratified_sample(events, strata, 0.3, ["event_id"]).select("event_id", "event_type")


@query
def train_test_split(spark, sf):
    train, test = sampling.split(table(spark, sf, "events"), fv.TEST_SHARE, ["event_id"])
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("event_type", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))


# --- classification quality ----------------------------------------------------


@query
def confusion(spark, sf):
    return metrics.confusion(table(spark, sf, "labels"), "quality", "toxic", [0, 1])


@query
def class_report(spark, sf):
    return rounded(metrics.class_report(table(spark, sf, "labels"), "quality", "toxic"), 9)


@query
def class_distribution(spark, sf):
    return rounded(metrics.class_distribution(table(spark, sf, "labels"), "quality", "toxic"), 9)


@query
def classification_metrics(spark, sf):
    figures = metrics.classification_metrics(table(spark, sf, "labels"), "quality", "toxic")
    return rounded(metrics.forest_gate(figures), 9)


# --- classifier ----------------------------------------------------------------


@query
def extreme_mask(spark, sf):
    frame = seastate.training_frame(observed(spark, sf))
    bounds = seastate.extreme_thresholds(frame)
    return frame.withColumn("both", seastate.extreme_mask(bounds)).withColumn(
        "any", seastate.extreme_mask(bounds, "or")).groupBy("coast_name").agg(
        F.count_if("both").alias("both"), F.count_if("any").alias("any"))


ROW_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def trained(spark, sf) -> seastate.TrainingResult:
    """Mixture and forest at the job's own settings; gates reported but not enforced."""
    frame = cut_lineage(spread(seastate.training_frame(observed(spark, sf), extra=ROW_ID)))
    return jobs.train_rows(frame, ROW_ID, enforce_gates=False)


@query
def train_forest_metrics(spark, sf):
    return trained(spark, sf).metrics


@query
def sea_state_names(spark, sf):
    """Names of labels, known and unknown."""
    label = F.when(F.col("l_linenumber") > 1, F.col("l_linenumber") + F.when(F.col("l_returnflag") == "R", 3).otherwise(0))
    named = table(spark, sf, "lineitem").select(label.alias("label"), text.sea_state_name(label).alias("sea_state"))
    return named.groupBy("label", "sea_state").agg(F.count(F.lit(1)).alias("n"))


@query
def cluster_order(spark, sf):
    """Clusters (here suppliers modulo 6) ranked by mean energy, then power."""
    rows = observed(spark, sf).withColumn("cluster", (F.col("l_suppkey") % 6).cast("int"))
    ranked = seastate.order_clusters(rows.where("coast_name IS NOT NULL"))
    return rounded(ranked.select("cluster", "label", "mean_wave_energy"), 3)


@query
def feature_scaler(spark, sf):
    """Mean and deviation of the features over calm rows."""
    frame = seastate.training_frame(observed(spark, sf))
    extreme = seastate.extreme_mask(seastate.extreme_thresholds(frame))
    calm = frame.where(~extreme)
    return rounded(seastate.scaler_table(spark, seastate.fit_scaler(calm)), 4)


@query
def labelled_rows(spark, sf):
    """Extreme and calm rows in one frame: the last label is that of the extreme ones, the others are ordered clusters."""
    frame = cut_lineage(spread(seastate.training_frame(observed(spark, sf), extra=ROW_ID)))
    extreme = seastate.extreme_mask(seastate.extreme_thresholds(frame))
    mixture = seastate.fit_mixture(frame.where(~extreme))
    order = {r["cluster"]: r["label"] for r in seastate.order_clusters(seastate.apply_mixture(mixture, frame.where(~extreme))).collect()}
    labelled = seastate.label_rows(frame, mixture, order, extreme)
    return labelled.groupBy("coast_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 7).alias("extreme"),
        F.count_if(F.col("label").between(1, 6)).alias("calm"), F.count_if(F.col("label").isNull()).alias("unlabelled"))


@query
def training_coast(spark, sf):
    """Rows that training on one coast takes, by year."""
    rows = jobs.training_source(observed(spark, sf), coast=fv.COASTS["tuxpan"], ids=ROW_ID)
    return rows.groupBy("coast_name", "year").agg(F.count(F.lit(1)).alias("n"))


@query
def drop_nulls(spark, sf):
    """Lines with both of two columns that have gaps."""
    rows = table(spark, sf, "lineitem").select(
        "l_returnflag", F.nullif("l_linenumber", F.lit(3)).alias("a"), F.nullif(F.col("l_suppkey") % 7, F.lit(0)).alias("b"), F.lit(None).cast("int").alias("c"))
    return quality.drop_nulls(rows, ["a", "b"]).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("a").alias("total"))


@query
def percent_scale(spark, sf):
    """Fractions of one group become percentages, values of the others stay."""
    value = F.when(F.col("l_returnflag") == "A", F.col("l_discount")).otherwise(F.col("l_quantity")).cast("double")
    rows = table(spark, sf, "lineitem").select("l_returnflag", value.alias("value"))
    return climate.to_percent_scale(rows, "value", "l_returnflag").groupBy("l_returnflag", "value").agg(F.count(F.lit(1)).alias("n"))


@query
def gmm_gate(spark, sf):
    """Fitted on calm training rows, gated on calm rows that were held out."""
    frame = cut_lineage(spread(seastate.training_frame(observed(spark, sf), extra=ROW_ID)))
    train, test = sampling.split(frame, fv.TEST_SHARE, ROW_ID, fv.TRAIN_SEED)
    extreme = seastate.extreme_mask(seastate.extreme_thresholds(train))
    mixture = seastate.fit_mixture(train.where(~extreme))
    return seastate.gmm_gate(seastate.apply_mixture(mixture, test.where(~extreme)))


# --- streams and documents -----------------------------------------------------


def landed(spark, sf, base=None, version=1, late=None, ordered=False) -> str:
    """Raw lines written as landing text, one file per file name."""
    base = base or work_folder(spark, "stream")
    lines = raw_lines(spark, sf, version, late).select(
        F.substring_index("source_file", "/", -1).alias("file"), F.col("data").alias("value"))
    lines = lines.repartition("file")
    lines = lines.sortWithinPartitions("file", "value") if ordered else lines
    lines.write.partitionBy("file").text(f"{base}/written{version}")
    # The file name tells the coast, and a writer cannot choose it.
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(f"{base}/landing"))
    for folder in files.listStatus(path(f"{base}/written{version}")):
        name = folder.getPath().getName()
        if name.startswith("file="):
            for part in files.listStatus(folder.getPath()):
                files.rename(part.getPath(), path(f"{base}/landing/{name[5:]}"))
    return base


def streamed(spark, sf) -> str:
    base = landed(spark, sf)
    jobs.ingest(spark, f"{base}/landing", base)
    jobs.refine(spark, base)
    return base


@query
def stream_identities(spark, sf):
    """Observations, their distinct ids, and rows whose audit columns are missing or out of order."""
    base = streamed(spark, sf)
    lines = tables.read_table(spark, schemas.BRONZE_LINES.path(base), schemas.BRONZE_LINES.schema)
    late = F.col("transformation_timestamp").isNull() | (
        F.col("transformation_timestamp") < F.lit(lines.agg(F.max("ingestion_timestamp")).first()[0]))
    named = lines.where("source_file is null or ingestion_timestamp is null").count()
    return jobs.silver(spark, base).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"),
        (F.count_if(late) + F.lit(named)).alias("out_of_order"))


@query
def stream_refine(spark, sf):
    base = streamed(spark, sf)
    return jobs.silver(spark, base).select(
        "coast_name", F.col("datetime").cast("timestamp_ntz").alias("datetime"), "year",
        "wind_speed_ms", "wave_height_m", "wave_period_s", "wave_power_kW_m")


@query
def stream_quarantine(spark, sf):
    base = streamed(spark, sf)
    kept = tables.read_table(spark, schemas.QUARANTINE.path(base), schemas.QUARANTINE.schema)
    return kept.groupBy("error_reason", "resolved").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_daily(spark, sf):
    base = streamed(spark, sf)
    jobs.daily(spark, base)
    jobs.daily(spark, base)  # nothing new: the second run must add nothing
    return jobs.read_daily(spark, base).drop("year")


def daily_with_late_rows(spark, sf, late: str) -> DataFrame:
    """A first landing summarised, then the late lines landed and summarised by ``late``."""
    base = None
    for version, is_late in ((1, False), (2, True)):
        base = landed(spark, sf, base, version, is_late)
        jobs.ingest(spark, f"{base}/landing", base)
        jobs.refine(spark, base)
        jobs.daily(spark, base, late)
    return jobs.read_daily(spark, base).drop("year")


@query
def stream_daily_late_skip(spark, sf):
    """Late rows give new days only; summarised days stay as they were."""
    return daily_with_late_rows(spark, sf, "skip")


@query
def stream_daily_recompute(spark, sf):
    """Late rows rebuild the days that they touch, as if all had come at once."""
    return daily_with_late_rows(spark, sf, "recompute")


@query
def stream_daily_windows(spark, sf):
    """Days closed by event time: all but those within two days of the newest observation."""
    base = streamed(spark, sf)
    runs.stream_daily(spark, base)
    path = schemas.GOLD_DAILY_STREAM.path(base)
    return tables.read_table(spark, path, schemas.GOLD_DAILY_STREAM.schema).drop("year")


@query
def ingest_once(spark, sf):
    """Lines by file after every file has been delivered again as another version."""
    base = None
    for version in (1, 2):
        base = landed(spark, sf, base, version, ordered=True)
        jobs.ingest(spark, f"{base}/landing", base, once="7 days")
    lines = tables.read_table(spark, schemas.BRONZE_LINES.path(base), schemas.BRONZE_LINES.schema)
    name = F.substring_index("source_file", "/", -1).alias("file")
    return lines.groupBy(name).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("line_id").alias("ids"))


@query
def declared_tables(spark, sf):
    """Observations read through their declared table, by name."""
    base, database = landed(spark, sf), "declared_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {database}")
    schemas.create_tables(spark, base, database)
    jobs.ingest(spark, f"{base}/landing", base)
    jobs.refine(spark, base)
    schemas.recover_partitions(spark, schemas.SILVER_METRICS, database)
    name = f"{database}.{schemas.SILVER_METRICS.layer}_{schemas.SILVER_METRICS.name}"
    return spark.table(name).groupBy("coast_name", "year").agg(F.count(F.lit(1)).alias("n"), F.max("wave_height_m").alias("highest"))


@query
def monthly_share_job(spark, sf):
    """Classes written as a table and shared out by the job, twice: the second run replaces the first."""
    base = work_folder(spark, "classes")
    classes = classified_by_power(spark, sf).select(
        F.concat_ws("-", *ROW_ID).alias("id"), "coast_name", F.col("datetime").cast("timestamp").alias("datetime"), "year",
        "wave_classification", F.current_timestamp().alias("classification_timestamp"))
    tables.append_table(classes, schemas.SILVER_CLASSES.path(base), schemas.SILVER_CLASSES.partition_by)
    for _ in range(2):
        jobs.monthly_share(spark, base)
    return tables.read_table(spark, schemas.GOLD_MONTHLY.path(base), schemas.GOLD_MONTHLY.schema)


@query
def payload_files(spark, sf):
    """Figures out of documents that were written as files."""
    path = work_folder(spark, "payload")
    shares = share.sea_state_share(classified_by_power(spark, sf))
    tables.write_payload(payload.coast_payload(observed_daily(spark, sf), shares), path)
    return document_figures(spark.read.text(path).select(F.get_json_object("value", "$.name").alias("id"), F.col("value").alias("json")))


@query
def explore_tables(spark, sf):
    """Wind by month and the correlation out of the exploring job."""
    rows = observed(spark, sf).withColumn("month", F.month("datetime"))
    found = jobs.explore(
        rows, month="month", wind="wind_speed_ms", wind_dir="wind_direction_deg", height="wave_height_m",
        wave_dir="wave_direction_deg", period="wave_period_s", ids=ROW_ID)
    wind = found["wind_by_month"].select(F.concat(F.lit("wind "), "month").alias("item"), "mean", "std")
    kept = found["scatter_sample"].agg(F.lit("sample").alias("item"), F.avg(F.lit(0.0)).alias("mean"), F.lit(0.0).alias("std"))
    return rounded(wind.unionByName(kept), 4)


@query
def stream_classify(spark, sf):
    """Refine, train, classify and share out, all through the job entry points."""
    base = streamed(spark, sf)
    model_path = f"{base}/model"
    jobs.train(spark, base, model_path, force=True)
    runs.classify(spark, base, seastate.load_model(model_path))
    jobs.monthly_share(spark, base)
    return tables.read_table(spark, schemas.GOLD_MONTHLY.path(base), schemas.GOLD_MONTHLY.schema)


@query
def observations_file(spark, sf):
    """Cleaned observations written as CSV, read back with their timestamp."""
    path = work_folder(spark, "observations")
    series = observed(spark, sf)
    series.select(
        F.year("datetime").cast("double").alias("Anio"), F.month("datetime").cast("double").alias("Mes"),
        F.dayofmonth("datetime").cast("double").alias("Dia"), F.hour("datetime").cast("double").alias("Hora"),
        F.col("wind_speed_ms").cast("double").alias("VelocidadViento"),
        F.col("wind_direction_deg").cast("double").alias("DireccionViento"),
        F.col("wave_height_m").cast("double").alias("AlturaDelOleaje"),
        F.col("wave_direction_deg").cast("double").alias("DireccionOleaje"),
        F.col("wave_period_s").cast("double").alias("PeriodoDeLaOla"),
    ).write.option("header", "true").csv(path)
    back = tables.read_observations(spark, path)
    return back.groupBy("Anio", "Mes").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("Fecha_Hora").cast("timestamp_ntz")).alias("last"),
        F.max("AlturaDelOleaje").cast("float").alias("max_h"))


def classified_by_power(spark, sf) -> DataFrame:
    """Observed rows with a sea state by power band, for shares without a model."""
    states = fv.SEA_STATES
    return observed(spark, sf).withColumn(
        "wave_classification",
        waves.band(F.col("wave_power_kW_m").cast("double"), fv.POWER_EDGES, states[:5]))


@query
def sea_state_share(spark, sf):
    return share.sea_state_share(classified_by_power(spark, sf))


@query
def coast_payload(spark, sf):
    shares = share.sea_state_share(classified_by_power(spark, sf))
    return payload.coast_payload(observed_daily(spark, sf), shares)


@query
def coast_payload_kpis(spark, sf):
    """Figures read back out of the documents."""
    shares = share.sea_state_share(classified_by_power(spark, sf))
    return document_figures(payload.coast_payload(observed_daily(spark, sf), shares))


def document_figures(docs: DataFrame) -> DataFrame:
    return docs.select(
        "id",
        F.get_json_object("json", "$.year_min").cast("int").alias("year_min"),
        F.get_json_object("json", "$.year_max").cast("int").alias("year_max"),
        F.get_json_object("json", "$.n_records").cast("bigint").alias("n_records"),
        F.get_json_object("json", "$.kpi_max").cast("double").alias("kpi_max"),
        F.get_json_object("json", "$.annual.max_hs[0]").cast("double").alias("first_max"),
        F.get_json_object("json", "$.annual.years[0]").cast("int").alias("first_year"),
        F.get_json_object("json", "$.monthly_by_year.1996.n[2]").cast("bigint").alias("n_1996_03"),
    )
