"""Independent SQL for the registered queries (DuckDB dialect).

Written from the definitions, on the source columns; nothing is shared with the
Spark code but the fixed values.
"""

from __future__ import annotations

from brinemark import fixed_values as fv

ORACLE: dict[str, str] = {}

# --- shared building blocks ----------------------------------------------------

_COAST_CASE = "CASE l_linenumber " + " ".join(
    f"WHEN {i} THEN '{name}'" for i, name in enumerate(fv.COASTS.values(), start=1)) + " END"
_STEM_CASE = "CASE l_linenumber " + " ".join(
    f"WHEN {i} THEN '{stem[0].upper() + stem[1:]}'" for i, stem in enumerate(fv.COASTS, start=1)) + " END"

SERIES = f"""
src AS (
  SELECT *, {_COAST_CASE} AS coast_name,
    l_quantity / 2 AS ws, (l_partkey % 3600) / 10.0::DOUBLE AS wd,
    floor(l_extendedprice / 10) / 1000.0::DOUBLE AS h, (l_orderkey % 3600) / 10.0::DOUBLE AS vd,
    (22 + 4 * (l_suppkey % 30)) / 10.0::DOUBLE AS t,
    date_trunc('day', l_shipdate) + to_hours(l_suppkey % 24) AS dt
  FROM lineitem
),
obs AS (
  SELECT coast_name, dt::TIMESTAMP AS datetime, year(l_shipdate)::INTEGER AS year, l_orderkey,
    round(ws, 4)::FLOAT AS wind_speed_ms, round(wd, 4)::FLOAT AS wind_direction_deg,
    round(h, 4)::FLOAT AS wave_height_m, round(vd, 4)::FLOAT AS wave_direction_deg,
    round(t, 4)::FLOAT AS wave_period_s,
    round(0.125 * (9.81::DOUBLE * 1026) * h * h, 4)::FLOAT AS wave_energy,
    round(490 * h * h * t / 1000, 4)::FLOAT AS wave_power_kW_m
  FROM src
)"""

DAILY = SERIES + """,
ord AS (
  SELECT *, datetime::DATE AS date,
    row_number() OVER (PARTITION BY coast_name, datetime::DATE ORDER BY wave_height_m DESC, datetime,
      wave_period_s, wave_direction_deg, wind_speed_ms, wind_direction_deg) AS hi,
    row_number() OVER (PARTITION BY coast_name, datetime::DATE ORDER BY wave_height_m, datetime,
      wave_period_s, wave_direction_deg, wind_speed_ms, wind_direction_deg) AS lo
  FROM obs
),
daily AS (
  SELECT date, coast_name,
    max(wave_height_m) AS max_wave_height_m,
    max(CASE WHEN hi = 1 THEN wave_period_s END) AS max_wave_period_s,
    max(CASE WHEN hi = 1 THEN wave_direction_deg END) AS max_wave_direction_deg,
    max(CASE WHEN hi = 1 THEN wind_speed_ms END) AS max_wave_wind_speed_ms,
    max(CASE WHEN hi = 1 THEN wind_direction_deg END) AS max_wave_wind_direction_deg,
    min(wave_height_m) AS min_wave_height_m,
    max(CASE WHEN lo = 1 THEN wave_period_s END) AS min_wave_period_s,
    max(CASE WHEN lo = 1 THEN wave_direction_deg END) AS min_wave_direction_deg,
    max(CASE WHEN lo = 1 THEN wind_speed_ms END) AS min_wave_wind_speed_ms,
    max(CASE WHEN lo = 1 THEN wind_direction_deg END) AS min_wave_wind_direction_deg,
    avg(wave_height_m::DOUBLE)::FLOAT AS avg_wave_height_m
  FROM ord GROUP BY date, coast_name
)"""


def _days(wind: str = "max_wave_wind_speed_ms::DOUBLE") -> str:
    return DAILY + f""",
days AS (
  SELECT coast_name, year(date)::INTEGER AS year, month(date)::INTEGER AS month,
    avg_wave_height_m::DOUBLE AS hs, max_wave_height_m::DOUBLE AS hs_max,
    max_wave_period_s::DOUBLE AS period_max, max_wave_wind_speed_ms::DOUBLE AS wind_max,
    {wind} AS wind,
    0.49::DOUBLE * avg_wave_height_m::DOUBLE * avg_wave_height_m::DOUBLE
      * (max_wave_period_s::DOUBLE + min_wave_period_s::DOUBLE) / 2 AS power
  FROM daily
)"""


DAYS = _days()
MID_DAYS = _days("(max_wave_wind_speed_ms::DOUBLE + min_wave_wind_speed_ms::DOUBLE) / 2")
MONTHLY = DAYS + """,
monthly AS (
  SELECT coast_name, year, month, avg(hs) AS mean_hs, max(hs_max) AS max_hs, avg(wind) AS mean_wind,
    avg(power) AS mean_power, count(*) AS n
  FROM days GROUP BY ALL
)"""
ANNUAL = DAYS + """,
annual AS (
  SELECT coast_name, year, max(hs_max) AS max_hs, max(period_max) AS max_period, max(wind_max) AS max_wind
  FROM days GROUP BY ALL
)"""


def _round(columns: str, dp: int) -> str:
    return ", ".join(f"round({c.strip()}, {dp}) AS {c.strip()}" for c in columns.split(","))


# --- daily ---------------------------------------------------------------------

EVENT_DAILY = """
ord AS (
  SELECT *, ts::DATE AS date,
    row_number() OVER (PARTITION BY event_type, ts::DATE ORDER BY value DESC, ts, event_id, user_id) AS hi,
    row_number() OVER (PARTITION BY event_type, ts::DATE ORDER BY value, ts, event_id, user_id) AS lo
  FROM events
),
daily AS (
  SELECT date, event_type, max(value) AS max_value,
    max(CASE WHEN hi = 1 THEN event_id END) AS max_event_id, max(CASE WHEN hi = 1 THEN user_id END) AS max_user_id,
    min(value) AS min_value,
    max(CASE WHEN lo = 1 THEN event_id END) AS min_event_id, max(CASE WHEN lo = 1 THEN user_id END) AS min_user_id,
    avg(value) AS avg_value
  FROM ord GROUP BY date, event_type
)"""

ORACLE["daily_summary"] = f"""
WITH {EVENT_DAILY}
SELECT date, event_type, round(max_value, 9) AS max_value, max_event_id, max_user_id,
  round(min_value, 9) AS min_value, min_event_id, min_user_id, round(avg_value, 9) AS avg_value FROM daily"""

ORACLE["daily_summary_observed"] = f"WITH {DAILY} SELECT * FROM daily"

ORACLE["unsummarised_days"] = """
WITH done AS (SELECT DISTINCT event_type, ts::DATE AS d FROM events WHERE day(ts) % 2 = 0)
SELECT event_id, event_type, ts, value FROM events e
WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.event_type = e.event_type AND done.d = e.ts::DATE)"""

ORACLE["daily_incremental"] = f"WITH {DAILY} SELECT * FROM daily WHERE day(date) % 2 <> 0"

# --- parsing and quality -------------------------------------------------------

_GOOD_KINDS = "l_orderkey % 50 NOT IN (0, 2, 3, 4, 5, 6, 7, 9)"

ORACLE["parse_quality"] = f"""
WITH {SERIES}
SELECT coast_name, dt::TIMESTAMP AS datetime, year(l_shipdate)::INTEGER AS year,
  round(ws, 4)::FLOAT AS wind_speed_ms, round(wd, 4)::FLOAT AS wind_direction_deg,
  (round(cos(radians(wd)), 4) + 0.0::DOUBLE)::FLOAT AS wind_cos_direction, (round(sin(radians(wd)), 4) + 0.0::DOUBLE)::FLOAT AS wind_sin_direction,
  round(h, 4)::FLOAT AS wave_height_m, round(vd, 4)::FLOAT AS wave_direction_deg,
  (round(cos(radians(vd)), 4) + 0.0::DOUBLE)::FLOAT AS wave_cos_direction, (round(sin(radians(vd)), 4) + 0.0::DOUBLE)::FLOAT AS wave_sin_direction,
  round(t, 4)::FLOAT AS wave_period_s,
  round(0.125 * (9.81::DOUBLE * 1026) * h * h, 4)::FLOAT AS wave_energy,
  round(490 * h * h * t / 1000, 4)::FLOAT AS wave_power_kW_m
FROM src WHERE {_GOOD_KINDS}"""

ORACLE["parse_strict_rules"] = f"""
WITH {SERIES}
SELECT coast_name, year(l_shipdate)::INTEGER AS year, count(*) AS n, max(round(h, 2)::FLOAT) AS max_h,
  max(round(h / (t * t), 2)::FLOAT) AS max_steep
FROM src WHERE {_GOOD_KINDS} AND ws BETWEEN 0 AND 25 AND round(h, 2)::FLOAT BETWEEN 0 AND 7 AND t BETWEEN 0 AND 15
GROUP BY ALL"""

_LINE = f"""
lines AS (
  SELECT *, l_orderkey % 50 AS kind,
    CASE WHEN l_orderkey % 50 = 5 THEN '2' ELSE month(l_shipdate)::VARCHAR END || ' ' ||
    CASE WHEN l_orderkey % 50 = 5 THEN '30' ELSE day(l_shipdate)::DOUBLE::VARCHAR END || ' ' ||
    CASE WHEN l_orderkey % 50 = 9 THEN '24' ELSE (l_suppkey % 24)::VARCHAR END AS head,
    CASE WHEN l_orderkey % 50 = 2 THEN 'x' ELSE ws::VARCHAR END || ' ' ||
    CASE WHEN l_orderkey % 50 = 3 THEN '400.5' ELSE wd::VARCHAR END || ' ' ||
    CASE WHEN l_orderkey % 50 = 4 THEN 'NaN' ELSE h::VARCHAR END || ' ' ||
    CASE WHEN l_orderkey % 50 = 7 THEN '-1' ELSE vd::VARCHAR END || ' ' ||
    CASE WHEN l_orderkey % 50 = 7 THEN '99' ELSE t::VARCHAR END || ' 0 0 0' ||
    CASE WHEN l_linenumber % 2 = 0 THEN ' 0' ELSE '' END || ' ' || year(l_shipdate)::VARCHAR AS tail,
    '/landing/swell/' || CASE WHEN l_orderkey % 50 = 6 THEN 'acapulco' ELSE {_STEM_CASE} END || '.v1.txt' AS source_file,
    CASE l_orderkey % 50
      WHEN 0 THEN '{fv.MSG_STRUCTURE}'
      WHEN 2 THEN '{fv.MSG_WIND_SPEED}'
      WHEN 3 THEN '{fv.MSG_WIND_DIR}'
      WHEN 4 THEN '{fv.MSG_HEIGHT}'
      WHEN 5 THEN '{fv.MSG_DATE}'
      WHEN 6 THEN '{fv.MSG_COAST}'
      WHEN 7 THEN '{fv.MSG_WAVE_DIR}{fv.MSG_PERIOD}'
      WHEN 9 THEN '{fv.MSG_DATE}'
      ELSE '' END AS error_reason
  FROM src
)"""

ORACLE["quarantine_reasons"] = f"""
WITH {SERIES}, {_LINE}
SELECT CASE WHEN kind = 0 THEN head ELSE head || ' ' || tail END AS data, source_file, error_reason, false AS resolved
FROM lines WHERE error_reason <> ''"""

ORACLE["rule_flags"] = f"""
WITH {SERIES}, judged AS (SELECT *, l_orderkey % 50 AS kind FROM src WHERE l_orderkey % 50 <> 0)
SELECT CASE WHEN kind = 6 THEN '' ELSE coast_name END AS coast_name,
  count(*) FILTER (kind <> 6) AS ok_coast, count(*) FILTER (kind NOT IN (5, 9)) AS ok_datetime,
  count(*) FILTER (kind <> 2) AS ok_wind_speed_ms, count(*) FILTER (kind <> 3) AS ok_wind_direction_deg,
  count(*) FILTER (kind <> 4) AS ok_wave_height_m, count(*) FILTER (kind <> 7) AS ok_wave_direction_deg,
  count(*) FILTER (kind <> 7) AS ok_wave_period_s, count(*) FILTER ({_GOOD_KINDS}) AS ok
FROM judged GROUP BY 1"""

ORACLE["every_n_years"] = f"""
WITH {SERIES}
SELECT coast_name, year, count(*) AS n FROM obs WHERE year % 3 = 0 GROUP BY ALL"""

ORACLE["month_names"] = """
SELECT month(o_orderdate)::INTEGER AS by_name, month(o_orderdate)::INTEGER AS by_digits, count(*) AS n
FROM orders GROUP BY 1, 2"""

# --- shares and climatology ----------------------------------------------------

ORDER_SHARE = """
base AS (
  SELECT year(o_orderdate)::INTEGER AS year, strftime(o_orderdate, '%m') AS month, o_orderpriority, o_orderstatus FROM orders
),
totals AS (SELECT year, month, o_orderpriority, count(*) AS total FROM base GROUP BY ALL),
per_class AS (SELECT year, month, o_orderpriority, o_orderstatus, count(*) AS n FROM base GROUP BY ALL),
domain AS (SELECT unnest(['O', 'F', 'X']) AS o_orderstatus),
shares AS (
  SELECT t.year, t.month, t.o_orderpriority, d.o_orderstatus,
    round(coalesce(p.n, 0)::DECIMAL(18, 0) * 100.0 / t.total, 2)::FLOAT AS percentage
  FROM totals t CROSS JOIN domain d
  LEFT JOIN per_class p ON p.year = t.year AND p.month = t.month AND p.o_orderpriority = t.o_orderpriority
    AND p.o_orderstatus = d.o_orderstatus
)"""

ORACLE["class_share"] = f"WITH {ORDER_SHARE} SELECT * FROM shares"

_KPIS = """
SELECT coast_name, round(avg(hs), 6) AS mean_hs, round(max(hs_max), 6) AS max_hs, round(avg(wind), 6) AS mean_wind,
  min(year) AS year_min, max(year) AS year_max, count(*) AS n_records
FROM days GROUP BY coast_name"""
ORACLE["coast_kpis"] = f"WITH {DAYS} {_KPIS}"
ORACLE["coast_kpis_wind_mid"] = f"WITH {MID_DAYS} {_KPIS}"

ORACLE["month_climatology"] = f"""
WITH {DAYS}
SELECT coast_name, month, round(avg(hs), 7) AS mean_hs, round(max(hs_max), 7) AS max_hs,
  round(avg(wind), 7) AS mean_wind, round(avg(power), 7) AS mean_power
FROM days GROUP BY coast_name, month"""

ORACLE["annual_maxima"] = f"WITH {ANNUAL} SELECT * FROM annual"

ORACLE["monthly_by_year"] = f"""
WITH {MONTHLY}
SELECT coast_name, year, month, {_round('mean_hs, max_hs, mean_wind, mean_power', 9)}, n FROM monthly"""

ORACLE["recombine_by_month"] = f"""
WITH {MONTHLY},
w AS (
  SELECT coast_name, month, sum(mean_hs * n) / sum(n) AS mean_hs, sum(mean_wind * n) / sum(n) AS mean_wind,
    sum(mean_power * n) / sum(n) AS mean_power, max(max_hs) AS max_hs
  FROM monthly WHERE year BETWEEN 1996 AND 1999 GROUP BY ALL
),
grid AS (SELECT coast_name, m::INTEGER AS month FROM (SELECT DISTINCT coast_name FROM monthly), range(1, 13) r(m))
SELECT g.coast_name, g.month, {_round('mean_hs, mean_wind, mean_power, max_hs', 7)}
FROM grid g LEFT JOIN w ON w.coast_name = g.coast_name AND w.month = g.month"""

ORACLE["recombine_kpis"] = f"""
WITH {MONTHLY}
SELECT coast_name, round(sum(mean_hs * n) / sum(n), 7) AS mean_hs, round(sum(mean_wind * n) / sum(n), 7) AS mean_wind,
  round(max(max_hs), 7) AS max_hs
FROM monthly WHERE year BETWEEN 1996 AND 1999 GROUP BY coast_name"""

ORACLE["label_top_n"] = f"""
WITH {ANNUAL},
bar AS (
  SELECT coast_name, min(max_hs) AS bar FROM (
    SELECT *, row_number() OVER (PARTITION BY coast_name ORDER BY max_hs DESC) AS r FROM annual) WHERE r <= 5
  GROUP BY coast_name
)
SELECT a.*, a.max_hs >= b.bar AS labelled FROM annual a JOIN bar b USING (coast_name)"""

_CLIM = ORDER_SHARE + """,
clim AS (
  SELECT o_orderpriority, month, o_orderstatus, avg(percentage::DOUBLE) AS pct FROM shares GROUP BY ALL
)"""
ORACLE["seastate_climatology"] = f"""
WITH {_CLIM} SELECT o_orderpriority, month, o_orderstatus, round(pct, 6) AS pct FROM clim"""

ORACLE["seastate_matrix"] = f"""
WITH {_CLIM},
scaled AS (
  SELECT *, round(CASE WHEN max(round(pct, 4)) OVER (PARTITION BY o_orderpriority) <= 1.5
    THEN round(pct, 4) * 100 ELSE round(pct, 4) END, 1) AS p FROM clim
)
SELECT o_orderpriority, list_position(['O', 'F', 'X'], o_orderstatus)::INTEGER AS position, o_orderstatus,
  {", ".join(f"max(CASE WHEN month = '{m:02d}' THEN p END) AS m{m:02d}" for m in range(1, 13))}
FROM scaled GROUP BY o_orderpriority, o_orderstatus"""

# --- quantiles -----------------------------------------------------------------

_EVENT_QUANTILES = "SELECT event_type, " + ", ".join(
    f"round(quantile_cont(value, {q}), 9) AS q{round(q * 100):02d}" for q in (0.05, 0.10, 0.15, 0.5, 0.95)
) + " FROM events GROUP BY event_type"
ORACLE["group_quantile"] = _EVENT_QUANTILES
ORACLE["group_quantile_bracket"] = _EVENT_QUANTILES

ORACLE["table_quantile_bracket"] = """
SELECT round(quantile_cont(l_extendedprice, 0.05), 9) AS q05, round(quantile_cont(l_extendedprice, 0.95), 9) AS q95
FROM lineitem"""

ORACLE["group_median"] = """
SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 9) AS median FROM lineitem GROUP BY ALL"""

# --- extremes ------------------------------------------------------------------

ORACLE["extreme_profile"] = """
WITH thr AS (SELECT event_type, quantile_cont(value, 0.95) AS q FROM events GROUP BY event_type)
SELECT event_type, event_id, user_id, value FROM events JOIN thr USING (event_type) WHERE value >= q"""


def _storms(source: str, key: str, ts: str, value: str, gap_us: int) -> str:
    return f"""
thr AS (
  SELECT {key}, quantile_cont({value}::DOUBLE, 0.95) AS threshold,
    (epoch_us(max({ts})) - epoch_us(min({ts}))) / (365.2425::DOUBLE * 86400 * 1000000) AS years
  FROM {source} GROUP BY {key}
),
over AS (
  SELECT s.{key}, s.{ts} AS ts, s.{value} AS v, threshold FROM {source} s JOIN thr USING ({key}) WHERE s.{value} > threshold
),
marked AS (
  SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY {key} ORDER BY ts)) > {gap_us}
    THEN 1 ELSE 0 END AS fresh FROM over
),
numbered AS (
  SELECT *, sum(fresh) OVER (PARTITION BY {key} ORDER BY ts RANGE UNBOUNDED PRECEDING) AS storm FROM marked
),
best AS (
  SELECT *, row_number() OVER (PARTITION BY {key}, storm ORDER BY v DESC, ts) AS r FROM numbered
),
peaks AS (
  SELECT {key}, min(ts) AS storm_start, max(ts) AS storm_end, count(*) AS n_over,
    max(CASE WHEN r = 1 THEN ts END) AS peak_at, max(v)::DOUBLE AS peak, max(threshold) AS threshold
  FROM best GROUP BY {key}, storm
)"""


EVENT_STORMS = _storms("events", "event_type", "ts", "value", 3_600_000_000)
OBSERVED_STORMS = SERIES + "," + _storms("obs", "coast_name", "datetime", "wave_power_kW_m", 72 * 3_600_000_000)

ORACLE["decluster_peaks"] = f"""
WITH {EVENT_STORMS} SELECT event_type, storm_start, storm_end, n_over, peak_at, peak FROM peaks"""
ORACLE["storm_peaks_observed"] = f"""
WITH {OBSERVED_STORMS} SELECT coast_name, storm_start, storm_end, n_over, peak_at, peak FROM peaks"""


def _fit(key: str) -> str:
    return f"""
ranked AS (
  SELECT {key}, peak - threshold AS y, row_number() OVER (PARTITION BY {key} ORDER BY peak - threshold, peak_at) AS j,
    count(*) OVER (PARTITION BY {key}) AS n FROM peaks
),
moments AS (
  SELECT {key}, max(n) AS n_peaks, avg(y) AS b0, avg((1 - (j - 0.35::DOUBLE) / n) * y) AS a1 FROM ranked GROUP BY {key}
),
fit AS (
  SELECT {key}, n_peaks,
    CASE WHEN n_peaks >= 10 THEN 2 - b0 / (b0 - 2 * a1) END AS shape,
    CASE WHEN n_peaks >= 10 THEN 2 * b0 * a1 / (b0 - 2 * a1) END AS scale
  FROM moments
),
levels AS (
  SELECT {key}, n_peaks, shape, scale, threshold, n_peaks / years AS rate, p::INTEGER AS period,
    threshold + scale * CASE WHEN abs(shape) < 1e-8 THEN ln(n_peaks / years * p)
      ELSE (pow(n_peaks / years * p, shape) - 1) / shape END AS level
  FROM fit JOIN thr USING ({key}) CROSS JOIN (SELECT unnest([50, 100]) AS p)
)"""


# The slope of the profile likelihood on a fine grid of v = log(1 + t max(y)), t = shape / scale;
# where it turns from plus to minus, 60 halvings find the root. No turn, no fit.
def _mle(key: str, least: int = 10, source: str = "peaks") -> str:
    def at(v: str) -> str:
        return f"""list_sum(list_transform(ys, lambda y: CASE WHEN y = top THEN {v} ELSE ln(1 + (exp({v}) - 1) * y / top) END)) / n AS k,
      list_sum(list_transform(ys, lambda y: CASE WHEN y = top THEN y / exp({v}) ELSE y / (1 + (exp({v}) - 1) * y / top) END)) / n AS dk"""

    slope = "top / (exp(v) - 1) - dk * (1 + 1 / k)"
    return f"""
samples AS (
  SELECT {key}, list(peak - threshold ORDER BY peak - threshold) AS ys, count(*) AS n, max(peak - threshold) AS top,
    ln(1 + max(peak - threshold) * 2 * (avg(peak - threshold) - min(peak - threshold)) / min(peak - threshold) ^ 2) AS high
  FROM {source} GROUP BY {key} HAVING count(*) >= {least}
),
grid AS (
  SELECT {key}, ys, n, top, v, {at("v")} FROM (SELECT *, unnest(range(0, 3000)) / 2999.0 * (high + 30.0013) - 30.0007 AS v FROM samples)
),
turns AS (
  SELECT *, {slope} AS g, lead({slope}) OVER (PARTITION BY {key} ORDER BY v) AS g_next,
    lead(v) OVER (PARTITION BY {key} ORDER BY v) AS v_next FROM grid
),
halved AS (
  SELECT {key}, ys, n, top, v AS low, v_next AS high, 0 AS step FROM turns WHERE k > -1 AND g > 0 AND g_next <= 0
  UNION ALL
  SELECT {key}, ys, n, top, CASE WHEN {slope} > 0 THEN v ELSE low END, CASE WHEN {slope} > 0 THEN high ELSE v END, step + 1
  FROM (SELECT *, {at("v")} FROM (SELECT *, (low + high) / 2 AS v FROM halved WHERE step < 60))
),
fits AS (
  SELECT {key}, n, k AS shape, k * top / (exp(v) - 1) AS scale, ys
  FROM (SELECT *, {at("v")} FROM (SELECT *, (low + high) / 2 AS v FROM halved WHERE step = 60))
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY ln(k * top / (exp(v) - 1)) + k) = 1
)"""


ORACLE["gpd_fit_mle"] = f"""
WITH RECURSIVE {EVENT_STORMS}, {_mle("event_type")}
SELECT p.event_type, p.n AS n_peaks, round(f.shape, 6) AS shape, round(f.scale, 6) AS scale
FROM (SELECT event_type, count(*) AS n FROM peaks GROUP BY event_type) p LEFT JOIN fits f USING (event_type)"""
ORACLE["gpd_mle_scores"] = f"""
WITH RECURSIVE {EVENT_STORMS}, {_mle("event_type")}
SELECT event_type,
  round(abs(list_avg(list_transform(ys, lambda y: (1 + shape) * y / scale / (1 + shape * y / scale))) - 1), 3) AS by_scale,
  round(abs(list_avg(list_transform(ys, lambda y: ln(1 + shape * y / scale) / shape ^ 2 - (1 + 1 / shape) * y / scale / (1 + shape * y / scale)))), 3) AS by_shape
FROM fits"""
ORACLE["forecast_failures"] = f"""
WITH {EVENT_STORMS}, {_fit("event_type")}
SELECT event_type, n_peaks, 'fewer than 88 peaks' AS error FROM fit WHERE n_peaks < 88"""
ORACLE["hourly_tails_mle"] = f"""
WITH RECURSIVE {EVENT_STORMS}, {_mle("event_type, hour", 4, "(SELECT *, hour(peak_at) AS hour FROM peaks)")}
SELECT p.event_type, p.hour, p.n AS n_peaks, round(shape, 5) AS shape, round(scale, 5) AS scale, shape IS NOT NULL AS fitted
FROM (SELECT event_type, hour(peak_at) AS hour, count(*) AS n FROM peaks GROUP BY ALL) p LEFT JOIN fits f USING (event_type, hour)"""

ORACLE["gpd_fit_pwm"] = f"""
WITH {EVENT_STORMS}, {_fit('event_type')} SELECT event_type, n_peaks, {_round('shape, scale', 6)} FROM fit"""
ORACLE["gpd_return_levels"] = f"""
WITH {EVENT_STORMS}, {_fit('event_type')}
SELECT event_type, n_peaks, {_round('shape, scale, threshold, rate', 6)}, period, round(level, 6) AS level FROM levels"""


def _interval(key: str) -> str:
    return f"""
draws AS (
  SELECT c.{key}, b, (('0x' || substr(md5('0-' || c.{key} || '-' || b || '-' || i), 1, 8))::BIGINT % n) + 1 AS j, n
  FROM (SELECT {key}, max(n) AS n FROM ranked GROUP BY {key}) c, range(1, 1001) x(b), LATERAL range(1, c.n + 1) z(i)
),
resampled AS (
  SELECT d.{key}, b, d.n, r.y, row_number() OVER (PARTITION BY d.{key}, b ORDER BY r.j) AS k
  FROM draws d JOIN ranked r ON r.{key} = d.{key} AND r.j = d.j
),
rm AS (
  SELECT {key}, b, max(n) AS n_peaks, avg(y) AS b0, avg((1 - (k - 0.35::DOUBLE) / n) * y) AS a1 FROM resampled GROUP BY {key}, b
),
rl AS (
  SELECT {key}, b, p AS period, threshold, n_peaks / years * p AS e, n_peaks,
    2 - b0 / (b0 - 2 * a1) AS shape, 2 * b0 * a1 / (b0 - 2 * a1) AS scale
  FROM rm JOIN thr USING ({key}) CROSS JOIN (SELECT unnest([50, 100]) AS p)
),
band AS (
  SELECT {key}, period::INTEGER AS period, quantile_cont(level, 0.025) AS lower, quantile_cont(level, 0.975) AS upper FROM (
    SELECT *, CASE WHEN n_peaks >= 10 THEN threshold + scale * CASE WHEN abs(shape) < 1e-8 THEN ln(e)
      ELSE (pow(e, shape) - 1) / shape END END AS level FROM rl)
  GROUP BY {key}, period
)"""


ORACLE["return_level_ci"] = f"""
WITH {EVENT_STORMS}, {_fit('event_type')}, {_interval('event_type')}
SELECT event_type, period, {_round('lower, upper', 6)} FROM band"""

_BAND = (
    "CASE WHEN {v} <= 0 THEN NULL WHEN {v} <= 50 THEN 'bajo' WHEN {v} <= 100 THEN 'medio' WHEN {v} <= 200 THEN 'alto' "
    "WHEN {v} <= 500 THEN 'muy_alto' WHEN {v} > 500 THEN 'extremo' END")

_PROFILE = f"""
profile AS (
  SELECT wave_period_s::DOUBLE AS t, {_BAND.format(v='wave_power_kW_m')} AS band
  FROM obs JOIN (SELECT coast_name, quantile_cont(wave_power_kW_m::DOUBLE, 0.95) AS q FROM obs GROUP BY coast_name) USING (coast_name)
  WHERE wave_power_kW_m >= q
),
medians AS (
  SELECT band, median(t) AS median_period FROM profile WHERE band IS NOT NULL GROUP BY band
  UNION ALL SELECT NULL, median(t) FROM profile
)"""

ORACLE["band_periods"] = f"""
WITH {SERIES}, {_PROFILE} SELECT band, round(median_period, 6) AS median_period FROM medians"""

_T = "coalesce((SELECT median_period FROM medians m WHERE m.band = {b}), (SELECT median_period FROM medians WHERE band IS NULL))"


def _height(v: str) -> str:
    return f"sqrt({v} / (0.49::DOUBLE * {_T.format(b=_BAND.format(v=v))}))"


ORACLE["forecast_tidy"] = f"""
WITH {OBSERVED_STORMS}, {_fit('coast_name')}, {_interval('coast_name')}, {_PROFILE},
power AS (
  SELECT l.coast_name, l.period, l.level AS mean, b.lower, b.upper FROM levels l
  JOIN band b ON b.coast_name = l.coast_name AND b.period = l.period WHERE l.scale > 0
),
rows AS (
  SELECT coast_name, mean, lower, upper, 'Power' AS metric, period::VARCHAR AS period FROM power
  UNION ALL
  SELECT coast_name, {_height('mean')}, {_height('lower')}, {_height('upper')}, 'Height', period::VARCHAR FROM power
)
SELECT coast_name, {_round('mean, lower, upper', 5)}, metric, period,
  round(upper - mean, 5) AS err_plus, round(mean - lower, 5) AS err_minus FROM rows"""

# --- forecast table ------------------------------------------------------------

_YEAR_ROWS = ANNUAL + """,
rows AS (
  SELECT coast_name, 'Height' AS metric, 'y' || year AS period, max_hs AS mean FROM annual
  UNION ALL SELECT coast_name, 'Wind', 'y' || year, max_wind FROM annual
),
clean AS (
  SELECT coast_name, metric, period, round(mean, 9) AS mean, round(mean * 0.5, 9) AS lower, round(mean * 2, 9) AS upper,
    round(round(mean * 2, 9) - round(mean, 9), 9) AS err_plus, round(round(mean, 9) - round(mean * 0.5, 9), 9) AS err_minus
  FROM rows
)"""
ORACLE["clean_forecast"] = f"WITH {_YEAR_ROWS} SELECT * FROM clean"
ORACLE["coast_rank"] = f"""
WITH {_YEAR_ROWS}
SELECT coast_name, metric, period, mean,
  row_number() OVER (PARTITION BY metric, period ORDER BY mean DESC, coast_name)::INTEGER AS rank,
  count(*) OVER (PARTITION BY metric, period) AS total FROM clean"""
ORACLE["pack_points"] = f"""
WITH {_YEAR_ROWS},
kept AS (SELECT * FROM clean WHERE NOT (metric = 'Height' AND period = 'y1997')),
pairs AS (SELECT * FROM (SELECT DISTINCT period FROM kept), (SELECT DISTINCT metric FROM kept))
SELECT period, metric, coalesce(string_agg(coast_name, ',' ORDER BY coast_name), '') AS coasts, round(coalesce(sum(mean), 0), 2) AS total
FROM pairs LEFT JOIN kept USING (period, metric) GROUP BY period, metric"""
ORACLE["select_forecast"] = f"WITH {_YEAR_ROWS} SELECT * FROM clean WHERE metric = 'Height' AND period = 'y1997'"

# --- descriptive ---------------------------------------------------------------


def _profile(by: str | None) -> str:
    lead = f"{by}, " if by else ""
    parts = [
        f"""SELECT {lead}'{c}' AS variable, count({c}) AS count, count(*) - count({c}) AS null_count,
  round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
  round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
  round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM lineitem {f'GROUP BY {by}' if by else ''}"""
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ]
    return "\nUNION ALL\n".join(parts)


ORACLE["describe_table"] = _profile(None)
ORACLE["describe_by"] = _profile("l_returnflag")

_CORR = ("l_quantity", "l_extendedprice", "l_discount")
ORACLE["corr_matrix"] = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS variable, '{b}' AS other, " + ("1.0::DOUBLE AS corr" if a == b else f"round(corr({a}, {b}), 9) AS corr FROM lineitem")
    for a in _CORR for b in _CORR)

_FD = """
s AS (
  SELECT count(value) AS n, min(value) AS lo, max(value) AS hi,
    2 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) / pow(count(value), 1 / 3.0::DOUBLE) AS w FROM events
),
g AS (SELECT *, greatest(1, ceil((hi - lo) / w))::INTEGER AS bins FROM s),
c AS (
  SELECT least(floor((value - lo) / ((hi - lo) / bins))::INTEGER, bins - 1) AS bin, count(*) AS count FROM events, g GROUP BY 1
),
h AS (
  SELECT b::INTEGER AS bin, lo + b * ((hi - lo) / bins) AS bin_lo, lo + (b + 1) * ((hi - lo) / bins) AS bin_hi,
    count, bins::BIGINT AS bins
  FROM g, (SELECT bin AS b, count FROM c)
)"""
ORACLE["fd_histogram"] = f"WITH {_FD} SELECT bin, {_round('bin_lo, bin_hi', 6)}, count, bins FROM h"

_GUMBEL = """
SELECT event_type, avg(value) AS mean, stddev_samp(value) AS std, count(value) AS n,
  stddev_samp(value) * sqrt(6) / pi() AS scale,
  avg(value) - 0.5772156649015329::DOUBLE * stddev_samp(value) * sqrt(6) / pi() AS location
FROM {source} GROUP BY event_type"""
ORACLE["gumbel_moments"] = f"""
SELECT event_type, {_round('mean, std', 6)}, n, {_round('scale, location', 6)} FROM ({_GUMBEL.format(source='events')})"""
ORACLE["gumbel_histogram"] = f"""
WITH {_FD}, f AS ({_GUMBEL.format(source="(SELECT 'all' AS event_type, value FROM events)")})
SELECT bin, {_round('bin_lo, bin_hi', 5)}, count, bins,
  round(n * (exp(-exp(-(bin_hi - location) / scale)) - exp(-exp(-(bin_lo - location) / scale))), 5) AS expected
FROM h, f"""

ORACLE["preview"] = "SELECT event_id, ts, event_type, value FROM events ORDER BY ts, event_id LIMIT 10"

ORACLE["month_mean_std"] = """
SELECT month(l_shipdate)::INTEGER AS month, round(avg(l_extendedprice), 5) AS mean,
  round(stddev_samp(l_extendedprice), 5) AS std FROM lineitem GROUP BY 1"""


def _rose(direction: str, value: str, edges: list) -> str:
    cases, rows = [], []
    low = edges[0]
    for i, high in enumerate(edges[1:]):
        label = f"<={high:g}" if i == 0 else f">{low:g} - {high:g}"
        cases.append(f"WHEN {value}::DOUBLE > {low} AND {value}::DOUBLE <= {high}::DOUBLE THEN {i}")
        rows.append(f"({i}, '{label}')")
        low = high
    return f"""
WITH {SERIES},
placed AS (
  SELECT (floor(({direction}::DOUBLE + 5.625) / 11.25)::INTEGER % 32) * 11.25::DOUBLE AS sector,
    CASE {' '.join(cases)} END AS band_no FROM obs
),
counts AS (SELECT sector, band_no, count(*) AS n FROM placed GROUP BY ALL),
bands(band_no, band) AS (VALUES {', '.join(rows)}),
grid AS (SELECT s * 11.25::DOUBLE AS sector, band_no, band FROM range(0, 32) r(s), bands)
SELECT g.sector, g.band_no, g.band, coalesce(c.n, 0) AS count,
  round(coalesce(c.n, 0) * 100.0::DOUBLE / (SELECT count(*) FROM placed), 8) AS percentage
FROM grid g LEFT JOIN counts c ON c.sector = g.sector AND c.band_no = g.band_no"""


ORACLE["wind_rose"] = _rose("wind_direction_deg", "wind_speed_ms", fv.WIND_EDGES)
ORACLE["wave_rose"] = _rose("wave_direction_deg", "wave_height_m", fv.WAVE_EDGES)
ORACLE["power_bands"] = f"""
WITH {SERIES} SELECT {_BAND.format(v='wave_power_kW_m')} AS band, count(*) AS count FROM obs GROUP BY 1"""

_STATUS_COUNTS = ", ".join(f"count(*) FILTER (o_orderstatus = '{s}') AS \"{s}\"" for s in "OFX")
ORACLE["contingency"] = f"SELECT month(o_orderdate)::INTEGER AS month, {_STATUS_COUNTS} FROM orders GROUP BY 1"
ORACLE["contingency_shares"] = "SELECT o_orderpriority, " + ", ".join(
    f"round(count(*) FILTER (o_orderstatus = '{s}')::DOUBLE / count(*), 9) AS \"{s}\"" for s in "OFX"
) + " FROM orders GROUP BY 1"

ORACLE["exceedance_curve"] = """
SELECT DISTINCT event_type, value, round(1 - cume_dist() OVER (PARTITION BY event_type ORDER BY value), 9) AS p_exceed
FROM events"""

# --- samples -------------------------------------------------------------------

_HASH = "('0x' || substr(md5({s}), 1, 8))::BIGINT / 4294967296.0::DOUBLE"
ORACLE["random_sample"] = f"""
SELECT event_id, event_type, value FROM events WHERE {_HASH.format(s="'42-' || event_id")} < 0.05"""
ORACLE["stratified_sample"] = f"""
SELECT event_id, event_type FROM events
WHERE {_HASH.format(s="'0-' || event_type || '_' || strftime(ts, '%Y%m') || '-' || event_id")} < 0.3"""
ORACLE["train_test_split"] = f"""
SELECT event_type, CASE WHEN {_HASH.format(s="'0-' || event_id")} < 0.2 THEN 'test' ELSE 'train' END AS part,
  count(*) AS n, sum(event_id)::BIGINT AS id_sum FROM events GROUP BY ALL"""

# --- classification quality ----------------------------------------------------

ORACLE["confusion"] = """
SELECT quality AS truth, count(*) FILTER (toxic = 0) AS pred_0, count(*) FILTER (toxic = 1) AS pred_1
FROM labels GROUP BY quality"""

_REPORT = """
r AS (
  SELECT c AS label,
    (SELECT count(*) FROM labels WHERE quality = c AND toxic = c) AS tp,
    (SELECT count(*) FROM labels WHERE quality = c) AS t, (SELECT count(*) FROM labels WHERE toxic = c) AS p
  FROM (SELECT quality AS c FROM labels UNION SELECT toxic FROM labels)
),
rep AS (
  SELECT label, CASE WHEN p = 0 THEN 0 ELSE tp::DOUBLE / p END AS precision, CASE WHEN t = 0 THEN 0 ELSE tp::DOUBLE / t END AS recall,
    CASE WHEN t + p = 0 THEN 0 ELSE 2.0::DOUBLE * tp / (t + p) END AS f1, t AS support, tp AS hits FROM r
)"""
ORACLE["class_report"] = f"""
WITH {_REPORT} SELECT label, {_round('precision, recall, f1', 9)}, support, hits FROM rep"""
ORACLE["class_distribution"] = f"""
WITH {_REPORT}
SELECT label, round(t::DOUBLE / (SELECT count(*) FROM labels), 9) AS real_share,
  round(p::DOUBLE / (SELECT count(*) FROM labels), 9) AS predicted_share FROM r"""
ORACLE["classification_metrics"] = f"""
WITH {_REPORT},
m AS (
  SELECT sum(hits)::DOUBLE / sum(support) AS accuracy, avg(recall) FILTER (support > 0) AS balanced_accuracy,
    avg(precision) AS precision_macro, avg(recall) AS recall_macro, avg(f1) AS f1_macro,
    sum(precision * support) / sum(support) AS precision_weighted, sum(recall * support) / sum(support) AS recall_weighted,
    sum(f1 * support) / sum(support) AS f1_weighted, min(recall) FILTER (support > 0) AS min_recall
  FROM rep
)
SELECT {_round('accuracy, balanced_accuracy, precision_macro, recall_macro, f1_macro, precision_weighted, recall_weighted, f1_weighted, min_recall', 9)},
  accuracy >= 0.85 AND balanced_accuracy >= 0.85 AND f1_macro >= 0.85 AND min_recall >= 0.85 AS accepted FROM m"""

# --- classifier ----------------------------------------------------------------

ORACLE["extreme_mask"] = f"""
WITH {SERIES},
b AS (SELECT quantile_cont(wave_energy::DOUBLE, 0.95) AS qe, quantile_cont(wave_power_kW_m::DOUBLE, 0.95) AS qp FROM obs)
SELECT coast_name, count(*) FILTER (wave_energy >= qe AND wave_power_kW_m >= qp) AS both,
  count(*) FILTER (wave_energy >= qe OR wave_power_kW_m >= qp) AS any
FROM obs, b GROUP BY coast_name"""

# --- streams and documents -----------------------------------------------------

ORACLE["stream_refine"] = f"""
WITH {SERIES}
SELECT coast_name, dt::TIMESTAMP AS datetime, year(l_shipdate)::INTEGER AS year, round(ws, 4)::FLOAT AS wind_speed_ms,
  round(h, 4)::FLOAT AS wave_height_m, round(t, 4)::FLOAT AS wave_period_s,
  round(490 * h * h * t / 1000, 4)::FLOAT AS wave_power_kW_m
FROM src WHERE {_GOOD_KINDS}"""

ORACLE["stream_identities"] = f"""
WITH {SERIES} SELECT count(*) AS n, count(*) AS ids, 0::BIGINT AS out_of_order FROM src WHERE {_GOOD_KINDS}"""

ORACLE["stream_quarantine"] = f"""
WITH {SERIES}, {_LINE}
SELECT error_reason, false AS resolved, count(*) AS n FROM lines WHERE error_reason <> '' GROUP BY 1"""

ORACLE["stream_daily"] = f"""
WITH {DAILY.replace('FROM obs', f'FROM obs WHERE {_GOOD_KINDS}')} SELECT * FROM daily"""

ORACLE["stream_daily_recompute"] = ORACLE["stream_daily"]
_ON_TIME, _LATE = (DAILY.replace("FROM obs", f"FROM obs WHERE {_GOOD_KINDS} AND l_suppkey % 5 {op} 0").replace("l_orderkey,\n", "l_orderkey, l_suppkey,\n")
                   for op in ("<>", "="))
ORACLE["stream_daily_late_skip"] = f"""
WITH on_time AS (WITH {_ON_TIME} SELECT * FROM daily), late AS (WITH {_LATE} SELECT * FROM daily)
SELECT * FROM on_time UNION ALL SELECT * FROM late ANTI JOIN on_time USING (date, coast_name)"""

ORACLE["stream_daily_windows"] = f"""
WITH {DAILY.replace('FROM obs', f'FROM obs WHERE {_GOOD_KINDS}')}
SELECT * FROM daily WHERE date + INTERVAL 3 DAY <= (SELECT max(datetime) FROM obs WHERE {_GOOD_KINDS})"""
ORACLE["ingest_once"] = f"""
WITH {SERIES} SELECT CASE WHEN l_orderkey % 50 = 6 THEN 'acapulco' ELSE {_STEM_CASE} END || '.v1.txt' AS file,
  count(*) AS n, count(*) AS ids FROM src GROUP BY 1"""

ORACLE["declared_tables"] = f"""
WITH {SERIES} SELECT coast_name, year(l_shipdate)::INTEGER AS year, count(*) AS n, max(round(h, 4)::FLOAT) AS highest
FROM src WHERE {_GOOD_KINDS} GROUP BY 1, 2"""
ORACLE["explore_tables"] = f"""
WITH {SERIES}
SELECT 'wind ' || month(datetime) AS item, round(avg(wind_speed_ms::DOUBLE), 4) AS mean, round(stddev_samp(wind_speed_ms::DOUBLE), 4) AS std
FROM obs GROUP BY 1 UNION ALL SELECT 'sample', 0.0::DOUBLE, 0.0::DOUBLE"""

ORACLE["observations_file"] = f"""
WITH {SERIES}
SELECT year(datetime)::INTEGER AS Anio, month(datetime)::INTEGER AS Mes, count(*) AS n, max(datetime) AS last,
  max(wave_height_m) AS max_h FROM obs GROUP BY 1, 2"""

_STATES = SERIES + f""",
states AS (
  SELECT coast_name, year, strftime(datetime, '%m') AS month,
    CASE WHEN wave_power_kW_m <= 0 THEN NULL WHEN wave_power_kW_m <= 50 THEN '{fv.SEA_STATES[0]}'
      WHEN wave_power_kW_m <= 100 THEN '{fv.SEA_STATES[1]}' WHEN wave_power_kW_m <= 200 THEN '{fv.SEA_STATES[2]}'
      WHEN wave_power_kW_m <= 500 THEN '{fv.SEA_STATES[3]}' ELSE '{fv.SEA_STATES[4]}' END AS c
  FROM obs
),
totals AS (SELECT year, month, coast_name, count(*) AS total FROM states GROUP BY ALL),
domain AS (SELECT unnest([{', '.join(f"'{s}'" for s in fv.SEA_STATES)}]) AS c),
counted AS (SELECT year, month, coast_name, c, count(*) AS n FROM states GROUP BY ALL)"""
ORACLE["sea_state_share"] = f"""
WITH {_STATES}
SELECT t.year, t.month, t.coast_name, d.c AS wave_classification,
  round(coalesce(k.n, 0)::DECIMAL(18, 0) * 100.0 / t.total, 2)::FLOAT AS percentage
FROM totals t CROSS JOIN domain d LEFT JOIN counted k
  ON k.year = t.year AND k.month = t.month AND k.coast_name = t.coast_name AND k.c = d.c"""

_IDS = ", ".join(f"('{name}', '{stem}')" for stem, name in fv.COASTS.items())
ORACLE["coast_payload_kpis"] = f"""
WITH {ANNUAL}, ids(coast_name, id) AS (VALUES {_IDS})
SELECT id, min(year) AS year_min, max(year) AS year_max, count(*) AS n_records, round(max(hs_max), 2) AS kpi_max,
  (SELECT round(max_hs, 2) FROM annual a WHERE a.coast_name = ids.coast_name ORDER BY year LIMIT 1) AS first_max,
  min(year) AS first_year, count(*) FILTER (year = 1996 AND month = 3) AS n_1996_03
FROM days JOIN ids USING (coast_name) GROUP BY id, ids.coast_name"""


ORACLE["monthly_share_job"] = ORACLE["sea_state_share"]
ORACLE["payload_files"] = ORACLE["coast_payload_kpis"].replace("SELECT id, min", "SELECT ids.coast_name AS id, min")

_NAMES = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(fv.SEA_STATES, start=1))
ORACLE["sea_state_names"] = f"""
WITH l AS (SELECT CASE WHEN l_linenumber > 1 THEN l_linenumber + CASE WHEN l_returnflag = 'R' THEN 3 ELSE 0 END END AS label FROM lineitem)
SELECT label, CASE label {_NAMES} ELSE '{fv.UNKNOWN_SEA_STATE}' END AS sea_state, count(*) AS n FROM l GROUP BY 1, 2"""
ORACLE["cluster_order"] = f"""
WITH {SERIES},
m AS (
  SELECT (l_suppkey % 6)::INTEGER AS cluster, avg(round(0.125 * (9.81::DOUBLE * 1026) * h * h, 4)::FLOAT::DOUBLE) AS e,
    avg(round(490 * h * h * t / 1000, 4)::FLOAT::DOUBLE) AS p FROM src GROUP BY 1)
SELECT cluster, row_number() OVER (ORDER BY e, p, cluster)::INTEGER AS label, round(e, 3) AS mean_wave_energy FROM m"""
_CALM = SERIES + """,
frame AS (SELECT * FROM obs),
b AS (SELECT quantile_cont(wave_energy::DOUBLE, 0.95) AS qe, quantile_cont(wave_power_kW_m::DOUBLE, 0.95) AS qp FROM frame)"""
ORACLE["feature_scaler"] = f"WITH {_CALM}" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}::DOUBLE), 4) AS mean, round(stddev_samp({c}::DOUBLE), 4) AS std "
    "FROM frame, b WHERE NOT (wave_energy >= qe AND wave_power_kW_m >= qp)" for c in fv.MODEL_FEATURES)
ORACLE["labelled_rows"] = f"""
WITH {_CALM}
SELECT coast_name, count(*) AS n, count(*) FILTER (wave_energy >= qe AND wave_power_kW_m >= qp) AS extreme,
  count(*) FILTER (NOT (wave_energy >= qe AND wave_power_kW_m >= qp)) AS calm, 0::BIGINT AS unlabelled
FROM frame, b GROUP BY coast_name"""
ORACLE["training_coast"] = f"""
WITH {SERIES} SELECT coast_name, year, count(*) AS n FROM obs
WHERE coast_name = '{fv.COASTS["tuxpan"]}' AND year % {fv.TRAIN_EVERY_N_YEARS} = 0 GROUP BY 1, 2"""
ORACLE["drop_nulls"] = """
SELECT l_returnflag, count(*) AS n, sum(l_linenumber)::BIGINT AS total FROM lineitem
WHERE l_linenumber <> 3 AND l_suppkey % 7 <> 0 GROUP BY 1"""
ORACLE["percent_scale"] = """
WITH v AS (SELECT l_returnflag, (CASE WHEN l_returnflag = 'A' THEN l_discount ELSE l_quantity END)::DOUBLE AS value FROM lineitem),
s AS (SELECT l_returnflag, round(CASE WHEN max(value) OVER (PARTITION BY l_returnflag) <= 1.5 THEN value * 100 ELSE value END, 1) AS value FROM v)
SELECT l_returnflag, value, count(*) AS n FROM s GROUP BY 1, 2"""
