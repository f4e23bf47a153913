"""Query catalog: name -> Spark plan over the test tables, and its DuckDB oracle.

Every query reads whole tables (or data Spark derives from them); results are
rounded to 6 places on both sides so doubles hash equal across engines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.functions import aqi as A
from hourcast.functions.calendar import add_calendar, add_cyclical
from hourcast.functions.numeric import r6
from hourcast.operators import windows as WN
from hourcast.operators.halo import Halo
from hourcast.plans import sqlbits as S
from hourcast.schema import LAG_COLUMNS, LOCAL_TZ, RAW_COLUMNS, ROLLING_COLUMNS
from hourcast.sources import testbind as TB
from hourcast.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# The chunked queries cut every series of the test tables into several chunks and buckets.
SMALL_CHUNKS = Halo(chunk_rows=192, bucket_seconds=4 * 86400)

MEASURES = RAW_COLUMNS[1:]
FEATURE_DOUBLES = (MEASURES + ["hour_sin", "hour_cos", "dow_sin", "dow_cos"] + LAG_COLUMNS + ROLLING_COLUMNS)
FEATURE_OTHER = ["series", "timestamp", "hour_of_day", "day_of_week", "month", "is_gap"]


# ---- M0: scalar conversions, calendar, positional windows -------------------------------

@query("aqi_continuous", f"""
SELECT event_id, {S.r6('value')} AS value, {S.r6(S.aqi_sql('value'))} AS aqi FROM events""")
def q_aqi_continuous(spark, sf):
    ev = table(spark, sf, "events")
    return r6(ev.select("event_id", "value", A.pm25_to_aqi("value").alias("aqi")))


@query("aqi_rounded", f"""
SELECT event_id, {S.r6('value')} AS value, {S.r6(S.aqi_rounded_sql('value'))} AS aqi FROM events""")
def q_aqi_rounded(spark, sf):
    ev = table(spark, sf, "events")
    return r6(ev.select("event_id", "value", A.pm25_to_aqi_rounded("value").alias("aqi")))


@query("aqi_category", f"""
WITH t AS (SELECT event_id, {S.aqi_sql('value')} AS aqi FROM events)
SELECT event_id, {S.r6('aqi')} AS aqi, {S.category_sql('aqi', 0)} AS category, {S.category_sql('aqi', 1)} AS color
FROM t""")
def q_aqi_category(spark, sf):
    ev = table(spark, sf, "events").select("event_id", A.pm25_to_aqi("value").alias("aqi"))
    return r6(ev.select("event_id", "aqi", A.aqi_category("aqi").alias("category"), A.aqi_color("aqi").alias("color")))


@query("obs_hourly", f"""
WITH {S.OBS}
{S.round_all(['aqi'] + MEASURES[1:], ['series', 'timestamp'], src='obs')}""")
def q_obs_hourly(spark, sf):
    return r6(TB.obs_hourly(spark, sf))


@query("calendar", f"""
WITH {S.OBS}
SELECT series, timestamp, CAST(hour(timestamp) AS BIGINT) AS hour_of_day,
       CAST(isodow(timestamp) - 1 AS BIGINT) AS day_of_week, CAST(month(timestamp) AS BIGINT) AS month
FROM obs""")
def q_calendar(spark, sf):
    return add_calendar(TB.obs_hourly(spark, sf).select("series", "timestamp"))


@query("cyclical", f"""
WITH {S.OBS}, t AS (SELECT series, timestamp,
    sin(2 * pi() * hour(timestamp) / 24.0) AS hour_sin, cos(2 * pi() * hour(timestamp) / 24.0) AS hour_cos,
    sin(2 * pi() * (isodow(timestamp) - 1) / 7.0) AS dow_sin, cos(2 * pi() * (isodow(timestamp) - 1) / 7.0) AS dow_cos
  FROM obs)
{S.round_all(['hour_sin', 'hour_cos', 'dow_sin', 'dow_cos'], ['series', 'timestamp'])}""")
def q_cyclical(spark, sf):
    df = add_cyclical(add_calendar(TB.obs_hourly(spark, sf).select("series", "timestamp")))
    return r6(df.select("series", "timestamp", "hour_sin", "hour_cos", "dow_sin", "dow_cos"))


@query("lags", f"""
WITH {S.OBS}, t AS (SELECT series, timestamp, aqi,
    lag(aqi, 1) OVER w AS aqi_lag_1h, lag(aqi, 3) OVER w AS aqi_lag_3h, lag(aqi, 6) OVER w AS aqi_lag_6h,
    lag(aqi, 12) OVER w AS aqi_lag_12h, lag(aqi, 24) OVER w AS aqi_lag_24h FROM obs WINDOW w AS {S.W})
{S.round_all(['aqi'] + LAG_COLUMNS, ['series', 'timestamp'])}""")
def q_lags(spark, sf):
    return r6(WN.add_lags(TB.obs_hourly(spark, sf).select("series", "timestamp", "aqi")))


@query("rolling_mean", f"""
WITH {S.OBS}, t AS (SELECT series, timestamp, aqi,
    avg(aqi) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS rolling_mean_6h,
    avg(aqi) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS rolling_mean_24h FROM obs WINDOW w AS {S.W})
{S.round_all(['aqi', 'rolling_mean_6h', 'rolling_mean_24h'], ['series', 'timestamp'])}""")
def q_rolling_mean(spark, sf):
    df = WN.add_rolling(TB.obs_hourly(spark, sf).select("series", "timestamp", "aqi"))
    return r6(df.select("series", "timestamp", "aqi", "rolling_mean_6h", "rolling_mean_24h"))


@query("rolling_std", f"""
WITH {S.OBS}, t AS (SELECT series, timestamp, aqi,
    stddev_samp(aqi) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS rolling_std_6h,
    stddev_samp(aqi) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS rolling_std_24h FROM obs WINDOW w AS {S.W})
{S.round_all(['aqi', 'rolling_std_6h', 'rolling_std_24h'], ['series', 'timestamp'])}""")
def q_rolling_std(spark, sf):
    df = WN.add_rolling(TB.obs_hourly(spark, sf).select("series", "timestamp", "aqi"))
    return r6(df.select("series", "timestamp", "aqi", "rolling_std_6h", "rolling_std_24h"))


@query("gaps", f"""
WITH {S.OBS}, t AS (SELECT series, timestamp, CAST({S.GAP} AS FLOAT) AS hours_since_prev,
    CAST({S.GAP} > 1.0 AS TINYINT) AS is_gap FROM obs WINDOW w AS {S.W})
SELECT * FROM t""")
def q_gaps(spark, sf):
    return WN.add_gap_features(TB.obs_hourly(spark, sf).select("series", "timestamp"))


ENGINEERED_SQL = f"""
WITH {S.OBS}, t AS ({S.feat_cols('obs')})
{S.round_all(FEATURE_DOUBLES, FEATURE_OTHER, ['hours_since_prev'])}"""


@query("engineered_features", ENGINEERED_SQL)
def q_engineered_features(spark, sf):
    return r6(WN.add_engineered_features(TB.obs_hourly(spark, sf)))


@query("engineered_features_halo", ENGINEERED_SQL)
def q_engineered_features_halo(spark, sf):
    return r6(WN.add_engineered_features(TB.obs_hourly(spark, sf), strategy=SMALL_CHUNKS))


# ---- M1: sources, typing, filters -------------------------------------------------------
from hourcast.operators import joins as J  # noqa: E402
from hourcast.operators import ordering as O  # noqa: E402
from hourcast.sources import payload as P  # noqa: E402
from hourcast.schema import FORECAST_COLUMNS, FORECAST_WINDOW_COLUMNS  # noqa: E402

AS_OF = "2024-01-20 12:30:00"
AS_OF_HOUR = "TIMESTAMP '2024-01-20 12:00:00'"
AS_OF_FROM, AS_OF_UNTIL = "2024-01-20 12:00:00", "2024-01-20 13:00:00"  # the as-of hour
AS_OF_PLUS_6H, AS_OF_PLUS_72H = "2024-01-20 19:00:00", "2024-01-23 12:00:00"


def _as_of_base(spark, sf):
    """The as-of hour's rows and the forecast hours they can reach, both bounded at the scan."""
    base = TB.obs_hourly(spark, sf, AS_OF_FROM, AS_OF_UNTIL).select("series", "timestamp")
    return base, TB.forecast_hourly(spark, sf, since=AS_OF_FROM, until=AS_OF_PLUS_72H)
CUTOFF = "2024-01-21 00:00:00"


@query("json_arrays_to_rows", f"""
WITH {S.OBS}
SELECT series, timestamp, {', '.join(S.r6(c) + ' AS ' + c for c in ['pm25', 'pm10', 'co', 'no2', 'so2', 'o3'])},
       {S.r6(S.aqi_sql('pm25'))} AS aqi
FROM obs""")
def q_json_arrays_to_rows(spark, sf):
    landed = P.build_payloads(TB.obs_hourly(spark, sf), P.AIR_FIELDS)
    return r6(P.parse_air_payload(landed))


@query("weather_payload_rows", f"""
WITH {S.OBS}
SELECT series, timestamp, {', '.join(S.r6(c) + ' AS ' + c for c in ['temperature', 'humidity', 'wind_speed'])}
FROM obs""")
def q_weather_payload_rows(spark, sf):
    landed = P.build_payloads(TB.weather_hourly(spark, sf), P.WEATHER_FIELDS)
    return r6(P.parse_payload(landed, P.WEATHER_FIELDS))


@query("forecast_payload_rows", f"""
WITH {S.EV}, {S.FORECAST}
SELECT series, timestamp, {', '.join(S.r6(c) + ' AS ' + c for c in FORECAST_COLUMNS)} FROM fc""")
def q_forecast_payload_rows(spark, sf):
    landed = P.build_payloads(TB.forecast_hourly(spark, sf), P.FORECAST_FIELDS)
    return r6(P.parse_payload(landed, P.FORECAST_FIELDS))


@query("coerce", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
       TRY_CAST(event_type AS DOUBLE) AS junk FROM events""")
def q_coerce(spark, sf):
    from hourcast.functions.numeric import coerce_double
    ev = table(spark, sf, "events")
    return ev.select("event_id", coerce_double(F.get_json_object("props", "$.k")).alias("k"),
                     coerce_double("event_type").alias("junk"))


@query("historical_scan", """
SELECT event_id, ts, value FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'""")
def q_historical_scan(spark, sf):
    ev = table(spark, sf, "events")
    lo, hi = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-12 00:00:00").cast("timestamp_ntz")
    return r6(ev.filter((F.col("ts") >= lo) & (F.col("ts") < hi)).select("event_id", "ts", "value"))


@query("current_or_last", f"""
WITH {S.OBS}, t AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY (timestamp = {AS_OF_HOUR}) DESC, timestamp DESC) AS rk
  FROM obs WHERE timestamp <= {AS_OF_HOUR} + INTERVAL 6 HOUR)
{S.round_all(['aqi'] + MEASURES[1:], ['series', 'timestamp'], src='t WHERE rk = 1')}""")
def q_current_or_last(spark, sf):
    return r6(O.current_or_last(TB.obs_hourly(spark, sf, until=AS_OF_PLUS_6H), AS_OF))


@query("carry_forward", f"""
WITH {S.OBS}, hist AS (SELECT * FROM obs WHERE timestamp < TIMESTAMP '{CUTOFF}'),
ser AS (SELECT DISTINCT event_type AS series FROM events),
t0 AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY timestamp DESC) AS rk FROM hist),
t1 AS (SELECT ser.series, t0.* EXCLUDE (series, timestamp, rk) FROM ser LEFT JOIN t0 ON ser.series = t0.series AND t0.rk = 1),
t AS (SELECT series, {AS_OF_HOUR} AS timestamp, * EXCLUDE (series) FROM t1)
{S.round_all(['aqi'] + MEASURES[1:], ['series', 'timestamp'])}""")
def q_carry_forward(spark, sf):
    hist = TB.obs_hourly(spark, sf, until=CUTOFF)
    series_list = table(spark, sf, "events").select(F.col("event_type").alias("series"))
    return r6(O.carry_forward(hist, series_list, AS_OF))


@query("alert", f"""
WITH {S.OBS}, {S.FORECAST.replace('fc AS', 'fc AS', 1)},
base AS (SELECT series, timestamp FROM obs WHERE timestamp = {AS_OF_HOUR}),
pred AS (
  SELECT b.series, h.horizon, {S.aqi_sql('avg(f.fc_pm25)')} AS prediction
  FROM base b CROSS JOIN (VALUES (24, 0), (48, 24), (72, 48)) h(horizon, h0)
  JOIN fc f ON f.series = b.series AND f.timestamp >= b.timestamp + to_hours(h.h0)
       AND f.timestamp < b.timestamp + to_hours(h.h0 + 24)
  GROUP BY b.series, h.horizon)
SELECT series, bool_or(prediction > 150) AS alert,
       COALESCE(string_agg(CASE WHEN prediction > 150 THEN horizon || 'h' END, ', ' ORDER BY horizon), '') AS horizons,
       {S.r6('max(prediction)')} AS max_prediction
FROM pred GROUP BY series""")
def q_alert(spark, sf):
    from hourcast.plans.scoring import alerts
    win = J.forecast_windows(*_as_of_base(spark, sf), decimals=None)
    preds = win.select("series", F.explode(F.array(*[
        F.struct(F.lit(h).alias("horizon"), A.pm25_to_aqi(F.col(f"fc_pm25_{h}h")).alias("prediction"))
        for h in (24, 48, 72)])).alias("p")).select("series", "p.*").filter(F.col("prediction").isNotNull())
    return r6(alerts(preds))


# ---- M2: joins, unions, ordering ----------------------------------------------------------

@query("join_weather", f"""
WITH {S.OBS}
SELECT series, timestamp, {', '.join(S.r6(c) + ' AS ' + c for c in MEASURES[1:])} FROM obs""")
def q_join_weather(spark, sf):
    return r6(J.join_on_time(TB.air_hourly(spark, sf), TB.weather_hourly(spark, sf)))


@query("weather_lookup", f"""
WITH {S.OBS}, cur AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY (timestamp = {AS_OF_HOUR}) DESC, timestamp DESC) AS rk
  FROM (SELECT series, timestamp, pm25 FROM obs WHERE timestamp <= {AS_OF_HOUR})),
wx AS (SELECT series, timestamp, temperature, humidity, wind_speed FROM obs)
SELECT c.series, c.timestamp, {S.r6('c.pm25')} AS pm25, {S.r6('wx.temperature')} AS temperature,
       {S.r6('wx.humidity')} AS humidity, {S.r6('wx.wind_speed')} AS wind_speed
FROM cur c LEFT JOIN wx ON wx.series = c.series AND wx.timestamp = c.timestamp WHERE c.rk = 1""")
def q_weather_lookup(spark, sf):
    cur = O.current_or_last(TB.air_hourly(spark, sf, until=AS_OF_UNTIL).select("series", "timestamp", "pm25"), AS_OF)
    wx = TB.weather_hourly(spark, sf, until=AS_OF_UNTIL)
    return r6(J.join_on_time(cur, wx, "left"))


_fc_join, _fc_sel = S.fc_window_sql()


@query("forecast_windows", f"""
WITH {S.OBS}, {S.FORECAST}, base AS (SELECT series, timestamp FROM obs),
j AS ({_fc_join}),
t AS (SELECT series, timestamp, {_fc_sel} FROM j GROUP BY series, timestamp)
{S.round_all(FORECAST_WINDOW_COLUMNS, ['series', 'timestamp'])}""")
def q_forecast_windows(spark, sf):
    base = TB.obs_hourly(spark, sf).select("series", "timestamp")
    return r6(J.forecast_windows(base, TB.forecast_hourly(spark, sf)))


_FULL_FORECAST = S.FORECAST.replace("+ INTERVAL 10 DAY", "")


@query("forecast_windows_full", f"""
WITH {S.OBS}, {_FULL_FORECAST}, base AS (SELECT series, timestamp FROM obs),
j AS ({_fc_join}),
t AS (SELECT series, timestamp, {_fc_sel} FROM j GROUP BY series, timestamp)
{S.round_all(FORECAST_WINDOW_COLUMNS, ['series', 'timestamp'])}""")
def q_forecast_windows_full(spark, sf):
    base = TB.obs_hourly(spark, sf).select("series", "timestamp")
    return r6(J.forecast_windows(base, TB.forecast_hourly(spark, sf, lead_days=0)))


@query("forecast_windows_latest", f"""
WITH {S.OBS}, {S.FORECAST}, base AS (SELECT series, max(timestamp) - INTERVAL 80 HOUR AS timestamp FROM obs GROUP BY series),
j AS ({_fc_join}),
t AS (SELECT series, timestamp, {_fc_sel} FROM j GROUP BY series, timestamp)
{S.round_all(FORECAST_WINDOW_COLUMNS, ['series', 'timestamp'])}""")
def q_forecast_windows_latest(spark, sf):
    obs = TB.obs_hourly(spark, sf)
    cur = obs.groupBy("series").agg((F.max("timestamp") - F.expr("INTERVAL 80 HOURS")).alias("timestamp"))
    return r6(J.forecast_windows(cur, TB.forecast_hourly(spark, sf)))


@query("anti_join_new", f"""
WITH {S.OBS}
SELECT series, timestamp, {S.r6('aqi')} AS aqi FROM obs o
WHERE NOT EXISTS (SELECT 1 FROM obs e WHERE e.series = o.series AND e.timestamp = o.timestamp
                  AND e.timestamp < TIMESTAMP '{CUTOFF}')""")
def q_anti_join_new(spark, sf):
    obs = TB.obs_hourly(spark, sf)
    existing = obs.filter(F.col("timestamp") < F.lit(CUTOFF).cast("timestamp_ntz"))
    return r6(J.anti_join_new(obs.select("series", "timestamp", "aqi"), existing))


@query("semi_join_forecast", f"""
WITH {S.OBS}, {S.FORECAST}
SELECT series, timestamp, {S.r6('aqi')} AS aqi FROM obs o
WHERE EXISTS (SELECT 1 FROM fc f WHERE f.series = o.series AND f.timestamp = o.timestamp)""")
def q_semi_join_forecast(spark, sf):
    obs = TB.obs_hourly(spark, sf).select("series", "timestamp", "aqi")
    return r6(J.semi_join(obs, TB.forecast_hourly(spark, sf), ["series", "timestamp"]))


@query("union_by_name", f"""
WITH {S.EV},
air AS (SELECT series, timestamp, {S.AIR_AGGS} FROM ev GROUP BY series, timestamp),
wx AS (SELECT series, timestamp, {S.WEATHER_AGGS} FROM ev GROUP BY series, timestamp),
t AS (SELECT * FROM air UNION ALL BY NAME SELECT * FROM wx)
{S.round_all(MEASURES[1:], ['series', 'timestamp'])}""")
def q_union_by_name(spark, sf):
    return r6(J.union_by_name(TB.air_hourly(spark, sf), TB.weather_hourly(spark, sf)))


@query("latest_n", f"""
WITH {S.OBS}, t AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY timestamp DESC) AS rk FROM obs)
SELECT series, timestamp, {S.r6('aqi')} AS aqi FROM t WHERE rk <= 50""")
def q_latest_n(spark, sf):
    return r6(O.latest_n(TB.obs_hourly(spark, sf).select("series", "timestamp", "aqi"), 50))


@query("latest_n_then_filter", f"""
WITH {S.OBS}, t AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY timestamp DESC) AS rk FROM obs)
SELECT series, timestamp, {S.r6('no2')} AS no2 FROM t WHERE rk <= 500 AND no2 IS NOT NULL""")
def q_latest_n_then_filter(spark, sf):
    obs = TB.obs_hourly(spark, sf).select("series", "timestamp", "no2")
    return r6(O.latest_n_then_filter(obs, 500, F.col("no2").isNotNull()))


@query("sample_hash", f"""
SELECT event_id, {S.r6('value')} AS pm25, {S.r6(S.aqi_sql('value'))} AS aqi_calc FROM events
WHERE value IS NOT NULL
ORDER BY (((event_id % 2147483647) * 48271 + 42) % 2147483647), event_id LIMIT 2000""")
def q_sample_hash(spark, sf):
    ev = table(spark, sf, "events").filter(F.col("value").isNotNull())
    s = O.deterministic_sample(ev.select("event_id", "value"), 2000, "event_id", 42)
    return r6(s.select("event_id", F.col("value").alias("pm25"), A.pm25_to_aqi("value").alias("aqi_calc")))


@query("dedupe", f"""
WITH t AS (SELECT event_type AS series, date_trunc('hour', ts) AS timestamp, ts, event_id, value,
  row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS rk FROM events)
SELECT series, timestamp, ts, event_id, {S.r6('value')} AS value FROM t WHERE rk = 1""")
def q_dedupe(spark, sf):
    from hourcast.functions.calendar import floor_hour
    ev = table(spark, sf, "events").select(F.col("event_type").alias("series"), floor_hour("ts").alias("timestamp"),
                                           "ts", "event_id", "value")
    return r6(O.dedupe_latest(ev, ["series", "timestamp"], [F.col("ts"), F.col("event_id")]))


@query("clamp_time", f"""
WITH {S.OBS}
SELECT series, least(max(timestamp), TIMESTAMP '{CUTOFF}') AS shown_ts,
       strftime(timezone('{LOCAL_TZ}', least(max(timestamp), TIMESTAMP '{CUTOFF}') AT TIME ZONE 'UTC'), '%Y-%m-%d %I:%M %p') AS shown_local
FROM obs GROUP BY series""")
def q_clamp_time(spark, sf):
    from hourcast.functions.calendar import local_time
    obs = TB.obs_hourly(spark, sf)
    latest = obs.groupBy("series").agg(F.max("timestamp").alias("ts"))
    shown = latest.select("series", O.clamp_time("ts", CUTOFF).alias("shown_ts"))
    return shown.withColumn("shown_local", F.date_format(local_time("shown_ts"), "yyyy-MM-dd hh:mm a"))


# ---- M3: targets, back-fill, fills, splits, sequences, append row -------------------------
from hourcast.operators import coverage as CV  # noqa: E402
from hourcast.plans.backfill import build_backfill_dataset  # noqa: E402
from hourcast.schema import FORECAST_BASE_FEATURES  # noqa: E402


def _features(spark, sf):
    return WN.add_engineered_features(TB.obs_hourly(spark, sf))


for _h in (24, 48, 72):
    def _mk(h):
        def q(spark, sf):
            return r6(WN.build_training_frame(_features(spark, sf), h))
        return q

    def _mk_halo(h):
        def q(spark, sf):
            return r6(WN.build_training_frame(WN.add_engineered_features(TB.obs_hourly(spark, sf), strategy=SMALL_CHUNKS),
                                              h, strategy=SMALL_CHUNKS))
        return q
    _sql = f"""
WITH {S.FEAT}, t AS ({S.target_sql('feat', _h)})
{S.round_all(FEATURE_DOUBLES + [f'aqi_next_{_h}h'], FEATURE_OTHER, ['hours_since_prev'])}"""
    query(f"target_{_h}h", _sql)(_mk(_h))
    if _h == 72:
        query(f"target_{_h}h_halo", _sql)(_mk_halo(_h))


@query("target_double_filter", f"""
WITH {S.FEAT}, t1 AS ({S.target_sql('feat', 24)}), t2 AS (SELECT * FROM t1 WHERE aqi_next_24h IS NOT NULL),
t AS (SELECT series, timestamp, aqi_next_24h FROM (
  SELECT *, lead(timestamp, 24) OVER w AS _t2 FROM t2 WINDOW w AS {S.W})
  WHERE (epoch_us(_t2) - epoch_us(timestamp)) / 3.6e9 = 24.0)
{S.round_all(['aqi_next_24h'], ['series', 'timestamp'])}""")
def q_target_double_filter(spark, sf):
    tf = WN.build_training_frame(_features(spark, sf), 24).filter(F.col("aqi_next_24h").isNotNull())
    return r6(WN.exact_horizon_recheck(tf, 24).select("series", "timestamp", "aqi_next_24h"))


@query("shifted_backfill", f"""
WITH {S.FEAT}, {S.FORECAST}, base AS (SELECT * FROM feat),
j AS ({_fc_join}),
fw AS (SELECT series, timestamp, {_fc_sel} FROM j GROUP BY series, timestamp),
withfc AS (SELECT feat.*, fw.* EXCLUDE (series, timestamp) FROM feat JOIN fw USING (series, timestamp)),
t AS ({S.backfill_sql('withfc')})
{S.round_all(FEATURE_DOUBLES + FORECAST_WINDOW_COLUMNS, FEATURE_OTHER, ['hours_since_prev'])}""")
def q_shifted_backfill(spark, sf):
    return r6(build_backfill_dataset(TB.air_hourly(spark, sf), TB.weather_hourly(spark, sf),
                                     TB.forecast_hourly(spark, sf)))


@query("full_backfill_halo", f"""
WITH {S.FEAT}, {S.FORECAST}, base AS (SELECT * FROM feat),
j AS ({_fc_join}),
fw AS (SELECT series, timestamp, {_fc_sel} FROM j GROUP BY series, timestamp),
withfc AS (SELECT feat.*, fw.* EXCLUDE (series, timestamp) FROM feat JOIN fw USING (series, timestamp)),
t AS ({S.backfill_sql('withfc')})
{S.round_all(FEATURE_DOUBLES + FORECAST_WINDOW_COLUMNS, FEATURE_OTHER, ['hours_since_prev'])}""")
def q_full_backfill_halo(spark, sf):
    return r6(build_backfill_dataset(TB.air_hourly(spark, sf), TB.weather_hourly(spark, sf),
                                     TB.forecast_hourly(spark, sf), strategy=SMALL_CHUNKS))


_SPLIT_SQL = f"""{S.OBS}, sp AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY series ORDER BY timestamp)
                      <= floor(count(*) OVER (PARTITION BY series) * 0.8) THEN 'train' ELSE 'test' END AS split
  FROM obs)"""


@query("split_80_20", f"""
WITH {_SPLIT_SQL}
SELECT series, timestamp, split FROM sp""")
def q_split(spark, sf):
    return WN.chronological_split(TB.obs_hourly(spark, sf).select("series", "timestamp"))


@query("split_80_20_halo", f"""
WITH {_SPLIT_SQL}
SELECT series, timestamp, split FROM sp""")
def q_split_halo(spark, sf):
    return WN.chronological_split(TB.obs_hourly(spark, sf).select("series", "timestamp"), strategy=SMALL_CHUNKS)


@query("ffill", f"""
WITH {_SPLIT_SQL}, t AS (SELECT series, timestamp, split,
  COALESCE(last_value(no2 IGNORE NULLS) OVER (PARTITION BY series, split ORDER BY timestamp
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS no2 FROM sp)
{S.round_all(['no2'], ['series', 'timestamp', 'split'])}""")
def q_ffill(spark, sf):
    obs = TB.obs_hourly(spark, sf).select("series", "timestamp", "no2")
    sp = WN.chronological_split(obs)
    return r6(WN.forward_fill(sp, ["no2"], partition=("series", "split")))


@query("cumulative_gap_share", f"""
WITH {S.OBS}, g AS (SELECT series, timestamp,
  (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER w)) / 3.6e9 AS gap_hours FROM obs WINDOW w AS {S.W}),
t AS (SELECT series, timestamp, gap_hours, row_number() OVER w AS step,
  sum(CAST(gap_hours = 1.0 AS BIGINT)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100.0
    / row_number() OVER w AS cum_one_hour_pct
  FROM g WHERE gap_hours IS NOT NULL WINDOW w AS {S.W})
{S.round_all(['gap_hours', 'cum_one_hour_pct'], ['series', 'timestamp', 'step'])}""")
def q_cumulative_gap_share(spark, sf):
    return r6(WN.cumulative_gap_share(TB.obs_hourly(spark, sf).select("series", "timestamp")))


SEQ_FEATS = ["aqi", "pm25", "hour_sin", "rolling_mean_6h"]


@query("sequences", f"""
WITH {S.FEAT}, tf AS ({S.target_sql('feat', 24)}),
t AS (SELECT series, timestamp,
  list([{', '.join(f'CAST({c} AS FLOAT)' for c in SEQ_FEATS)}]) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS x,
  count(*) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS n,
  CAST(aqi_next_24h AS FLOAT) AS y FROM tf WINDOW w AS {S.W})
SELECT series, timestamp, x, y FROM t WHERE n = 24 AND y IS NOT NULL""")
def q_sequences(spark, sf):
    tf = WN.build_training_frame(_features(spark, sf), 24)
    return WN.sequences(tf, SEQ_FEATS, "aqi_next_24h", 24)


@query("append_row", f"""
WITH {S.OBS}, u AS (SELECT * FROM obs WHERE timestamp < TIMESTAMP '{CUTOFF}' AND aqi IS NOT NULL
                    UNION ALL SELECT * FROM obs WHERE timestamp = TIMESTAMP '{CUTOFF}'),
f AS ({S.feat_cols('u')}),
t AS (SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY timestamp DESC) AS rk FROM f)
      WHERE rk = 1)
{S.round_all(FEATURE_DOUBLES, FEATURE_OTHER, ['hours_since_prev'])}""")
def q_append_row(spark, sf):
    current = TB.obs_hourly(spark, sf, CUTOFF).filter(F.col("timestamp") == F.lit(CUTOFF).cast("timestamp_ntz"))
    return r6(WN.append_row_features(TB.obs_hourly(spark, sf, until=CUTOFF), current))


def _cov_sql():
    parts = []
    for h in (24, 48, 72):
        label = f"{h}h"
        for b in FORECAST_BASE_FEATURES:
            c = f"{b}_{label}"
            parts.append(f"SELECT {h} AS horizon, '{c}' AS feature, {S.r6(f'avg(CAST({c} IS NOT NULL AS DOUBLE))')} AS coverage, "
                         f"avg(CAST({c} IS NOT NULL AS DOUBLE)) >= 0.05 AS kept FROM tf{h}")
    ctes = ", ".join(f"tf{h} AS ({S.target_sql('withfc', h)})" for h in (24, 48, 72))
    return f"""
WITH {S.FEAT}, {S.EV.replace('ev AS', 'ev2 AS', 1)}, {S.FORECAST}, base AS (SELECT * FROM feat),
j AS ({_fc_join}),
fw AS (SELECT series, timestamp, {_fc_sel} FROM j GROUP BY series, timestamp),
withfc AS (SELECT feat.*, fw.* EXCLUDE (series, timestamp) FROM feat JOIN fw USING (series, timestamp)),
{ctes}
{' UNION ALL '.join(parts)}"""


@query("coverage_gate", _cov_sql())
def q_coverage_gate(spark, sf):
    feats = J.forecast_windows(_features(spark, sf), TB.forecast_hourly(spark, sf))
    out = None
    for h in (24, 48, 72):
        d = CV.coverage_decisions(WN.build_training_frame(feats, h), h)
        out = d if out is None else out.unionByName(d)
    return r6(out)


@query("rows_with_forecast", f"""
WITH {S.FEAT}, {S.FORECAST}, base AS (SELECT * FROM feat),
j AS ({_fc_join}),
fw AS (SELECT series, timestamp, {_fc_sel} FROM j GROUP BY series, timestamp)
SELECT count(*) AS n_rows, count(*) FILTER (WHERE COALESCE({', '.join(c for c in FORECAST_WINDOW_COLUMNS if not c.startswith('fc_pm25'))}) IS NOT NULL)
  AS rows_with_forecast FROM fw""")
def q_rows_with_forecast(spark, sf):
    from hourcast.schema import FORECAST_FEATURE_COLS
    feats = J.forecast_windows(TB.obs_hourly(spark, sf).select("series", "timestamp"), TB.forecast_hourly(spark, sf))
    return CV.rows_with_any(feats, FORECAST_FEATURE_COLS)


# ---- M4: aggregations ---------------------------------------------------------------------
from hourcast.functions.numeric import round_stable  # noqa: E402
from hourcast.operators import aggregates as AG  # noqa: E402
from hourcast.operators import stats as ST  # noqa: E402
from hourcast.schema import POLLUTANTS, numeric_columns  # noqa: E402

LOCAL = f"""{S.FEAT}, l AS (SELECT *, timezone('{LOCAL_TZ}', timestamp AT TIME ZONE 'UTC') AS lt FROM feat)"""


def _prof_sql(key_expr: str, key: str, std: bool = False, having: str = "") -> str:
    extra = f", {S.r6('stddev_samp(aqi)')} AS std" if std else ""
    return f"""
WITH {LOCAL}
SELECT series, {key_expr} AS {key}, {S.r6('avg(aqi)')} AS mean{extra} FROM l GROUP BY series, {key_expr} {having}"""


def _prof(by, std=False):
    def q(spark, sf):
        return r6(AG.profile(_features(spark, sf), by, std=std))
    return q


query("by_hour", _prof_sql("CAST(hour(lt) AS BIGINT)", "local_hour", std=True))(_prof("local_hour", True))
query("by_dow", _prof_sql("CAST(isodow(lt) - 1 AS BIGINT)", "local_dow"))(_prof("local_dow"))
query("by_month", _prof_sql("CAST(month(lt) AS BIGINT)", "local_month"))(_prof("local_month"))
query("by_period", _prof_sql("strftime(lt, '%Y-%m')", "local_period"))(_prof("local_period"))
query("by_date", _prof_sql("CAST(lt AS DATE)", "local_date"))(_prof("local_date"))


@query("resample_daily", _prof_sql("CAST(lt AS DATE)", "local_date", having="HAVING avg(aqi) IS NOT NULL"))
def q_resample_daily(spark, sf):
    return r6(AG.daily_resample(_features(spark, sf)))


@query("argmax_hour", f"""
WITH {LOCAL}, p AS (SELECT series, CAST(hour(lt) AS BIGINT) AS h, avg(aqi) AS m FROM l GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY m DESC, h) AS top,
             row_number() OVER (PARTITION BY series ORDER BY m ASC, h) AS bot FROM p)
SELECT series, max(CASE WHEN top = 1 THEN h END) AS peak, max(CASE WHEN bot = 1 THEN h END) AS clean
FROM r GROUP BY series""")
def q_argmax_hour(spark, sf):
    return AG.arg_extremes(AG.profile(_features(spark, sf), "local_hour"), "local_hour")


@query("argmax_period", f"""
WITH {LOCAL}, p AS (SELECT series, strftime(lt, '%Y-%m') AS h, avg(aqi) AS m FROM l GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY m DESC, h) AS top,
             row_number() OVER (PARTITION BY series ORDER BY m ASC, h) AS bot FROM p)
SELECT series, max(CASE WHEN top = 1 THEN h END) AS peak, max(CASE WHEN bot = 1 THEN h END) AS clean
FROM r GROUP BY series""")
def q_argmax_period(spark, sf):
    return AG.arg_extremes_str(AG.profile(_features(spark, sf), "local_period"), "local_period")


@query("global_stats", f"""
WITH {S.FEAT}
SELECT series, count(aqi) AS n, {S.r6('avg(aqi)')} AS mean, {S.r6('stddev_samp(aqi)')} AS std,
       {S.r6('min(aqi)')} AS min, {S.r6('max(aqi)')} AS max, min(timestamp) AS first_ts, max(timestamp) AS last_ts,
       {S.r6('quantile_cont(aqi, 0.5)')} AS median
FROM feat GROUP BY series""")
def q_global_stats(spark, sf):
    return r6(AG.global_stats(_features(spark, sf)))


@query("shares", f"""
WITH {S.FEAT}
SELECT series, {S.r6('avg(COALESCE(CAST(aqi <= 50 AS DOUBLE), 0.0)) * 100.0')} AS good_pct,
       {S.r6('avg(COALESCE(CAST(aqi > 50 AND aqi <= 100 AS DOUBLE), 0.0)) * 100.0')} AS moderate_pct,
       {S.r6('avg(COALESCE(CAST(aqi > 100 AS DOUBLE), 0.0)) * 100.0')} AS unhealthy_pct
FROM feat GROUP BY series""")
def q_shares(spark, sf):
    return r6(AG.shares(_features(spark, sf)))


def _bands_sql():
    parts = []
    for name, lo, hi in AG.BANDS:
        cond = " AND ".join(([f"aqi > {lo}"] if lo is not None else []) + ([f"aqi <= {hi}"] if hi is not None else []))
        parts.append(f"SELECT series, '{name}' AS band, count(*) FILTER (WHERE {cond}) AS count, "
                     f"{S.r6(f'count(*) FILTER (WHERE {cond}) * 100.0 / count(*)')} AS pct FROM feat GROUP BY series")
    return f"WITH {S.FEAT}\n" + " UNION ALL ".join(parts)


@query("bands", _bands_sql())
def q_bands(spark, sf):
    return r6(AG.band_counts(_features(spark, sf)))


def _describe_sql():
    parts = []
    for c in POLLUTANTS:
        def r3(e):
            return S.rounded(e, 3)
        parts.append(f"""SELECT '{c}' AS column, {r3(f'CAST(count({c}) AS DOUBLE)')} AS count, {r3(f'avg({c})')} AS mean,
  {r3(f'stddev_samp({c})')} AS std, {r3(f'min({c})')} AS min, {r3(f"quantile_cont({c}, 0.25)")} AS p25,
  {r3(f"quantile_cont({c}, 0.5)")} AS p50, {r3(f"quantile_cont({c}, 0.75)")} AS p75, {r3(f'max({c})')} AS max,
  {r3(S.rounded(f"stddev_samp({c}) / avg({c}) * 100.0", 1))} AS cv_pct FROM feat""")
    body = " UNION ALL ".join(parts)
    cols = ["count", "mean", "std", "min", "p25", "p50", "p75", "max", "cv_pct"]
    return f"WITH {S.FEAT}, t AS ({body})\n{S.round_all(cols, ['\"column\"'])}"


@query("describe", _describe_sql())
def q_describe(spark, sf):
    return r6(AG.describe(_features(spark, sf), POLLUTANTS))


def _null_sql():
    from hourcast.plans.sqlbits import FEAT_COLS_ORDER
    parts = [f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
             f"{S.rounded(f'count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*)', 2)} AS missing_pct FROM feat"
             for c in FEAT_COLS_ORDER]
    return f"WITH {S.FEAT}, t AS ({' UNION ALL '.join(parts)})\n" \
           f"SELECT \"column\", missing_count, {S.r6('missing_pct')} AS missing_pct FROM t WHERE missing_count > 0"


@query("null_profile", _null_sql())
def q_null_profile(spark, sf):
    return r6(AG.null_profile(_features(spark, sf)))


def _schema_sql():
    from hourcast.plans.sqlbits import FEAT_COLS_ORDER
    m = ("CASE typeof({c}) WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DOUBLE' "
         "THEN 'double' WHEN 'BIGINT' THEN 'bigint' WHEN 'FLOAT' THEN 'float' WHEN 'TINYINT' THEN 'tinyint' "
         "ELSE lower(typeof({c})) END")
    parts = [f"SELECT '{c}' AS column, any_value({m.format(c=c)}) AS dtype, count({c}) AS non_null FROM feat"
             for c in FEAT_COLS_ORDER]
    return f"WITH {S.FEAT}\n" + " UNION ALL ".join(parts)


@query("schema_profile", _schema_sql())
def q_schema_profile(spark, sf):
    return AG.schema_profile(_features(spark, sf))


@query("coverage", f"""
WITH {S.FEAT}, {S.FORECAST}, base AS (SELECT series, timestamp FROM feat),
j AS ({_fc_join}),
fw AS (SELECT series, timestamp, {_fc_sel} FROM j GROUP BY series, timestamp),
t AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, avg(CAST({c} IS NOT NULL AS DOUBLE)) * 100.0 AS coverage_pct FROM fw" for c in FORECAST_WINDOW_COLUMNS)})
SELECT feature, {S.r6('coverage_pct')} AS coverage_pct, coverage_pct >= 95 AS well_covered FROM t""")
def q_coverage(spark, sf):
    fw = J.forecast_windows(TB.obs_hourly(spark, sf).select("series", "timestamp"), TB.forecast_hourly(spark, sf))
    cov = CV.coverage_frame(fw, FORECAST_WINDOW_COLUMNS)
    return r6(cov.select(F.col("column").alias("feature"), (F.col("coverage") * 100.0).alias("coverage_pct"))
              .withColumn("well_covered", F.col("coverage_pct") >= 95))


@query("gap_counts", f"""
WITH {S.OBS}, g AS (SELECT (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER w)) / 3.6e9 AS gap_hours
                    FROM obs WINDOW w AS {S.W}),
c AS (SELECT gap_hours, count(*) AS count FROM g WHERE gap_hours IS NOT NULL GROUP BY gap_hours),
t AS (SELECT gap_hours, count, count * 100.0 / sum(count) OVER () AS pct FROM c ORDER BY count DESC, gap_hours LIMIT 10)
{S.round_all(['gap_hours', 'pct'], ['count'])}""")
def q_gap_counts(spark, sf):
    g = AG.gap_counts(TB.obs_hourly(spark, sf))
    g = g.withColumn("pct", F.col("count") * 100.0 / g.select(F.sum("count")).scalar())
    return r6(g.orderBy(F.col("count").desc(), "gap_hours").limit(10))


@query("target_stats", f"""
WITH {S.FEAT}, {', '.join(f"t{h}a AS ({S.target_sql('feat', h)}), t{h} AS (SELECT * FROM (SELECT *, lead(timestamp, {h}) OVER w AS _t2 FROM t{h}a WHERE aqi_next_{h}h IS NOT NULL WINDOW w AS {S.W}) WHERE (epoch_us(_t2) - epoch_us(timestamp)) / 3.6e9 = {float(h)})" for h in (24, 48, 72))},
t AS ({' UNION ALL '.join(f"SELECT {h} AS horizon, count(aqi_next_{h}h) AS n, avg(aqi_next_{h}h) AS mean, stddev_samp(aqi_next_{h}h) AS std FROM t{h}" for h in (24, 48, 72))})
{S.round_all(['mean', 'std'], ['horizon', 'n'])}""")
def q_target_stats(spark, sf):
    feats = _features(spark, sf)
    out = None
    for h in (24, 48, 72):
        tgt = f"aqi_next_{h}h"
        tf = WN.exact_horizon_recheck(WN.build_training_frame(feats, h).filter(F.col(tgt).isNotNull()), h)
        s = tf.agg(F.lit(h).alias("horizon"), F.count(tgt).alias("n"), F.avg(tgt).alias("mean"),
                   F.stddev_samp(tgt).alias("std"))
        out = s if out is None else out.unionByName(s)
    return r6(out)


@query("sequence_scaler", f"""
WITH {S.FEAT}, tf AS ({S.target_sql('feat', 24)}),
t AS (SELECT {', '.join(f'CAST({c} AS FLOAT) AS f{i}' for i, c in enumerate(SEQ_FEATS))}, 
  count(*) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS n, aqi_next_24h AS y,
  row_number() OVER w AS rn FROM tf WINDOW w AS {S.W}),
-- every row counts once per sequence that holds it: a row at position p is in the sequences ending at p..p+23
seqs AS (SELECT series, timestamp FROM (SELECT series, timestamp,
  count(*) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS n, aqi_next_24h AS y FROM tf WINDOW w AS {S.W})
  WHERE n = 24 AND y IS NOT NULL),
cells AS (SELECT s.series, s.timestamp AS end_ts, tf.* EXCLUDE (series) FROM seqs s JOIN (
    SELECT *, row_number() OVER w AS rn FROM tf WINDOW w AS {S.W}) tf ON tf.series = s.series
    JOIN (SELECT series, timestamp, row_number() OVER w AS rn FROM tf WINDOW w AS {S.W}) e
      ON e.series = s.series AND e.timestamp = s.timestamp AND tf.rn BETWEEN e.rn - 23 AND e.rn),
u AS ({' UNION ALL '.join(f'SELECT {i} AS feature_index, CAST({c} AS FLOAT) AS v FROM cells' for i, c in enumerate(SEQ_FEATS))}),
a AS (SELECT feature_index, avg(v) AS mean, stddev_pop(v) AS sd FROM u GROUP BY feature_index)
SELECT feature_index, {S.r6('mean')} AS mean, {S.r6('CASE WHEN sd = 0 THEN 1.0 ELSE sd END')} AS scale FROM a""")
def q_sequence_scaler(spark, sf):
    tf = WN.build_training_frame(_features(spark, sf), 24)
    return r6(ST.sequence_scaler(tf, SEQ_FEATS, "aqi_next_24h", 24))


@query("sequence_scaler_halo", ORACLES["sequence_scaler"])
def q_sequence_scaler_halo(spark, sf):
    tf = WN.build_training_frame(_features(spark, sf), 24, strategy=SMALL_CHUNKS)
    return r6(ST.sequence_scaler(tf, SEQ_FEATS, "aqi_next_24h", 24, strategy=SMALL_CHUNKS))


# ---- M5: exploratory statistics ----------------------------------------------------------------

@query("corr_matrix", f"""
WITH {S.FEAT}, t AS ({' UNION ALL '.join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS corr FROM feat" for a in POLLUTANTS for b in POLLUTANTS)})
SELECT col_a, col_b, {S.r6('corr')} AS corr FROM t""")
def q_corr_matrix(spark, sf):
    return r6(ST.corr_matrix(_features(spark, sf), POLLUTANTS))


# Numeric columns of the feature table, in its order.
_NUMERIC = [c for c in S.FEAT_COLS_ORDER if c not in ("series", "timestamp")]


@query("corr_numeric", f"""
WITH {S.FEAT}, t AS ({' UNION ALL '.join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS corr FROM feat" for i, a in enumerate(_NUMERIC) for b in _NUMERIC[i:])})
SELECT col_a, col_b, {S.r6('CASE WHEN isnan(corr) THEN NULL ELSE corr END')} AS corr FROM t""")
def q_corr_numeric(spark, sf):
    feats = _features(spark, sf)
    return r6(ST.corr_pairs(feats, numeric_columns(feats)))


@query("corr_ranked", f"""
WITH {S.FEAT}, t AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, corr(aqi, {c}) AS corr FROM feat" for c in POLLUTANTS[1:])})
SELECT feature, {S.r6('corr')} AS corr FROM t ORDER BY abs(corr) DESC, feature LIMIT 5""")
def q_corr_ranked(spark, sf):
    c = ST.corr_with(_features(spark, sf), "aqi", POLLUTANTS)
    return r6(c.orderBy(F.abs("corr").desc(), "feature").limit(5))


@query("corr_lags", f"""
WITH {S.FEAT}, t AS ({' UNION ALL '.join(f"SELECT series, '{c}' AS feature, corr(aqi, {c}) AS corr FROM feat GROUP BY series" for c in LAG_COLUMNS + ROLLING_COLUMNS + ['pm25'])})
SELECT series, feature, {S.r6('corr')} AS corr FROM t""")
def q_corr_lags(spark, sf):
    return r6(ST.corr_with(_features(spark, sf), "aqi", LAG_COLUMNS + ROLLING_COLUMNS + ["pm25"], series="series"))


@query("histogram", f"""
WITH {S.FEAT}, r AS (SELECT series, min(aqi) AS lo, max(aqi) AS hi FROM feat GROUP BY series),
c AS (SELECT f.series, CAST(CASE WHEN hi > lo THEN least(floor((aqi - lo) * 50 / (hi - lo)), 49) ELSE 0 END AS INTEGER) AS bin,
      count(*) AS cnt FROM feat f JOIN r USING (series) WHERE aqi IS NOT NULL GROUP BY 1, 2),
g AS (SELECT series, lo, hi, CAST(b AS INTEGER) AS bin FROM r, range(50) t(b))
SELECT g.series, g.bin, {S.r6('lo + g.bin * ((hi - lo) / 50)')} AS bin_lo, {S.r6('lo + (g.bin + 1) * ((hi - lo) / 50)')} AS bin_hi,
       COALESCE(c.cnt, 0) AS count
FROM g LEFT JOIN c ON c.series = g.series AND c.bin = g.bin""")
def q_histogram(spark, sf):
    return r6(ST.histogram(_features(spark, sf), "aqi", 50))


@query("kde", f"""
WITH {S.FEAT}, p0 AS (SELECT series, count(aqi) AS n, stddev_samp(aqi) AS sd, min(aqi) AS lo, max(aqi) AS hi FROM feat GROUP BY series),
p AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) AS h FROM p0),
p2 AS (SELECT *, lo - 3.0 * h AS g0, (hi - lo + 2 * 3.0 * h) / 199 AS gs FROM p),
s AS (SELECT p2.series, CAST(t.gi AS INTEGER) AS gi, sum(exp(-0.5 * ((g0 + t.gi * gs - f.aqi) / h) * ((g0 + t.gi * gs - f.aqi) / h))) AS s
      FROM feat f JOIN p2 USING (series), range(200) t(gi) WHERE f.aqi IS NOT NULL GROUP BY 1, 2)
SELECT s.series, s.gi, {S.r6('g0 + gi * gs')} AS x, {S.r6('s / (n * h * sqrt(2 * pi()))')} AS density
FROM s JOIN p2 USING (series)""")
def q_kde(spark, sf):
    return r6(ST.kde(_features(spark, sf), "aqi"))


@query("boxplot", f"""
WITH {S.FEAT}, q AS (SELECT series, quantile_cont(aqi, 0.25) AS q1, quantile_cont(aqi, 0.5) AS median,
                              quantile_cont(aqi, 0.75) AS q3 FROM feat GROUP BY series)
SELECT series, {S.r6('q1')} AS q1, {S.r6('median')} AS median, {S.r6('q3')} AS q3, {S.r6('q3 - q1')} AS iqr,
  {S.r6('min(CASE WHEN aqi >= q1 - 1.5 * (q3 - q1) THEN aqi END)')} AS whisker_lo,
  {S.r6('max(CASE WHEN aqi <= q3 + 1.5 * (q3 - q1) THEN aqi END)')} AS whisker_hi,
  count(*) FILTER (WHERE aqi < q1 - 1.5 * (q3 - q1) OR aqi > q3 + 1.5 * (q3 - q1)) AS n_fliers
FROM feat JOIN q USING (series) WHERE aqi IS NOT NULL GROUP BY series, q1, median, q3""")
def q_boxplot(spark, sf):
    return r6(ST.boxplot_stats(_features(spark, sf), "aqi"))


_M = "CASE WHEN i = 1 THEN 1.0 - pow(0.5, 1.0 / n) WHEN i = n THEN pow(0.5, 1.0 / n) ELSE (i - 0.3175) / (n + 0.365) END"


@query("qq_fit", f"""
WITH {S.FEAT}, r AS (SELECT series, aqi AS x, row_number() OVER (PARTITION BY series ORDER BY aqi) AS i,
                            count(*) OVER (PARTITION BY series) AS n FROM feat WHERE aqi IS NOT NULL),
m AS (SELECT *, {_M} AS m FROM r),
o AS (SELECT *, {ST.inv_norm_sql('m')} AS osm FROM m)
SELECT series, count(*) AS n, {S.r6('regr_slope(x, osm)')} AS slope, {S.r6('regr_intercept(x, osm)')} AS intercept,
       {S.r6('corr(osm, x)')} AS r, {S.r6('corr(osm, x) * corr(osm, x)')} AS r2
FROM o GROUP BY series""")
def q_qq_fit(spark, sf):
    return r6(ST.qq_fit(_features(spark, sf), "aqi"))


@query("rolling_band", f"""
WITH {S.FEAT}, t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY timestamp DESC) AS rk FROM feat) WHERE rk <= 500)
SELECT series, timestamp, {S.r6('aqi')} AS aqi, {S.r6('rolling_mean_24h')} AS rolling_mean_24h,
  {S.r6('rolling_mean_24h - rolling_std_24h')} AS lower, {S.r6('rolling_mean_24h + rolling_std_24h')} AS upper FROM t""")
def q_rolling_band(spark, sf):
    t = O.latest_n(_features(spark, sf), 500)
    return r6(ST.rolling_band(t).select("series", "timestamp", "aqi", "rolling_mean_24h", "lower", "upper"))


@query("hour_band", f"""
WITH {LOCAL}, p AS (SELECT series, CAST(hour(lt) AS BIGINT) AS local_hour, avg(aqi) AS mean, stddev_samp(aqi) AS std
                    FROM l GROUP BY 1, 2)
SELECT series, local_hour, {S.r6('mean')} AS mean, {S.r6('std')} AS std, {S.r6('mean - std')} AS lower,
       {S.r6('mean + std')} AS upper FROM p""")
def q_hour_band(spark, sf):
    return r6(ST.mean_std_band(AG.profile(_features(spark, sf), "local_hour", std=True)))


# ---- M6/M7: models, metrics, scoring, explanations ---------------------------------------------
from hourcast.operators import linear as LN  # noqa: E402
from hourcast.operators import ml as ML  # noqa: E402
from hourcast.schema import FEATURE_COLUMNS  # noqa: E402

BASELINES = [("persistence", "aqi"), ("rolling_mean_24h", "rolling_mean_24h"), ("rolling_mean_6h", "rolling_mean_6h")]


def _baseline_preds(spark, sf, horizons=(24,)):
    feats = _features(spark, sf)
    out = None
    for h in horizons:
        tf = WN.build_training_frame(feats, h)
        for name, c in BASELINES:
            p = tf.select(F.lit(h).alias("horizon"), F.lit(name).alias("model"), F.col(f"aqi_next_{h}h").alias("y"),
                          F.col(c).alias("prediction")).filter(F.col("prediction").isNotNull())
            out = p if out is None else out.unionByName(p)
    return out


def _baseline_sql(horizons=(24,)):
    ctes = ", ".join(f"tf{h} AS ({S.target_sql('feat', h)})" for h in horizons)
    parts = [f"SELECT {h} AS horizon, '{n}' AS model, aqi_next_{h}h AS y, {c} AS prediction FROM tf{h} WHERE {c} IS NOT NULL"
             for h in horizons for n, c in BASELINES]
    return f"{S.FEAT}, {ctes}, preds AS ({' UNION ALL '.join(parts)})"


_MET = f"""{S.rounded('sqrt(avg((y - prediction) * (y - prediction)))', 4)} AS rmse,
  {S.rounded('avg(abs(y - prediction))', 4)} AS mae,
  {S.rounded('1.0 - sum((y - prediction) * (y - prediction)) / (var_pop(y) * count(y))', 4)} AS r2"""


@query("metrics", f"""
WITH {_baseline_sql()}, t AS (SELECT model, {_MET} FROM preds GROUP BY model)
{S.round_all(['rmse', 'mae', 'r2'], ['model'])}""")
def q_metrics(spark, sf):
    return r6(ML.regression_metrics(_baseline_preds(spark, sf), ["model"], "y", "prediction"))


@query("best_model", f"""
WITH {_baseline_sql((24, 48, 72))}, m AS (SELECT horizon, model, {_MET} FROM preds GROUP BY horizon, model),
t AS (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY rmse, model) AS rk FROM m)
SELECT horizon, model, {S.r6('rmse')} AS rmse, {S.r6('mae')} AS mae, {S.r6('r2')} AS r2 FROM t WHERE rk = 1""")
def q_best_model(spark, sf):
    m = ML.regression_metrics(_baseline_preds(spark, sf, (24, 48, 72)), ["horizon", "model"], "y", "prediction")
    return r6(ML.best_model(m, ("horizon",)))


def _metadata_frame(spark, sf):
    m = ML.regression_metrics(_baseline_preds(spark, sf, (24, 48, 72)), ["horizon", "model"], "y", "prediction")
    best = ML.best_model(m, ("horizon",)).select("horizon", F.col("model").alias("model_name"),
                                                F.struct("rmse", "mae", "r2").alias("metrics"))
    entries = m.groupBy("horizon").agg(F.array_sort(F.collect_list(
        F.struct(F.col("model").alias("key"), F.struct("rmse", "mae", "r2").alias("value")))).alias("_e"))
    return (entries.join(best, "horizon")
            .select(F.col("horizon").cast("int").alias("horizon_hours"), "model_name", "metrics",
                    F.map_from_entries("_e").alias("all_model_metrics")))


@query("comparison_table", f"""
WITH {_baseline_sql((24, 48, 72))}, m AS (SELECT horizon, model, {_MET} FROM preds GROUP BY horizon, model),
t AS (SELECT CAST(horizon AS INTEGER) AS horizon_hours, model, upper(replace(model, '_', ' ')) AS label, rmse, mae, r2,
  CAST(4 + row_number() OVER (PARTITION BY horizon ORDER BY model) AS INTEGER) AS display_order FROM m)
{S.round_all(['rmse', 'mae', 'r2'], ['horizon_hours', 'model', 'label', 'display_order'])}""")
def q_comparison_table(spark, sf):
    return r6(ML.comparison_frame(_metadata_frame(spark, sf)))


@query("comparison_display", f"""
WITH {_baseline_sql((24, 48, 72))}, m AS (SELECT horizon, model, {_MET} FROM preds GROUP BY horizon, model)
SELECT CAST(horizon AS INTEGER) AS horizon_hours, upper(replace(model, '_', ' ')) AS model, {S.r6('rmse')} AS "RMSE",
  {S.r6('mae')} AS "MAE", {S.r6('r2')} AS "R²" FROM m""")
def q_comparison_display(spark, sf):
    return r6(ML.display_names(ML.comparison_frame(_metadata_frame(spark, sf))))


@query("ridge_one_feature", f"""
WITH {S.FEAT}, tf AS ({S.target_sql('feat', 24)}),
s AS (SELECT avg(aqi) AS mx, avg(aqi_next_24h) AS my FROM tf),
c AS (SELECT sum((aqi - mx) * (aqi_next_24h - my)) AS sxy, sum((aqi - mx) * (aqi - mx)) AS sxx, any_value(mx) AS mx,
             any_value(my) AS my FROM tf, s)
SELECT {S.r6('sxy / (sxx + 1.0)')} AS coef, {S.r6('my - sxy / (sxx + 1.0) * mx')} AS intercept FROM c""")
def q_ridge_one_feature(spark, sf):
    tf = WN.build_training_frame(_features(spark, sf), 24).cache()
    if tf.isEmpty():  # no exact-horizon rows (tiny inputs): the closed form is NULL as well
        tf.unpersist()
        return spark.createDataFrame([(None, None)], "coef double, intercept double")
    model = ML.fit_ridge(tf, ["aqi"], "aqi_next_24h", alpha=1.0)
    tf.unpersist()
    return r6(spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "coef double, intercept double"))


def _backfilled(spark, sf):
    return build_backfill_dataset(TB.air_hourly(spark, sf), TB.weather_hourly(spark, sf), TB.forecast_hourly(spark, sf))


# Rounds of the boosted candidate in the registered query: a round is six sequential jobs
# (the library's default is 300).
QUERY_ROUNDS = 20


def _train(spark, sf, candidates):
    from hourcast.plans.training import train_all
    params = {"random_forest": {"memory_mb": 32}, "xgboost": {"rounds": QUERY_ROUNDS}}
    return train_all(_backfilled(spark, sf), candidates=candidates, params=params, registry_root=SJ.run_dir(spark, "registry"), skip_empty=True)


@query("train_models")
def q_train_models(spark, sf):
    """Three horizons, all tabular candidates, the choice published and read back."""
    t = _train(spark, sf, ("random_forest", "ridge", "xgboost"))
    chosen = [(h, ML.load_model(spark, t.registry_root, h)[1]["model_name"]) for h in t.best]
    chosen = spark.createDataFrame(chosen, "horizon int, chosen string")
    return r6(t.metrics.join(chosen, "horizon").withColumn("chosen", F.col("chosen") == F.col("model")))


_BACKFILLED_SQL = f"""{S.FEAT}, {S.FORECAST}, base AS (SELECT * FROM feat),
j AS ({_fc_join}),
fw AS (SELECT series, timestamp, {_fc_sel} FROM j GROUP BY series, timestamp),
withfc AS (SELECT feat.*, fw.* EXCLUDE (series, timestamp) FROM feat JOIN fw USING (series, timestamp)),
bf AS ({S.backfill_sql('withfc')})"""
_TRAIN_SQL, _TRAIN_K = S.training_rows_sql((24, 48, 72))


@query("train_ridge", f"""
WITH RECURSIVE {_BACKFILLED_SQL}, {_TRAIN_SQL},
tr AS (SELECT * FROM lg WHERE split = 'train'), {S.ridge_sql('tr', _TRAIN_K)},
preds AS (SELECT h AS horizon, any_value(y) AS y, any_value(b) + sum(w * (v - m)) AS prediction
          FROM lg JOIN coef USING (h, i) WHERE split = 'test' GROUP BY h, r),
t AS (SELECT horizon, 'ridge' AS model, {_MET} FROM preds GROUP BY horizon)
{S.round_all(['rmse', 'mae', 'r2'], ['horizon', 'model'])}""")
def q_train_ridge(spark, sf):
    return r6(_train(spark, sf, ("ridge",)).metrics)


_PRED_SQL = f"""{S.OBS}, h AS (SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY timestamp DESC) AS rk FROM obs) WHERE rk <= 500 AND aqi IS NOT NULL),
f AS ({S.feat_cols('h')}),
pf AS (SELECT series, timestamp, {', '.join(f'COALESCE(last_value({c} IGNORE NULLS) OVER (PARTITION BY series ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS {c}' for c in FEATURE_COLUMNS)} FROM f)"""


def _prediction_frame(spark, sf):
    obs = TB.obs_hourly(spark, sf)
    hist = O.latest_n_then_filter(obs, 500, F.col("aqi").isNotNull())
    return WN.prediction_frame(hist)


@query("prediction_frame", f"""
WITH {_PRED_SQL}, t AS (SELECT * FROM pf)
{S.round_all([c for c in FEATURE_DOUBLES if c in FEATURE_COLUMNS], FEATURE_OTHER, ['hours_since_prev'])}""")
def q_prediction_frame(spark, sf):
    return r6(_prediction_frame(spark, sf).select("series", "timestamp", *FEATURE_COLUMNS))


@query("local_proxy", f"""
WITH {_PRED_SQL}, bg AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY timestamp DESC) AS rk FROM pf),
st AS (SELECT series, {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in FEATURE_COLUMNS)} FROM bg GROUP BY series),
nw AS (SELECT * FROM bg WHERE rk = 1),
t AS ({' UNION ALL '.join(f"SELECT nw.series, '{c}' AS feature, (nw.{c} - m_{c}) / (CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 1.0 ELSE s_{c} END) * {1.0 / len(FEATURE_COLUMNS)!r} AS weight FROM nw JOIN st USING (series)" for c in FEATURE_COLUMNS)})
{S.round_all(['weight'], ['series', 'feature'])}""")
def q_local_proxy(spark, sf):
    return r6(ML.local_proxy(_prediction_frame(spark, sf), FEATURE_COLUMNS))


SCORING_FEATURES = ["aqi", "pm25", "pm10", "hour_sin", "hour_cos", "rolling_mean_24h"]

def _ridge_rows_sql(horizons, features):
    """CTEs of the ridge (alpha 1) of each horizon on its exact-horizon rows: ``coef``."""
    tfs = ", ".join(f"tf{h} AS ({S.target_sql('feat', h)})" for h in horizons)
    some = " AND ".join(f"{c} IS NOT NULL" for c in features)
    rows = " UNION ALL ".join(
        f"SELECT {h} AS h, row_number() OVER () AS r, aqi_next_{h}h AS y, [{', '.join(f'CAST({c} AS DOUBLE)' for c in features)}] AS x "
        f"FROM tf{h} WHERE aqi_next_{h}h IS NOT NULL AND {some}" for h in horizons)
    k = len(features)
    return f"""{tfs}, lg AS (SELECT h, r, y, unnest(range(1, {k + 1})) AS i, unnest(x) AS v FROM ({rows})),
{S.ridge_sql('lg', k)}"""


def _values_sql(features, src):
    """Rows of ``src`` as (series, timestamp, i, feature, x)."""
    names = ", ".join(f"'{c}'" for c in features)
    vals = ", ".join(f"CAST({c} AS DOUBLE)" for c in features)
    return (f"SELECT series, timestamp, unnest(range(1, {len(features) + 1})) AS i, unnest([{names}]) AS feature, unnest([{vals}]) AS x FROM {src}")


def _ridge_models(data, features, horizons=(24, 48, 72)):
    """Ridge of each horizon that has exact-horizon rows, from one pass over all of them."""
    rows = None
    for h in horizons:
        part = WN.build_training_frame(data, h).select(F.lit(h).alias("horizon"), *features, F.col(f"aqi_next_{h}h").alias("y")).dropna()
        rows = part if rows is None else rows.unionByName(part)
    sums = LN.moments(rows, features, "y", ["horizon"])
    return {h: LN.ridge(sums[h,]) for h in horizons if (h,) in sums}


def _linear_contrib(spark, sf, features):
    data = _features(spark, sf)
    models = _ridge_models(data, features, (24,))
    if not models:
        return spark.createDataFrame([], "series string, feature string, importance double")
    history = O.latest_n(data, 200).dropna(subset=features)
    return r6(ML.linear_contributions(history, features, models[24].coefficients))


def _linear_contrib_sql(features):
    some = " AND ".join(f"{c} IS NOT NULL" for c in features)
    return f"""
WITH RECURSIVE {S.FEAT}, {_ridge_rows_sql((24,), features)},
hist AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY timestamp DESC) AS rk FROM feat) WHERE rk <= 200 AND {some}),
l AS ({_values_sql(features, 'hist')}),
mx AS (SELECT series, i, avg(x) AS mean FROM l GROUP BY series, i)
SELECT series, feature, {S.r6('avg(abs(w * (x - mean)))')} AS importance
FROM l JOIN mx USING (series, i) JOIN coef USING (i) GROUP BY series, feature"""


@query("linear_contrib", _linear_contrib_sql(SCORING_FEATURES))
def q_linear_contrib(spark, sf):
    return _linear_contrib(spark, sf, SCORING_FEATURES)


@query("linear_contrib_one_feature", _linear_contrib_sql(["aqi"]))
def q_linear_contrib_one_feature(spark, sf):
    return _linear_contrib(spark, sf, ["aqi"])


def _batch_scoring(spark, sf, features):
    """Fit, save to a registry, load, align the newest row of the newest 500 to the trained list, score."""
    root = SJ.run_dir(spark, "registry")
    newest = O.latest_n(_prediction_frame(spark, sf), 1)
    out = None
    for h, fitted in _ridge_models(_features(spark, sf), features).items():
        ML.save_model(spark, fitted, root, h, ML.metadata_row("ridge", "linear", h, features, None, {}))
        model, meta = ML.load_model(spark, root, h)
        rows = align_columns(newest, meta["features"], keep=("series", "timestamp"))
        p = ML.predict(model, rows, meta["features"]).select("series", "timestamp", F.lit(h).alias("horizon"), "prediction")
        out = p if out is None else out.unionByName(p)
    if out is None:
        return spark.createDataFrame([], "series string, timestamp timestamp_ntz, horizon int, prediction double")
    return r6(out)


def _batch_scoring_sql(features):
    return f"""
WITH RECURSIVE {_PRED_SQL}, feat AS ({S.feat_cols('obs')}), {_ridge_rows_sql((24, 48, 72), features)},
nw AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY timestamp DESC) AS rk FROM pf) WHERE rk = 1),
l AS ({_values_sql(features, 'nw')})
SELECT series, timestamp, CAST(h AS INTEGER) AS horizon, {S.r6('any_value(b) + sum(w * (x - m))')} AS prediction
FROM l JOIN coef USING (i) GROUP BY series, timestamp, h"""


@query("batch_scoring", _batch_scoring_sql(SCORING_FEATURES))
def q_batch_scoring(spark, sf):
    return _batch_scoring(spark, sf, SCORING_FEATURES)


@query("batch_scoring_one_feature", _batch_scoring_sql(["aqi"]))
def q_batch_scoring_one_feature(spark, sf):
    return _batch_scoring(spark, sf, ["aqi"])


# ---- trees: one round of boosting, one tree of a forest, contributions along paths ----------------
STUMP_BINS = 16


def _scoring_rows(spark, sf, features=SCORING_FEATURES):
    return WN.build_training_frame(_features(spark, sf), 24).select("series", "timestamp", *features, F.col("aqi_next_24h").alias("y")).dropna()


def _scoring_rows_sql(features=SCORING_FEATURES):
    some = " AND ".join(f"{c} IS NOT NULL" for c in features)
    return f"""tf AS ({S.target_sql('feat', 24)}),
tr AS (SELECT *, aqi_next_24h AS y FROM tf WHERE aqi_next_24h IS NOT NULL AND {some}),
x AS (SELECT t.*, tr.y FROM ({_values_sql(features, 'tr')}) t JOIN tr USING (series, timestamp))"""


_CUTS = ", ".join(str(i / STUMP_BINS) for i in range(1, STUMP_BINS))
_STUMP_SQL = f"""{S.FEAT}, {_scoring_rows_sql()},
mean AS (SELECT avg(y) AS base, count(*) AS n FROM tr),
edges AS (SELECT DISTINCT i, feature, unnest(q) AS cut FROM (SELECT i, feature, quantile_disc(x, [{_CUTS}]) AS q FROM x GROUP BY i, feature)),
sums AS (SELECT e.i, e.feature, e.cut, sum(CASE WHEN x.x <= e.cut THEN base - y END) AS gl, count(CASE WHEN x.x <= e.cut THEN 1 END) AS hl,
           sum(CASE WHEN x.x > e.cut THEN base - y END) AS gr, count(CASE WHEN x.x > e.cut THEN 1 END) AS hr
         FROM edges e JOIN x USING (i), mean GROUP BY e.i, e.feature, e.cut),
gains AS (SELECT *, gl * gl / (hl + 1.0) + gr * gr / (hr + 1.0) AS gain FROM sums WHERE hl >= 1 AND hr >= 1),
best AS (SELECT *, -{ML.GBT_STEP} * gl / (hl + 1.0) AS vl, -{ML.GBT_STEP} * gr / (hr + 1.0) AS vr FROM gains
         WHERE gain >= (SELECT max(gain) * (1 - 1e-9) FROM gains) ORDER BY i, cut LIMIT 1)"""


def _stump(spark, sf):
    from hourcast.operators import boosting as B
    return B.fit_groups(_scoring_rows(spark, sf), SCORING_FEATURES, "y", rounds=1, step=ML.GBT_STEP, depth=1, bins=STUMP_BINS).get(())


@query("boosted_stump", f"""
WITH {_STUMP_SQL}
SELECT 0 AS node, feature, {S.r6('cut')} AS threshold, {S.r6('0.0')} AS value, CAST(n AS DOUBLE) AS cover FROM best, mean
UNION ALL SELECT 1, NULL, NULL, {S.r6('vl')}, CAST(hl AS DOUBLE) FROM best
UNION ALL SELECT 2, NULL, NULL, {S.r6('vr')}, CAST(hr AS DOUBLE) FROM best""")
def q_boosted_stump(spark, sf):
    """The node table of one boosting round of depth 1."""
    from hourcast.operators import boosting as B
    model = _stump(spark, sf)
    if model is None:
        return spark.createDataFrame([], "node int, feature string, threshold double, value double, cover double")
    return r6(B.nodes_frame(spark, model).select("node", "feature", "threshold", "value", "cover"))


@query("tree_contrib", f"""
WITH {_STUMP_SQL},
hist AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY timestamp DESC) AS rk FROM feat) WHERE rk <= 200
         AND {' AND '.join(f'{c} IS NOT NULL' for c in SCORING_FEATURES)}),
l AS ({_values_sql(SCORING_FEATURES, 'hist')})
SELECT series, l.feature, {S.r6('avg(CASE WHEN l.feature <> best.feature THEN 0.0 WHEN x <= cut THEN abs(vl) ELSE abs(vr) END)')} AS importance
FROM l, best GROUP BY series, l.feature""")
def q_tree_contrib(spark, sf):
    """Mean absolute path contribution of each feature over the newest 200 rows of a series."""
    from hourcast.operators import contributions as C
    model = _stump(spark, sf)
    if model is None:
        return spark.createDataFrame([], "series string, feature string, importance double")
    history = O.latest_n(_features(spark, sf), 200).dropna(subset=SCORING_FEATURES)
    return r6(C.tree_importance(history, model))


FOREST_FEATURES = ["hour_sin", "rolling_mean_24h"]


@query("forest_stump", f"""
WITH {S.FEAT}, {_scoring_rows_sql(FOREST_FEATURES)},
mean AS (SELECT avg(y) AS base, count(*) AS n FROM tr),
vals AS (SELECT DISTINCT i, feature, x FROM x),
cuts AS (SELECT i, feature, (x + lead(x) OVER (PARTITION BY i ORDER BY x)) / 2 AS cut FROM vals),
sums AS (SELECT c.i, c.feature, c.cut, avg(CASE WHEN x.x <= c.cut THEN y END) AS ml, count(CASE WHEN x.x <= c.cut THEN 1 END) AS hl,
           avg(CASE WHEN x.x > c.cut THEN y END) AS mr, count(CASE WHEN x.x > c.cut THEN 1 END) AS hr
         FROM cuts c JOIN x USING (i) WHERE c.cut IS NOT NULL GROUP BY c.i, c.feature, c.cut),
best AS (SELECT * FROM sums, mean ORDER BY hl * (ml - base) ** 2 + hr * (mr - base) ** 2 DESC LIMIT 1)
SELECT feature, {S.r6('cut')} AS threshold, {S.r6('base')} AS value, CAST(n AS DOUBLE) AS cover FROM best
UNION ALL SELECT NULL, NULL, {S.r6('ml')}, CAST(hl AS DOUBLE) FROM best
UNION ALL SELECT NULL, NULL, {S.r6('mr')}, CAST(hr AS DOUBLE) FROM best""")
def q_forest_stump(spark, sf):
    """The node table of a forest of one tree of depth 1 on all rows."""
    from hourcast.operators import contributions as C
    rows = _scoring_rows(spark, sf, FOREST_FEATURES).cache()
    try:
        if rows.isEmpty():
            return spark.createDataFrame([], "feature string, threshold double, value double, cover double")
        model = ML.fit_forest(rows, FOREST_FEATURES, "y", trees=1, depth=1, bootstrap=False, max_bins=1 << 14, memory_mb=32)
    finally:
        rows.unpersist()
    return r6(C.forest_nodes(model, FOREST_FEATURES).select("feature", "threshold", "value", "cover"))


# ---- M8: streaming ------------------------------------------------------------------------------
import os as _os  # noqa: E402

from hourcast.streaming import jobs as SJ  # noqa: E402


@query("stream_hourly", f"""
WITH {S.OBS}
{S.round_all(['aqi'] + MEASURES[1:], ['series', 'timestamp'], src='obs')}""")
def q_stream_hourly(spark, sf):
    return r6(SJ.run_hourly_aggregate(spark, _os.path.join(sf, "events.parquet")))


_STORED = [c for c in FEATURE_DOUBLES] + ["series", "timestamp", "hour_of_day", "day_of_week", "month"]


@query("stream_feature_append", f"""
WITH {S.OBS}, t AS ({S.feat_cols('obs')})
{S.round_all(FEATURE_DOUBLES, ['series', 'timestamp', 'hour_of_day', 'day_of_week', 'month'])}""")
def q_stream_feature_append(spark, sf):
    stored = SJ.run_feature_append(spark, TB.obs_hourly(spark, sf))
    return r6(stored.select(*_STORED))


# ---- remaining inventory: scans, alignment, strings, colours, trend, insights ---------------------
from hourcast.schema import align_columns  # noqa: E402

TRAIN_START = "2024-01-08 00:00:00"


@query("training_window", f"""
WITH {S.OBS}
SELECT series, timestamp, {S.r6('aqi')} AS aqi FROM obs WHERE timestamp >= TIMESTAMP '{TRAIN_START}' AND aqi IS NOT NULL""")
def q_training_window(spark, sf):
    obs = TB.obs_hourly(spark, sf, since=TRAIN_START).select("series", "timestamp", "aqi")
    return r6(obs.filter((F.col("timestamp") >= F.lit(TRAIN_START).cast("timestamp_ntz")) & F.col("aqi").isNotNull()))


@query("row_count", "SELECT count(*) AS cnt FROM events")
def q_row_count(spark, sf):
    return table(spark, sf, "events").agg(F.count(F.lit(1)).alias("cnt"))


@query("point_count", f"""
WITH {S.OBS}
SELECT count(*) AS cnt FROM obs WHERE timestamp = {AS_OF_HOUR}""")
def q_point_count(spark, sf):
    return TB.obs_hourly(spark, sf, AS_OF_FROM, AS_OF_UNTIL).agg(F.count(F.lit(1)).alias("cnt"))


_TRAINED = ["aqi", "pm25", "fc_co_24h", "aqi_lag_1h", "fc_dust_24h"]


@query("align_columns", f"""
WITH {S.FEAT}
SELECT series, timestamp, {S.r6('aqi')} AS aqi, {S.r6('pm25')} AS pm25, 0.0::DOUBLE AS fc_co_24h,
       {S.r6('aqi_lag_1h')} AS aqi_lag_1h, 0.0::DOUBLE AS fc_dust_24h FROM feat""")
def q_align_columns(spark, sf):
    return r6(align_columns(_features(spark, sf), _TRAINED, keep=("series", "timestamp")))


@query("bar_colors", f"""
WITH {LOCAL}, p AS (SELECT series, strftime(lt, '%Y-%m') AS local_period, strftime(lt, '%b %Y') AS month_name,
                           avg(aqi) AS mean FROM l GROUP BY 1, 2, 3)
SELECT series, local_period, month_name, {S.r6('mean')} AS mean,
  CASE WHEN mean <= 50 THEN '#22c55e' WHEN mean <= 100 THEN '#eab308' WHEN mean <= 150 THEN '#f97316' ELSE '#ef4444' END AS color
FROM p""")
def q_bar_colors(spark, sf):
    # fixed values: dashboard bar colours by AQI mean
    colors = ["#22c55e", "#eab308", "#f97316", "#ef4444"]
    p = AG.profile(TB.obs_hourly(spark, sf), "local_period")
    month = F.date_format(F.to_date("local_period", "yyyy-MM"), "MMM yyyy")
    return r6(p.withColumn("month_name", month).withColumn("color", A.threshold_label("mean", [50, 100, 150], colors)))


@query("metric_strings", f"""
WITH {_baseline_sql((24, 48, 72))}, m AS (SELECT horizon, model, {_MET} FROM preds GROUP BY horizon, model)
SELECT horizon, upper(replace(model, '_', ' ')) AS label, printf('%.4f', rmse) AS rmse, printf('%.4f', mae) AS mae,
       printf('%.4f', r2) AS r2 FROM m""")
def q_metric_strings(spark, sf):
    m = ML.regression_metrics(_baseline_preds(spark, sf, (24, 48, 72)), ["horizon", "model"], "y", "prediction")
    return m.select("horizon", F.upper(F.regexp_replace("model", "_", " ")).alias("label"),
                    ML.format_metric("rmse").alias("rmse"), ML.format_metric("mae").alias("mae"),
                    ML.format_metric("r2").alias("r2"))


@query("trend", f"""
WITH {S.OBS}, {S.FORECAST}, base AS (SELECT series, timestamp FROM obs WHERE timestamp = {AS_OF_HOUR}),
act AS (SELECT * FROM (SELECT series, timestamp, pm25, row_number() OVER (PARTITION BY series ORDER BY timestamp DESC) AS rk
        FROM obs WHERE timestamp <= {AS_OF_HOUR}) WHERE rk <= 72),
pred AS (SELECT b.series, b.timestamp + to_hours(h.horizon) AS timestamp, h.horizon,
   {S.aqi_sql('avg(f.fc_pm25)')} AS value
  FROM base b CROSS JOIN (VALUES (24, 0), (48, 24), (72, 48)) h(horizon, h0)
  JOIN fc f ON f.series = b.series AND f.timestamp >= b.timestamp + to_hours(h.h0)
       AND f.timestamp < b.timestamp + to_hours(h.h0 + 24)
  GROUP BY b.series, b.timestamp, h.horizon)
SELECT series, timestamp, timezone('{LOCAL_TZ}', timestamp AT TIME ZONE 'UTC') AS local_ts, 'actual' AS kind,
       CAST(NULL AS INTEGER) AS horizon, {S.r6(S.aqi_sql('pm25'))} AS value FROM act
UNION ALL
SELECT series, timestamp, timezone('{LOCAL_TZ}', timestamp AT TIME ZONE 'UTC') AS local_ts, 'forecast' AS kind,
       horizon, {S.r6('value')} AS value FROM pred""")
def q_trend(spark, sf):
    return _trend(spark, sf, TB.obs_hourly(spark, sf, until=AS_OF_UNTIL))


@query("trend_without_pm25", ORACLES["trend"])
def q_trend_without_pm25(spark, sf):
    return _trend(spark, sf, TB.obs_hourly(spark, sf, until=AS_OF_UNTIL).drop("pm25"))


def _trend(spark, sf, hist):
    from hourcast.plans.scoring import trend_frame
    win = J.forecast_windows(*_as_of_base(spark, sf), decimals=None)
    preds = win.select("series", "timestamp", F.explode(F.array(*[
        F.struct(F.lit(h).alias("horizon"), A.pm25_to_aqi(F.col(f"fc_pm25_{h}h")).alias("prediction"))
        for h in (24, 48, 72)])).alias("p")).select("series", "timestamp", "p.*").filter(F.col("prediction").isNotNull())
    return r6(trend_frame(hist, preds, 72))


@query("insights", f"""
WITH {LOCAL}, g AS (SELECT series, (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER w)) / 3.6e9 AS d FROM feat WINDOW w AS {S.W}),
gaps AS (SELECT series, count(*) FILTER (WHERE d IS NOT NULL AND d <> 1.0) AS total_gaps FROM g GROUP BY series),
hp AS (SELECT series, CAST(hour(lt) AS BIGINT) AS h, avg(aqi) AS m FROM l GROUP BY 1, 2),
hr AS (SELECT series, max(CASE WHEN top = 1 THEN h END) AS peak_hour, max(CASE WHEN bot = 1 THEN h END) AS clean_hour
       FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY m DESC, h) AS top,
                       row_number() OVER (PARTITION BY series ORDER BY m, h) AS bot FROM hp) GROUP BY series),
base AS (SELECT series, count(*) AS n, strftime(min(timestamp), '%b %d, %Y') AS date_min, strftime(max(timestamp), '%b %d, %Y') AS date_max,
       avg(aqi) AS mean, stddev_samp(aqi) AS std,
       avg(COALESCE(CAST(aqi <= 50 AS DOUBLE), 0.0)) * 100.0 AS good_pct,
       avg(COALESCE(CAST(aqi > 50 AND aqi <= 100 AS DOUBLE), 0.0)) * 100.0 AS moderate_pct,
       avg(COALESCE(CAST(aqi > 100 AS DOUBLE), 0.0)) * 100.0 AS unhealthy_pct, corr(aqi, pm25) AS pm25_corr
       FROM feat GROUP BY series)
SELECT b.series, n, date_min, date_max, {', '.join(S.r6(c) + ' AS ' + c for c in ['mean', 'std', 'good_pct', 'moderate_pct', 'unhealthy_pct', 'pm25_corr'])},
       peak_hour, clean_hour, total_gaps
FROM base b JOIN hr USING (series) JOIN gaps USING (series)""")
def q_insights(spark, sf):
    from hourcast.plans.insights import insight_rows
    return r6(insight_rows(_features(spark, sf)))


# ---- chunked variants of the positional operators against the oracles of the plain plans ----------

@query("ffill_halo", ORACLES["ffill"])
def q_ffill_halo(spark, sf):
    obs = TB.obs_hourly(spark, sf).select("series", "timestamp", "no2")
    sp = WN.chronological_split(obs, strategy=SMALL_CHUNKS)
    return r6(WN.forward_fill(sp, ["no2"], partition=("series", "split"), strategy=SMALL_CHUNKS))


@query("cumulative_gap_share_halo", ORACLES["cumulative_gap_share"])
def q_cumulative_gap_share_halo(spark, sf):
    return r6(WN.cumulative_gap_share(TB.obs_hourly(spark, sf).select("series", "timestamp"), strategy=SMALL_CHUNKS))


@query("sequences_halo", ORACLES["sequences"])
def q_sequences_halo(spark, sf):
    tf = WN.build_training_frame(_features(spark, sf), 24, strategy=SMALL_CHUNKS)
    return WN.sequences(tf, SEQ_FEATS, "aqi_next_24h", 24, strategy=SMALL_CHUNKS)


@query("shifted_backfill_halo", ORACLES["shifted_backfill"])
def q_shifted_backfill_halo(spark, sf):
    win = J.forecast_windows(_features(spark, sf), TB.forecast_hourly(spark, sf))
    return r6(WN.shifted_backfill(win, strategy=SMALL_CHUNKS))


@query("prediction_frame_halo", ORACLES["prediction_frame"])
def q_prediction_frame_halo(spark, sf):
    hist = O.latest_n_then_filter(TB.obs_hourly(spark, sf), 500, F.col("aqi").isNotNull())
    return r6(WN.prediction_frame(hist, strategy=SMALL_CHUNKS).select("series", "timestamp", *FEATURE_COLUMNS))


# ---- the plain plan, named (what the unsuffixed queries run by default) ---------------------------

@query("engineered_features_plain", ENGINEERED_SQL)
def q_engineered_features_plain(spark, sf):
    return r6(WN.add_engineered_features(TB.obs_hourly(spark, sf), strategy="plain"))


@query("ffill_plain", ORACLES["ffill"])
def q_ffill_plain(spark, sf):
    obs = TB.obs_hourly(spark, sf).select("series", "timestamp", "no2")
    sp = WN.chronological_split(obs, strategy="plain")
    return r6(WN.forward_fill(sp, ["no2"], partition=("series", "split"), strategy="plain"))


@query("cumulative_gap_share_plain", ORACLES["cumulative_gap_share"])
def q_cumulative_gap_share_plain(spark, sf):
    return r6(WN.cumulative_gap_share(TB.obs_hourly(spark, sf).select("series", "timestamp"), strategy="plain"))


@query("sequences_plain", ORACLES["sequences"])
def q_sequences_plain(spark, sf):
    tf = WN.build_training_frame(_features(spark, sf), 24, strategy="plain")
    return WN.sequences(tf, SEQ_FEATS, "aqi_next_24h", 24, strategy="plain")


# ---- SK2 bulk upsert, SM2 in-stream duplicate suppression ------------------------------------------
from hourcast.operators.sinks import append_new as _append_new, stored_rows as _stored_rows  # noqa: E402

_BACKFILL_COLS = None


@query("backfill_upsert", ORACLES["shifted_backfill"])
def q_backfill_upsert(spark, sf):
    from hourcast.session import reliable_checkpoint
    data = reliable_checkpoint(_backfilled(spark, sf))
    path = SJ.run_dir(spark, "backfill-table")
    _append_new(spark, data, path, drop=())
    # second delivery of the same history: nothing new is stored
    if _append_new(spark, data, path, drop=()) != 0:
        raise RuntimeError("bulk upsert stored a key twice")
    return r6(_stored_rows(spark, path).select(*data.columns))


@query("stream_hourly_dedupe", ORACLES["stream_hourly"])
def q_stream_hourly_dedupe(spark, sf):
    return r6(SJ.run_hourly_aggregate_redelivered(spark, _os.path.join(sf, "events.parquet")))


# ---- the same profiling operators over the larger order tables --------------------------------------
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lineitem_series(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(F.col("l_returnflag").alias("series"), F.col("l_shipdate").alias("timestamp"),
                     F.col("l_extendedprice").alias("value"))


@query("lineitem_profile_month", f"""
SELECT l_returnflag AS series, strftime(timezone('{LOCAL_TZ}', l_shipdate AT TIME ZONE 'UTC'), '%Y-%m') AS local_period,
       {S.r6('avg(l_extendedprice)')} AS mean, {S.r6('stddev_samp(l_extendedprice)')} AS std
FROM lineitem GROUP BY 1, 2""")
def q_lineitem_profile_month(spark, sf):
    return r6(AG.profile(_lineitem_series(spark, sf), "local_period", value="value", std=True))


def _li_describe_sql():
    parts = []
    for c in LI_NUM:
        def r3(e):
            return S.rounded(e, 3)
        parts.append(f"""SELECT '{c}' AS column, {r3(f'CAST(count({c}) AS DOUBLE)')} AS count, {r3(f'avg({c})')} AS mean,
  {r3(f'stddev_samp({c})')} AS std, {r3(f'min({c})')} AS min, {r3(f"quantile_cont({c}, 0.25)")} AS p25,
  {r3(f"quantile_cont({c}, 0.5)")} AS p50, {r3(f"quantile_cont({c}, 0.75)")} AS p75, {r3(f'max({c})')} AS max,
  {r3(S.rounded(f"stddev_samp({c}) / avg({c}) * 100.0", 1))} AS cv_pct FROM lineitem""")
    cols = ["count", "mean", "std", "min", "p25", "p50", "p75", "max", "cv_pct"]
    return f"WITH t AS ({' UNION ALL '.join(parts)})\n{S.round_all(cols, ['\"column\"'])}"


@query("lineitem_describe", _li_describe_sql())
def q_lineitem_describe(spark, sf):
    return r6(AG.describe(table(spark, sf, "lineitem"), LI_NUM))


@query("lineitem_corr", f"""
WITH t AS ({' UNION ALL '.join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS corr FROM lineitem" for a in LI_NUM for b in LI_NUM)})
SELECT col_a, col_b, {S.r6('corr')} AS corr FROM t""")
def q_lineitem_corr(spark, sf):
    return r6(ST.corr_matrix(table(spark, sf, "lineitem"), LI_NUM))


@query("lineitem_boxplot", f"""
WITH q AS (SELECT l_returnflag AS series, quantile_cont(l_extendedprice, 0.25) AS q1,
                  quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3
           FROM lineitem GROUP BY 1),
v AS (SELECT l_returnflag AS series, l_extendedprice AS x FROM lineitem WHERE l_extendedprice IS NOT NULL)
SELECT series, {S.r6('q1')} AS q1, {S.r6('median')} AS median, {S.r6('q3')} AS q3, {S.r6('q3 - q1')} AS iqr,
  {S.r6('min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END)')} AS whisker_lo,
  {S.r6('max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END)')} AS whisker_hi,
  count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS n_fliers
FROM v JOIN q USING (series) GROUP BY series, q1, median, q3""")
def q_lineitem_boxplot(spark, sf):
    return r6(ST.boxplot_stats(_lineitem_series(spark, sf), "value"))


@query("orders_daily", f"""
SELECT o_orderstatus AS series, CAST(timezone('{LOCAL_TZ}', o_orderdate AT TIME ZONE 'UTC') AS DATE) AS local_date,
       {S.r6('avg(o_totalprice)')} AS mean
FROM orders GROUP BY 1, 2 HAVING avg(o_totalprice) IS NOT NULL""")
def q_orders_daily(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("series"),
                                          F.col("o_orderdate").alias("timestamp"), "o_totalprice")
    return r6(AG.daily_resample(o, value="o_totalprice"))


_K = len(SCORING_FEATURES)


@query("local_surrogate", f"""
WITH RECURSIVE {_PRED_SQL}, feat AS ({S.feat_cols('obs')}), {_ridge_rows_sql((24,), SCORING_FEATURES)},
l AS ({_values_sql(SCORING_FEATURES, 'pf')}),
st AS (SELECT series, i, feature, avg(x) AS mx, CASE WHEN COALESCE(stddev_samp(x), 0) = 0 THEN 1.0 ELSE stddev_samp(x) END AS sx,
         arg_max(x, timestamp) AS x0 FROM l GROUP BY series, i, feature),
dr AS (SELECT series, i, feature, mx, sx, x0, sample, {S.draw_sql('series', 'sample', 'feature', str(ML.SURROGATE_SEED))} AS u
       FROM (SELECT *, unnest(range(0, {ML.SURROGATE_SAMPLES + 1})) AS sample FROM st)),
zs AS (SELECT *, CASE WHEN sample = 0 THEN (x0 - mx) / sx ELSE {ST.inv_norm_sql('u')} END AS z FROM dr),
sm AS (SELECT series, sample, sqrt(exp(-sum((z - (x0 - mx) / sx) ** 2) / {(ML.SURROGATE_KERNEL * _K ** 0.5) ** 2!r})) AS kw,
         any_value(b) + sum(w * (mx + z * sx - m)) AS y FROM zs JOIN coef USING (i) GROUP BY series, sample),
wm AS (SELECT series, i, sum(kw * z) / sum(kw) AS zm FROM zs JOIN sm USING (series, sample) GROUP BY series, i),
wy AS (SELECT series, sum(kw * y) / sum(kw) AS ym FROM sm GROUP BY series),
cz AS (SELECT series, sample, i, z - zm AS z, y - ym AS y, kw FROM zs JOIN sm USING (series, sample) JOIN wm USING (series, i) JOIN wy USING (series)),
sys2 AS (SELECT a.series AS h, a.i, b.i AS j, sum(a.kw * a.z * b.z) + CASE WHEN a.i = b.i THEN {ML.SURROGATE_RIDGE_ALPHA} ELSE 0.0 END AS v
         FROM cz a JOIN cz b USING (series, sample) GROUP BY a.series, a.i, b.i
  UNION ALL SELECT series, i, {_K + 1}, sum(kw * z * y) FROM cz GROUP BY series, i),
{S.solve_sql('sys2', _K, 'gj2')}
SELECT series, feature, {S.r6('v')} AS weight FROM gj2 JOIN st ON st.series = gj2.h AND st.i = gj2.i WHERE p = {_K} AND j = {_K + 1}""")
def q_local_surrogate(spark, sf):
    data = _features(spark, sf)
    models = _ridge_models(data, SCORING_FEATURES, (24,))
    if not models:
        return spark.createDataFrame([], "series string, feature string, weight double")
    return r6(ML.local_surrogate(models[24], _prediction_frame(spark, sf), SCORING_FEATURES))


# ---- remaining dashboard / notebook pieces ----------------------------------------------------------

@query("gap_counts_over_1h", f"""
WITH {S.OBS}, g AS (SELECT (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER w)) / 3.6e9 AS gap_hours
                    FROM obs WINDOW w AS {S.W}),
c AS (SELECT gap_hours, count(*) AS count FROM g WHERE gap_hours > 1 GROUP BY gap_hours ORDER BY count DESC, gap_hours LIMIT 15)
SELECT {S.r6('gap_hours')} AS gap_hours, count FROM c""")
def q_gap_counts_over_1h(spark, sf):
    g = AG.gap_counts(TB.obs_hourly(spark, sf)).filter(F.col("gap_hours") > 1)
    return r6(g.orderBy(F.col("count").desc(), "gap_hours").limit(15).orderBy("gap_hours"))


_SCATTER = ["pm25", "pm10", "o3", "no2"]


@query("scatter_selection", f"""
WITH {S.FEAT}, t AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY timestamp DESC) AS rk FROM feat)
SELECT series, timestamp, {', '.join(S.r6(c) + ' AS ' + c for c in _SCATTER)} FROM t WHERE rk <= 1000""")
def q_scatter_selection(spark, sf):
    feats = _features(spark, sf)
    cols = [c for c in feats.columns if c not in ("series", "timestamp", "aqi")][:4]
    return r6(O.latest_n(feats, 1000).select("series", "timestamp", *cols))


@query("metric_classes", f"""
WITH {_baseline_sql((24, 48, 72))}, m AS (SELECT horizon, model, {_MET} FROM preds GROUP BY horizon, model)
SELECT horizon, model, {S.r6('rmse')} AS rmse, {S.r6('r2')} AS r2,
  CASE WHEN r2 IS NULL THEN '' WHEN r2 >= 0.35 THEN 'metric-good' WHEN r2 >= 0.10 THEN 'metric-mid' ELSE 'metric-bad' END AS r2_class,
  CASE WHEN rmse IS NULL THEN '' WHEN rmse <= 12 THEN 'metric-good' WHEN rmse <= 18 THEN 'metric-mid' ELSE 'metric-bad' END AS rmse_class
FROM m""")
def q_metric_classes(spark, sf):
    m = ML.regression_metrics(_baseline_preds(spark, sf, (24, 48, 72)), ["horizon", "model"], "y", "prediction")
    return r6(ML.quality_classes(m.select("horizon", "model", "rmse", "r2")))


@query("forecast_cards", f"""
WITH {S.OBS}, {S.FORECAST}, base AS (SELECT series, timestamp FROM obs WHERE timestamp = {AS_OF_HOUR}),
pred AS (
  SELECT b.series, h.horizon, {S.aqi_sql('avg(f.fc_pm25)')} AS prediction
  FROM base b CROSS JOIN (VALUES (24, 0), (48, 24), (72, 48)) h(horizon, h0)
  JOIN fc f ON f.series = b.series AND f.timestamp >= b.timestamp + to_hours(h.h0)
       AND f.timestamp < b.timestamp + to_hours(h.h0 + 24)
  GROUP BY b.series, h.horizon)
SELECT series, horizon, {S.r6('prediction')} AS prediction, {S.category_sql('prediction', 0)} AS category,
  {S.category_sql('prediction', 1)} AS color,
  CASE horizon WHEN 24 THEN 'High confidence' WHEN 48 THEN 'Medium confidence' WHEN 72 THEN 'Indicative only' END AS confidence,
  CASE horizon WHEN 24 THEN 90 WHEN 48 THEN 65 WHEN 72 THEN 35 END AS confidence_pct
FROM pred""")
def q_forecast_cards(spark, sf):
    win = J.forecast_windows(*_as_of_base(spark, sf), decimals=None)
    preds = win.select("series", F.explode(F.array(*[
        F.struct(F.lit(h).alias("horizon"), A.pm25_to_aqi(F.col(f"fc_pm25_{h}h")).alias("prediction"))
        for h in (24, 48, 72)])).alias("p")).select("series", "p.*").filter(F.col("prediction").isNotNull())
    cards = preds.withColumns({"category": A.aqi_category("prediction"), "color": A.aqi_color("prediction"),
                               **ML.confidence_columns("horizon")})
    return r6(cards)


# ---- the gap-free all-events series ----------------------------------------------------------------

def _all_features(spark, sf):
    return WN.add_engineered_features(TB.all_hourly(spark, sf))


for _h in (24, 48, 72):
    def _mk_all(h):
        def q(spark, sf):
            return r6(WN.build_training_frame(_all_features(spark, sf), h))
        return q
    query(f"target_all_{_h}h", f"""
WITH {S.ALL_OBS}, feat AS ({S.feat_cols('allobs')}), t AS ({S.target_sql('feat', _h)})
{S.round_all(FEATURE_DOUBLES + [f'aqi_next_{_h}h'], FEATURE_OTHER, ['hours_since_prev'])}""")(_mk_all(_h))


@query("histogram_all", f"""
WITH {S.ALL_OBS}, r AS (SELECT series, min(aqi) AS lo, max(aqi) AS hi FROM allobs GROUP BY series),
c AS (SELECT f.series, CAST(CASE WHEN hi > lo THEN least(floor((aqi - lo) * 40 / (hi - lo)), 39) ELSE 0 END AS INTEGER) AS bin,
      count(*) AS cnt FROM allobs f JOIN r USING (series) WHERE aqi IS NOT NULL GROUP BY 1, 2),
g AS (SELECT series, lo, hi, CAST(b AS INTEGER) AS bin FROM r, range(40) t(b))
SELECT g.series, g.bin, {S.r6('lo + g.bin * ((hi - lo) / 40)')} AS bin_lo, {S.r6('lo + (g.bin + 1) * ((hi - lo) / 40)')} AS bin_hi,
       COALESCE(c.cnt, 0) AS count
FROM g LEFT JOIN c ON c.series = g.series AND c.bin = g.bin""")
def q_histogram_all(spark, sf):
    return r6(ST.histogram(TB.all_hourly(spark, sf), "aqi", 40))


@query("landed_history_scan", f"""
WITH {S.OBS}
SELECT series, timestamp, {', '.join(S.r6(c) + ' AS ' + c for c in ['pm25', 'pm10', 'co', 'no2', 'so2', 'o3'])}
FROM obs WHERE timestamp >= TIMESTAMP '2024-01-05 00:00:00' AND timestamp < TIMESTAMP '2024-01-12 00:00:00'""")
def q_landed_history_scan(spark, sf):
    path = _os.path.join(SJ.run_dir(spark, "landed-air"), "landing")
    P.land_payloads(TB.obs_hourly(spark, sf), P.AIR_FIELDS, path)
    return r6(P.read_landed(spark, path, P.AIR_FIELDS, "2024-01-05", "2024-01-11"))


@query("landed_weather_scan", f"""
WITH {S.OBS}
SELECT series, timestamp, {', '.join(S.r6(c) + ' AS ' + c for c in ['temperature', 'humidity', 'wind_speed'])}
FROM obs WHERE timestamp >= TIMESTAMP '2024-01-05 00:00:00' AND timestamp < TIMESTAMP '2024-01-12 00:00:00'""")
def q_landed_weather_scan(spark, sf):
    path = _os.path.join(SJ.run_dir(spark, "landed-weather"), "landing")
    P.land_payloads(TB.obs_hourly(spark, sf), P.WEATHER_FIELDS, path)
    return r6(P.read_landed(spark, path, P.WEATHER_FIELDS, "2024-01-05", "2024-01-11"))


def _permuted_sql(i):
    """RMSE with feature i permuted (one bucket: up to PERMUTATION_BUCKET_ROWS rows)."""
    seed, c = str(42 + i), SCORING_FEATURES[i]
    return f"""SELECT '{c}' AS feature, sqrt(avg((y - (pred + w * (pv - {c}))) ** 2)) AS e FROM
    (SELECT *, row_number() OVER (ORDER BY {S.draw_sql('series', 'timestamp', seed, "'rows'")}) AS k FROM scored) a
    JOIN (SELECT {c} AS pv, row_number() OVER (ORDER BY {S.draw_sql('series', 'timestamp', seed, "'values'")}) AS k FROM scored) b USING (k),
    (SELECT w FROM coef WHERE i = {i + 1})"""


@query("permutation_importance", f"""
WITH RECURSIVE {S.FEAT}, {_ridge_rows_sql((24,), SCORING_FEATURES)},
tr AS (SELECT * FROM tf24 WHERE aqi_next_24h IS NOT NULL AND {' AND '.join(f'{c} IS NOT NULL' for c in SCORING_FEATURES)}),
pr AS (SELECT series, timestamp, any_value(b) + sum(w * (x - m)) AS pred FROM ({_values_sql(SCORING_FEATURES, 'tr')}) JOIN coef USING (i)
       GROUP BY series, timestamp),
scored AS (SELECT tr.*, aqi_next_24h AS y, pred FROM tr JOIN pr USING (series, timestamp)),
ref AS (SELECT sqrt(avg((y - pred) ** 2)) AS r FROM scored)
SELECT feature, {S.r6('e - r')} AS importance FROM ({' UNION ALL '.join(_permuted_sql(i) for i in range(_K))}), ref""")
def q_permutation_importance(spark, sf):
    tf = _scoring_rows(spark, sf)
    models = _ridge_models(_features(spark, sf), SCORING_FEATURES, (24,))
    if not models:
        return spark.createDataFrame([], "feature string, importance double")
    return r6(ML.permutation_importance(models[24], tf, SCORING_FEATURES, "y", key=("series", "timestamp")))
