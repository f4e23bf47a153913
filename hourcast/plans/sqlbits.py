"""SQL text shared by the oracle queries (DuckDB dialect), generated from the
same fixed values the Spark expressions use."""

from __future__ import annotations

from hourcast.functions.aqi import (AQI_CATEGORIES, AQI_TOP_CATEGORY, PM25_ABOVE_SCALE, PM25_BANDS_CONTINUOUS,
                                    PM25_BANDS_ROUNDED, PM25_OUT_OF_BAND)


def dbl(v: float) -> str:
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def aqi_sql(x: str) -> str:
    parts = [f"CASE WHEN {x} IS NULL THEN CAST(NULL AS DOUBLE) WHEN {x} < 0 THEN 0.0::DOUBLE"]
    for lo, hi, ilo, ihi in PM25_BANDS_CONTINUOUS:
        parts.append(f"WHEN {x} <= {dbl(hi)} THEN {dbl((ihi - ilo) / (hi - lo))} * ({x} - {dbl(lo)}) + {dbl(ilo)}")
    parts.append(f"ELSE {dbl(PM25_ABOVE_SCALE)} END")
    return " ".join(parts)


def aqi_rounded_sql(x: str) -> str:
    parts = [f"CASE WHEN {x} IS NULL THEN CAST(NULL AS DOUBLE)"]
    for lo, hi, ilo, ihi in PM25_BANDS_ROUNDED:
        line = f"{dbl((ihi - ilo) / (hi - lo))} * ({x} - {dbl(lo)}) + {dbl(ilo)}"
        parts.append(f"WHEN {x} >= {dbl(lo)} AND {x} <= {dbl(hi)} THEN round_even({line}, 0)")
    parts.append(f"ELSE {dbl(PM25_OUT_OF_BAND)} END")
    return " ".join(parts)


def category_sql(x: str, pick: int = 0) -> str:
    whens = " ".join(f"WHEN {x} <= {b} THEN '{(n, c)[pick]}'" for b, n, c in AQI_CATEGORIES)
    return f"CASE {whens} ELSE '{AQI_TOP_CATEGORY[pick]}' END"


def rounded(expr: str, places: int) -> str:
    """Tie-stable rounding (see hourcast.functions.numeric.round_stable)."""
    return f"round(({expr}) + sign({expr}) * least(abs({expr}) * 1e-12, 1e-{places + 3}), {places})"


def r6(expr: str) -> str:
    return f"({rounded(expr, 6)} + 0.0)"


def r6f(expr: str) -> str:
    return f"CAST({rounded(expr, 6)} + 0.0 AS FLOAT)"


EV = """ev AS (
  SELECT event_type AS series, date_trunc('hour', ts) AS timestamp, value, user_id,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events)"""

AIR_AGGS = """avg(value) AS pm25, max(value) AS pm10, avg(k) AS o3, stddev_samp(value) AS no2,
         sum(value) AS so2, min(value) AS co"""
WEATHER_AGGS = """avg(user_id) AS temperature, CAST(max(user_id) AS DOUBLE) AS humidity,
         CAST(count(*) AS DOUBLE) AS wind_speed"""

OBS = f"""{EV},
obs0 AS (
  SELECT series, timestamp, {AIR_AGGS}, {WEATHER_AGGS}
  FROM ev GROUP BY series, timestamp),
obs AS (
  SELECT series, timestamp, {aqi_sql('pm25')} AS aqi, pm25, pm10, o3, no2, so2, co,
         temperature, humidity, wind_speed
  FROM obs0)"""

ALL_OBS = f"""{EV},
allobs0 AS (
  SELECT 'all' AS series, timestamp, {AIR_AGGS}, {WEATHER_AGGS}
  FROM ev GROUP BY timestamp),
allobs AS (
  SELECT series, timestamp, {aqi_sql('pm25')} AS aqi, pm25, pm10, o3, no2, so2, co,
         temperature, humidity, wind_speed
  FROM allobs0)"""

FORECAST = """fc AS (
  SELECT series, timestamp, avg(value) AS fc_pm25, min(value) AS fc_co, stddev_samp(value) AS fc_no2,
         sum(value) AS fc_so2, avg(k) AS fc_o3, avg(user_id) AS fc_dust, CAST(count(*) AS DOUBLE) AS fc_uvi
  FROM (SELECT series, timestamp + INTERVAL 10 DAY AS timestamp, value, k, user_id FROM ev)
  GROUP BY series, timestamp)"""

W = "(PARTITION BY series ORDER BY timestamp)"

GAP = "COALESCE((epoch_us(timestamp) - epoch_us(lag(timestamp) OVER w)) / 3.6e9, 0.0)"


def feat_cols(src: str = "obs") -> str:
    """Engineered features over ``src`` with WINDOW w (without final rounding)."""
    return f"""SELECT *,
    CAST(hour(timestamp) AS BIGINT) AS hour_of_day,
    CAST(isodow(timestamp) - 1 AS BIGINT) AS day_of_week,
    CAST(month(timestamp) AS BIGINT) AS month,
    sin(2 * pi() * hour(timestamp) / 24.0) AS hour_sin,
    cos(2 * pi() * hour(timestamp) / 24.0) AS hour_cos,
    sin(2 * pi() * (isodow(timestamp) - 1) / 7.0) AS dow_sin,
    cos(2 * pi() * (isodow(timestamp) - 1) / 7.0) AS dow_cos,
    CAST({GAP} AS FLOAT) AS hours_since_prev,
    CAST({GAP} > 1.0 AS TINYINT) AS is_gap,
    lag(aqi, 1) OVER w AS aqi_lag_1h, lag(aqi, 3) OVER w AS aqi_lag_3h, lag(aqi, 6) OVER w AS aqi_lag_6h,
    lag(aqi, 12) OVER w AS aqi_lag_12h, lag(aqi, 24) OVER w AS aqi_lag_24h,
    avg(aqi) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS rolling_mean_6h,
    avg(aqi) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS rolling_mean_24h,
    stddev_samp(aqi) OVER (w ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS rolling_std_6h,
    stddev_samp(aqi) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS rolling_std_24h
  FROM {src} WINDOW w AS {W}"""


def round_all(cols_double, cols_other=(), cols_float=(), src="t") -> str:
    parts = list(cols_other) + [f"{r6(c)} AS {c}" for c in cols_double] + [f"{r6f(c)} AS {c}" for c in cols_float]
    return f"SELECT {', '.join(parts)} FROM {src}"

FEAT = f"""{OBS},
feat AS ({feat_cols('obs')})"""

FEAT_COLS_ORDER = ["series", "timestamp", "aqi", "pm25", "pm10", "o3", "no2", "so2", "co", "temperature",
                   "humidity", "wind_speed", "hour_of_day", "day_of_week", "month", "hour_sin", "hour_cos",
                   "dow_sin", "dow_cos", "hours_since_prev", "is_gap", "aqi_lag_1h", "aqi_lag_3h", "aqi_lag_6h",
                   "aqi_lag_12h", "aqi_lag_24h", "rolling_mean_6h", "rolling_mean_24h", "rolling_std_6h",
                   "rolling_std_24h"]


def fc_window_sql(base: str = "base", fc: str = "fc", cols=None, decimals: int = 4) -> str:
    """Oracle for the forecast range aggregate: explicit range join + conditional avg."""
    from hourcast.schema import FORECAST_COLUMNS, FORECAST_WINDOWS
    cols = cols or FORECAST_COLUMNS
    sel = []
    for label, h0, h1 in FORECAST_WINDOWS:
        for c in cols:
            cond = f"j_ts >= timestamp + INTERVAL {h0} HOUR AND j_ts < timestamp + INTERVAL {h1} HOUR"
            sel.append(f"{rounded(f'avg(CASE WHEN {cond} THEN j_{c} END)', decimals)} AS {c}_{label}")
    jcols = ", ".join(f"f.{c} AS j_{c}" for c in cols)
    return f"""SELECT b.*, f.timestamp AS j_ts, {jcols}
      FROM {base} b LEFT JOIN {fc} f ON f.series = b.series AND f.timestamp >= b.timestamp
        AND f.timestamp < b.timestamp + INTERVAL 72 HOUR""", ",\n  ".join(sel)


def target_sql(src: str, h: int) -> str:
    return f"""SELECT * EXCLUDE (_tt) FROM (
      SELECT *, lead(aqi, {h}) OVER w AS aqi_next_{h}h, lead(timestamp, {h}) OVER w AS _tt
      FROM {src} WINDOW w AS {W}) WHERE (epoch_us(_tt) - epoch_us(timestamp)) / 3.6e9 = {float(h)}"""


def backfill_sql(src: str) -> str:
    from hourcast.schema import SHIFT_BACKFILL_SOURCES, ZERO_BACKFILL_COLUMNS
    sets = []
    for label, h in (("24h", 24), ("48h", 48), ("72h", 72)):
        for fc, s in SHIFT_BACKFILL_SOURCES:
            sets.append(f"COALESCE({fc}_{label}, lead({s}, {h}) OVER w) AS {fc}_{label}")
        for fc in ZERO_BACKFILL_COLUMNS:
            sets.append(f"COALESCE({fc}_{label}, 0.0) AS {fc}_{label}")
    names = [s.rsplit(' AS ', 1)[1] for s in sets]
    return f"SELECT * EXCLUDE ({', '.join(names)}), {', '.join(sets)} FROM {src} WINDOW w AS {W}"


def solve_sql(system: str, k: int, out: str) -> str:
    """Recursive CTE ``out`` (p, h, i, j, v): Gauss-Jordan over the rows (h, i, j, v) of
    ``system``, i = 1 .. k, j = 1 .. k + 1; the solution stands at p = k, j = k + 1."""
    return f"""{out} AS (SELECT 0 AS p, h, i, j, CAST(v AS DOUBLE) AS v FROM {system}
  UNION ALL SELECT a.p + 1, a.h, a.i, a.j, CASE WHEN a.i = a.p + 1 THEN a.v / d.v ELSE a.v - c.v * r.v / d.v END
  FROM {out} a JOIN {out} r ON r.h = a.h AND r.i = a.p + 1 AND r.j = a.j JOIN {out} c ON c.h = a.h AND c.i = a.i AND c.j = a.p + 1
    JOIN {out} d ON d.h = a.h AND d.i = a.p + 1 AND d.j = a.p + 1
  WHERE a.p < {k})"""


def ridge_sql(rows: str, k: int, alpha: float = 1.0) -> str:
    """CTEs over the long training rows (h, r, y, i, v), i = 1 .. k: ``mu`` (h, i, m), ``yb``
    (h, b) and ``coef`` (h, i, w, m, b): prediction = b + sum of w (x - m). Needs WITH RECURSIVE."""
    return f"""mu AS (SELECT h, i, avg(v) AS m FROM {rows} GROUP BY h, i),
yb AS (SELECT h, avg(y) AS b FROM {rows} WHERE i = 1 GROUP BY h),
cen AS (SELECT h, r, i, v - m AS v, y - b AS y FROM {rows} JOIN mu USING (h, i) JOIN yb USING (h)),
sys AS (SELECT a.h, a.i, b.i AS j, sum(a.v * b.v) + CASE WHEN a.i = b.i THEN {float(alpha)} ELSE 0.0 END AS v
        FROM cen a JOIN cen b USING (h, r) GROUP BY a.h, a.i, b.i
  UNION ALL SELECT h, i, {k + 1} AS j, sum(v * y) AS v FROM cen GROUP BY h, i),
{solve_sql('sys', k, 'gj')},
coef AS (SELECT h, i, v AS w, m, b FROM gj JOIN mu USING (h, i) JOIN yb USING (h) WHERE p = {k} AND j = {k + 1})"""


def draw_sql(*key: str) -> str:
    """The uniform number of a key (see hourcast.operators.ml.uniform_draw)."""
    return f"((('0x' || substr(md5(concat_ws('|', {', '.join(key)})), 1, 12))::UBIGINT)::DOUBLE + 0.5) / {float(1 << 48)!r}"


def training_rows_sql(horizons) -> tuple[str, int]:
    """(CTEs ending in ``lg`` (h, split, r, y, i, v), number of features) of the training
    rows of all horizons, from a back-filled feature table ``bf``. Lists shorter than the
    longest are padded with zeros, forecast columns below the coverage bound are zero."""
    from hourcast.operators.coverage import horizon_candidates
    from hourcast.schema import COVERAGE_THRESHOLD, HORIZON_LAG_COLS
    lists = {h: horizon_candidates(h) for h in horizons}
    k = max(len(c) for c, _ in lists.values())
    ctes, union = [], []
    for h, (cols, fc) in lists.items():
        lags = " AND ".join(f"{c} IS NOT NULL" for c in HORIZON_LAG_COLS[h])
        w = "(PARTITION BY series, split ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

        def value(c):
            filled = f"COALESCE(CAST(last_value({c} IGNORE NULLS) OVER {w} AS DOUBLE), 0.0)"
            return f"CASE WHEN cv_{c} >= {COVERAGE_THRESHOLD} THEN {filled} ELSE 0.0 END" if c in fc else filled

        ctes.append(f"""tf{h} AS ({target_sql('bf', h)}),
cv{h} AS (SELECT {', '.join(f'avg(CAST({c} IS NOT NULL AS DOUBLE)) AS cv_{c}' for c in fc)} FROM tf{h}),
sp{h} AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY series ORDER BY timestamp)
    <= floor(count(*) OVER (PARTITION BY series) * 0.8) THEN 'train' ELSE 'test' END AS split
  FROM tf{h} WHERE aqi_next_{h}h IS NOT NULL AND {lags})""")
        union.append(f"SELECT {h} AS h, split, row_number() OVER () AS r, aqi_next_{h}h AS y, [{', '.join(value(c) for c in cols)}"
                     f"{', 0.0' * (k - len(cols))}] AS x FROM sp{h}, cv{h}")
    long = (f"lg AS (SELECT h, split, r, y, unnest(range(1, {k + 1})) AS i, unnest(x) AS v FROM ({' UNION ALL '.join(union)}))")
    return ", ".join([*ctes, long]), k
