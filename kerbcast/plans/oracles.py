"""The registered queries in DuckDB SQL, over the same tables.

``BASE`` derives trips, weather, holidays and the demand table; ``EVAL`` adds the split and both
baselines on the test rows. Doubles are rounded to six digits, integers are BIGINT.
"""

from __future__ import annotations

from kerbcast.functions.city_events import (
    CENTRAL_PARK, FIFTH_AVENUE, HUDSON, TIMES_SQUARE, WEST_VILLAGE,
)
from kerbcast.schemas import FULL_FEATURES
from kerbcast.sources.star_tables import TRIP_ZONES


def _in(*sites: list[int]) -> str:
    return ", ".join(str(z) for z in sorted({z for site in sites for z in site}))


def _event_days(year: str) -> str:
    """Rows (event_date, zones) of one year expression."""
    return f"""
      SELECT unnest([
        {{'d': make_date({year}, 12, 31), 'z': [{_in(TIMES_SQUARE)}]}},
        {{'d': make_date({year}, 7, 4), 'z': [{_in(HUDSON, TIMES_SQUARE)}]}},
        {{'d': make_date({year}, 3, 17), 'z': [{_in(FIFTH_AVENUE)}]}},
        {{'d': make_date({year}, 10, 31), 'z': [{_in(WEST_VILLAGE)}]}},
        {{'d': make_date({year}, 11, 1) + CAST((7 - isodow(make_date({year}, 11, 1))) % 7 AS INTEGER),
          'z': [{_in(CENTRAL_PARK, FIFTH_AVENUE)}]}},
        {{'d': make_date({year}, 11, 1) + CAST((11 - isodow(make_date({year}, 11, 1))) % 7 + 21 AS INTEGER),
          'z': [{_in(CENTRAL_PARK, TIMES_SQUARE)}]}},
        {{'d': make_date({year}, 6, 30) - CAST(isodow(make_date({year}, 6, 30)) % 7 AS INTEGER),
          'z': [{_in(FIFTH_AVENUE, WEST_VILLAGE)}]}}
      ]) AS e"""


BASE = f"""
WITH trips AS (
  SELECT event_id AS trip_id, ts + INTERVAL 303 DAY AS tpep_pickup_datetime,
    ts + INTERVAL 303 DAY + to_minutes(CAST(event_id % 90 AS INTEGER)) AS tpep_dropoff_datetime,
    [{", ".join(map(str, TRIP_ZONES))}][user_id % 10 + 1]::BIGINT AS PULocationID,
    [{", ".join(map(str, TRIP_ZONES))}][event_id % 10 + 1]::BIGINT AS DOLocationID,
    value AS fare_amount, value / 5.0::DOUBLE + (event_id % 10) / 10.0::DOUBLE AS trip_distance,
    CASE WHEN event_id % 7 <> 0 THEN (event_id % 4) / 2.0::DOUBLE END AS surcharge
  FROM events
), clean AS (
  SELECT *, coalesce(surcharge, 0.0) AS extra,
    (epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) / 60000000.0::DOUBLE AS trip_duration
  FROM trips
  WHERE trip_distance > 0.15 AND trip_distance <= 40 AND fare_amount > 3.5 AND fare_amount <= 150
), weather AS (
  SELECT pickup_hour_ts, (h * 7 % 300) / 10.0::DOUBLE - 5 AS temperature_2m,
    CASE WHEN h % 11 = 0 THEN (h % 5) / 2.0::DOUBLE ELSE 0.0 END AS precipitation,
    CASE WHEN h % 17 = 0 THEN (h % 7) / 1.0::DOUBLE ELSE 0.0 END AS snowfall
  FROM (
    SELECT pickup_hour_ts, epoch_us(pickup_hour_ts) // 3600000000 AS h
    FROM (
      SELECT unnest(generate_series(date_trunc('hour', min(tpep_pickup_datetime)),
        date_trunc('hour', max(tpep_pickup_datetime)), INTERVAL 1 HOUR)) AS pickup_hour_ts FROM trips
    )
  ) WHERE h % 97 <> 0
), holidays AS (
  SELECT DISTINCT unnest([make_date(y, 11, 11),
    make_date(y, 11, 1) + CAST((11 - isodow(make_date(y, 11, 1))) % 7 + 21 AS INTEGER)]) AS date
  FROM (SELECT DISTINCT year(tpep_pickup_datetime) AS y FROM trips)
), event_pairs AS (
  SELECT DISTINCT e.d AS event_date, unnest(e.z) AS zone_id FROM (
    {_event_days("y")} FROM (SELECT DISTINCT year(tpep_pickup_datetime) AS y FROM trips)
  )
), cells AS (
  SELECT PULocationID, date_trunc('hour', tpep_pickup_datetime) AS pickup_hour_ts,
    count(*)::BIGINT AS trip_count
  FROM clean GROUP BY ALL
), calendar AS (
  SELECT *, hour(pickup_hour_ts)::BIGINT AS pickup_hour, (isodow(pickup_hour_ts) - 1)::BIGINT AS pickup_dow,
    week(pickup_hour_ts)::BIGINT AS pickup_week, isodow(pickup_hour_ts) >= 6 AS pickup_is_weekend,
    (PULocationID IN (1, 132, 138))::BIGINT AS is_airport
  FROM cells
), demand AS (
  SELECT c.*, w.temperature_2m, w.precipitation, w.snowfall,
    (h.date IS NOT NULL)::BIGINT AS is_holiday, (e.zone_id IS NOT NULL)::BIGINT AS is_nyc_event
  FROM calendar c LEFT JOIN weather w USING (pickup_hour_ts)
  LEFT JOIN holidays h ON h.date = c.pickup_hour_ts::DATE
  LEFT JOIN event_pairs e ON e.event_date = c.pickup_hour_ts::DATE AND e.zone_id = c.PULocationID
)"""

EVAL = BASE + """, ends AS (
  SELECT epoch_us(min(pickup_hour_ts)) AS lo, epoch_us(max(pickup_hour_ts)) AS hi FROM demand
), parts AS (
  SELECT demand.*, CASE WHEN epoch_us(pickup_hour_ts) < lo + (hi - lo) * 0.8::DOUBLE
    THEN 'train' ELSE 'test' END AS split FROM demand, ends
), train AS (SELECT * FROM parts WHERE split = 'train'), test AS (SELECT * FROM parts WHERE split = 'test'),
overall AS (SELECT avg(trip_count) AS m FROM train),
key_means AS (
  SELECT PULocationID, pickup_hour, pickup_dow, avg(trip_count) AS m FROM train GROUP BY ALL
), scored AS (
  SELECT t.*, coalesce(k.m, o.m) AS prediction, coalesce(s.trip_count::DOUBLE, o.m) AS naive
  FROM test t CROSS JOIN overall o
  LEFT JOIN key_means k USING (PULocationID, pickup_hour, pickup_dow)
  LEFT JOIN train s ON s.PULocationID = t.PULocationID
    AND s.pickup_hour_ts + INTERVAL 168 HOUR = t.pickup_hour_ts
), residuals AS (
  SELECT *, prediction - trip_count AS residual, abs(prediction - trip_count) AS abs_error,
    abs(prediction - trip_count) / greatest(abs(trip_count), 2.220446049250313e-16) AS ape,
    abs(prediction - trip_count) / (trip_count + 1) AS rel_error FROM scored
), versions AS (
  SELECT epoch_us(day)::BIGINT // 86400000000 * 10 + k AS id, day AS trained_at, name,
    round_even(avg(abs(p - trip_count)), 2) AS mae,
    round_even(avg(abs(p - trip_count) / greatest(abs(trip_count), 2.220446049250313e-16)), 2) AS mape
  FROM (
    SELECT date_trunc('day', pickup_hour_ts)::TIMESTAMP AS day, 'demand_mean' AS name, 0 AS k, prediction AS p, trip_count FROM scored
    UNION ALL
    SELECT date_trunc('day', pickup_hour_ts)::TIMESTAMP, 'demand_naive', 1, naive, trip_count FROM scored
  ) GROUP BY day, name, k
), served AS (
  SELECT pickup_hour_ts AS timestamp,
    epoch_us(pickup_hour_ts)::BIGINT // 86400000000 * 10 + PULocationID % 2 AS model_version_id,
    PULocationID AS zone_id, pickup_hour AS hour, pickup_dow AS day_of_week, pickup_week AS week,
    round_even(CASE WHEN PULocationID % 2 = 1 THEN naive ELSE prediction END, 2) AS predicted_trips
  FROM scored
), lagged AS (
  SELECT p.*, a.trip_count::DOUBLE AS lag_24h, b.trip_count::DOUBLE AS lag_168h FROM parts p
  LEFT JOIN demand a ON a.PULocationID = p.PULocationID
    AND a.pickup_hour_ts + INTERVAL 24 HOUR = p.pickup_hour_ts
  LEFT JOIN demand b ON b.PULocationID = p.PULocationID
    AND b.pickup_hour_ts + INTERVAL 168 HOUR = p.pickup_hour_ts
), three AS (
  SELECT parts.* EXCLUDE (split), CASE WHEN split = 'test' THEN 'test'
    WHEN epoch_us(pickup_hour_ts) < i.lo + (i.hi - i.lo) * 0.75::DOUBLE THEN 'train'
    ELSE 'calibration' END AS split
  FROM parts, (SELECT epoch_us(min(pickup_hour_ts)) AS lo, epoch_us(max(pickup_hour_ts)) AS hi FROM train) i
), calibrated AS (
  SELECT t.*, coalesce(k.m, o.m) AS prediction FROM three t
  CROSS JOIN (SELECT avg(trip_count) AS m FROM three WHERE split = 'train') o
  LEFT JOIN (SELECT PULocationID, pickup_hour, pickup_dow, avg(trip_count) AS m FROM three
    WHERE split = 'train' GROUP BY ALL) k USING (PULocationID, pickup_hour, pickup_dow)
  WHERE t.split <> 'train'
), segments AS (
  SELECT demand.*, (epoch_us(pickup_hour_ts) - lo > (hi - lo) / 6.0::DOUBLE * 1)::INT
    + (epoch_us(pickup_hour_ts) - lo > (hi - lo) / 6.0::DOUBLE * 2)::INT
    + (epoch_us(pickup_hour_ts) - lo > (hi - lo) / 6.0::DOUBLE * 3)::INT
    + (epoch_us(pickup_hour_ts) - lo > (hi - lo) / 6.0::DOUBLE * 4)::INT
    + (epoch_us(pickup_hour_ts) - lo > (hi - lo) / 6.0::DOUBLE * 5)::INT AS segment FROM demand, ends
), fold_rows AS (
  SELECT f.fold, CASE WHEN s.segment <= f.fold THEN 'train' ELSE 'test' END AS role, s.*
  FROM segments s, (SELECT unnest(range(5)) AS fold) f WHERE s.segment <= f.fold + 1
), fold_errors AS (
  SELECT fold, avg(abs(coalesce(k.m, o.m) - trip_count)) AS mae FROM fold_rows t
  JOIN (SELECT fold, avg(trip_count) AS m FROM fold_rows WHERE role = 'train' GROUP BY ALL) o USING (fold)
  LEFT JOIN (SELECT fold, PULocationID, pickup_hour, pickup_dow, avg(trip_count) AS m FROM fold_rows
    WHERE role = 'train' GROUP BY ALL) k USING (fold, PULocationID, pickup_hour, pickup_dow)
  WHERE t.role = 'test' GROUP BY fold
)"""

CELL = "PULocationID, pickup_hour_ts"
BAND = """CASE WHEN trip_count > 150 THEN 'peak: over 150' WHEN trip_count > 50 THEN 'high: to 150'
  WHEN trip_count > 15 THEN 'medium: to 50' WHEN trip_count > 5 THEN 'low: to 15' WHEN trip_count > 0 THEN 'very low: to 5' END"""
COARSE = """CASE WHEN trip_count > 100 THEN 'peak: over 100' WHEN trip_count > 20 THEN 'high: to 100'
  WHEN trip_count > 5 THEN 'medium: to 20' WHEN trip_count > 0 THEN 'low: to 5' END"""
SNOW = """CASE WHEN s > 5 THEN 'heavy: over 5 cm' WHEN s > 1 THEN 'light: to 5 cm'
  WHEN s > 0 THEN 'trace: to 1 cm' WHEN s > -0.01 THEN 'none' END"""
FILED = """, filed AS (
  SELECT *, date_trunc('month', CASE WHEN trip_id % 50 = 0 THEN tpep_pickup_datetime + INTERVAL 1 MONTH
    ELSE tpep_pickup_datetime END) AS file_start FROM trips
)"""
ERRORS = """count(*)::BIGINT AS n, round(avg(abs_error), 6) AS mae,
  round(avg(rel_error) * 100, 6) AS rel_error_pct, round(avg(trip_count), 6) AS mean_actual"""


def _stack(columns: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS feature, {v} AS x FROM {source}" for k, v in columns.items())


def _describe(columns: list[str], source: str) -> str:
    return f"""SELECT feature, count(x)::BIGINT AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
      round(min(x), 6) AS min, round(max(x), 6) AS max, round(quantile_cont(x, 0.25), 6) AS q25,
      round(quantile_cont(x, 0.5), 6) AS q50, round(quantile_cont(x, 0.75), 6) AS q75
      FROM ({_stack({c: c + "::DOUBLE" for c in columns}, source)}) GROUP BY feature"""


def _histogram(value: str, source: str, bins: int) -> str:
    return f""", v AS (SELECT ({value})::DOUBLE AS x FROM {source}),
    r AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
    b AS (SELECT least(CAST(floor((x - lo) / nullif(hi - lo, 0) * {bins}) AS BIGINT), {bins - 1}) AS bin,
      count(*)::BIGINT AS n FROM v, r GROUP BY 1)
    SELECT g.bin, round(lo + g.bin * (hi - lo) / {bins}, 6) AS left_edge, coalesce(n, 0)::BIGINT AS n
    FROM (SELECT unnest(range({bins}))::BIGINT AS bin) g LEFT JOIN b USING (bin), r"""


def _ecdf(value: str, source: str) -> str:
    return f"""SELECT round({value}::DOUBLE, 6) AS value, count(*)::BIGINT AS n,
      round(sum(count(*)) OVER (ORDER BY {value}) / sum(count(*)) OVER (), 6) AS cdf
      FROM {source} GROUP BY {value}"""


NUMERIC = ["trip_count", "pickup_hour", "pickup_dow", "pickup_week", "is_airport", "temperature_2m",
           "precipitation", "snowfall", "is_holiday", "is_nyc_event"]


def _corr(a: str, b: str, fill: bool = True) -> str:
    x, y = (f"coalesce({c}, 0)::DOUBLE" if fill else f"{c}::DOUBLE" for c in (a, b))
    r = f"corr({x}, {y})"
    return f"round(CASE WHEN isnan({r}) THEN NULL ELSE {r} END, 6) + 0.0"


def _autocorrelation(lags, every_zone: bool) -> str:
    zone = "" if every_zone else """ WHERE PULocationID = (
      SELECT PULocationID FROM demand GROUP BY ALL ORDER BY sum(trip_count) DESC, PULocationID LIMIT 1)"""
    return BASE + f""", numbered AS (
      SELECT PULocationID, trip_count, row_number() OVER (PARTITION BY PULocationID ORDER BY pickup_hour_ts) AS i
      FROM demand{zone}
    ) SELECT a.PULocationID, l.lag::BIGINT AS lag, {_corr("a.trip_count", "b.trip_count", False)} AS r
    FROM numbered a CROSS JOIN (SELECT unnest([{", ".join(map(str, lags))}]) AS lag) l
    LEFT JOIN numbered b ON b.PULocationID = a.PULocationID AND b.i = a.i - l.lag GROUP BY ALL"""


def _failures(rules: list[tuple[str, str, str]], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{name}' AS rule, "
        f"count(*) FILTER (WHERE NOT coalesce({ok}, false))::BIGINT AS n_failed FROM {source}"
        for c, name, ok in rules
    )


DAMAGED = """, damaged AS (
  SELECT * REPLACE (PULocationID * 2 AS PULocationID, trip_count - 2 AS trip_count, pickup_dow + 1 AS pickup_dow,
    CASE WHEN pickup_hour <> 13 THEN pickup_week END AS pickup_week, precipitation - 1 AS precipitation,
    is_holiday * 2 AS is_holiday) FROM demand
)"""
DEMAND_RULES = [
    ("PULocationID", "in_range(1, 265)", "PULocationID BETWEEN 1 AND 265"),
    ("pickup_hour_ts", "present", "pickup_hour_ts IS NOT NULL"),
    ("trip_count", "at_least(0)", "trip_count >= 0"),
    ("pickup_hour", "in_range(0, 23)", "pickup_hour BETWEEN 0 AND 23"),
    ("pickup_dow", "in_range(0, 6)", "pickup_dow BETWEEN 0 AND 6"),
    ("pickup_week", "in_range(1, 53)", "pickup_week BETWEEN 1 AND 53"),
    ("precipitation", "at_least(0)", "precipitation >= 0 OR precipitation IS NULL"),
    ("snowfall", "at_least(0)", "snowfall >= 0 OR snowfall IS NULL"),
    ("is_holiday", "one_of(0, 1)", "is_holiday IN (0, 1)"),
]
UNIT = "('0x' || substr(md5({key}), 1, 8))::BIGINT / 4294967296.0::DOUBLE"
PAIR_MOMENTS = """SELECT count(*)::BIGINT AS n, round(avg(ea), 6) AS mae_a, round(avg(eb), 6) AS mae_b,
  round(avg(ea - eb), 6) AS mean_diff, round(stddev_samp(ea - eb), 6) AS std_diff,
  round(avg(ea - eb) / (stddev_samp(ea - eb) / sqrt(count(*))), 6) AS t_statistic"""
ROW_LAGS = """, row_lagged AS (
  SELECT * FROM (
    SELECT *, lag(trip_count, 24) OVER z::DOUBLE AS lag_24h, lag(trip_count, 168) OVER z::DOUBLE AS lag_168h
    FROM demand WINDOW z AS (PARTITION BY PULocationID ORDER BY pickup_hour_ts)
  ) WHERE lag_24h IS NOT NULL AND lag_168h IS NOT NULL
)""".replace("lag(trip_count, 24) OVER z::DOUBLE", "CAST(lag(trip_count, 24) OVER z AS DOUBLE)").replace(
    "lag(trip_count, 168) OVER z::DOUBLE", "CAST(lag(trip_count, 168) OVER z AS DOUBLE)")


def _windows(source: str) -> str:
    return f""", framed AS (
      SELECT *, row_number() OVER z - 1 AS i, floor(count(*) OVER (PARTITION BY PULocationID) * 0.8::DOUBLE) AS cut,
        count(*) OVER b AS steps, sum(trip_count) OVER b AS history_trips,
        lag(trip_count, 24) OVER z AS oldest, lag(trip_count, 1) OVER z AS newest
      FROM {source}
      WINDOW z AS (PARTITION BY PULocationID ORDER BY pickup_hour_ts),
        b AS (PARTITION BY PULocationID ORDER BY pickup_hour_ts ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)
    ), windows AS (
      SELECT *, CASE WHEN i >= 24 AND i < cut THEN 'train' WHEN i >= cut + 24 THEN 'test' END AS part FROM framed
    )"""


DECILES = ", ".join(f"quantile_cont(x, {i / 10})" for i in range(11))
DRIFT_FEATURES = ["pickup_hour", "pickup_dow", "temperature_2m", "precipitation", "trip_count", "lag_24h"]


def _baseline(features: list[str], source: str) -> str:
    stack = _stack({f: f + "::DOUBLE" for f in features}, source)
    return f""", baseline AS (
      SELECT * FROM (
        SELECT feature, count(x)::BIGINT AS n, [{DECILES}] AS points FROM ({stack}) WHERE x IS NOT NULL GROUP BY feature
      ) WHERE len(list_distinct(points)) = 11
    )"""


def _edges_below(edges: str, op: str, x: str, which: range) -> str:
    """How many of the listed edges are below (or at) a value."""
    return "(" + " + ".join(f"({edges}[{i}] {op} {x})::INT" for i in which) + ")"


def _psi(features: list[str], source: str) -> str:
    stack = _stack({f: f + "::DOUBLE" for f in features}, source)
    return f""", counted AS (
      SELECT feature, {_edges_below("points", "<=", "x", range(2, 11))} AS bin, count(*) AS n
      FROM baseline JOIN ({stack}) USING (feature) WHERE x IS NOT NULL GROUP BY ALL
    ), shares AS (
      SELECT feature, coalesce(c.n, 0) AS n,
        greatest(coalesce(c.n, 0) / greatest(sum(coalesce(c.n, 0)) OVER (PARTITION BY feature), 1), 1e-6) AS s
      FROM (SELECT feature, unnest(range(10)) AS bin FROM baseline) LEFT JOIN counted c USING (feature, bin)
    ), psi AS (
      SELECT feature, sum(n)::BIGINT AS n, sum((p - 0.1) * ln(p / 0.1)) AS psi
      FROM (SELECT feature, n, s / sum(s) OVER (PARTITION BY feature) AS p FROM shares) GROUP BY feature
    )"""


DRIFT = EVAL + """, d_train AS (SELECT * FROM lagged WHERE split = 'train'),
d_test AS (SELECT * FROM lagged WHERE split = 'test')""" + _baseline(DRIFT_FEATURES, "d_train")
VERSION_DRIFT = """, recent AS (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY trained_at DESC, id DESC) AS back FROM versions
), od AS (
  SELECT name, count(*)::BIGINT AS runs, avg(mae) FILTER (WHERE back > 1) AS baseline_mae,
    max(mae) FILTER (WHERE back = 1) AS current_mae FROM recent WHERE back <= 6 GROUP BY name
), drifted AS (
  SELECT *, (current_mae - baseline_mae) / nullif(baseline_mae, 0) AS drift_pct,
    runs >= 3 AND coalesce((current_mae - baseline_mae) / nullif(baseline_mae, 0) > 0.1, false) AS drifted FROM od
)"""
MI_FEATURES = ["PULocationID", "pickup_hour", "pickup_dow", "pickup_week", "is_holiday",
               "temperature_2m", "precipitation", "snowfall"]
NINTHS = ", ".join(f"quantile_cont(x, {i / 10})" for i in range(1, 10))


def _mutual_information() -> str:
    def edges(c: str) -> str:
        return f"(SELECT [{NINTHS}] FROM (SELECT coalesce({c}, 0)::DOUBLE AS x FROM demand))"

    names = [*MI_FEATURES, "trip_count"]
    table = ", ".join(f"{edges(c)} AS e_{c}" for c in names)
    target = _edges_below("e_trip_count", "<", "trip_count", range(1, 10))
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {_edges_below('e_' + c, '<', f'coalesce({c}, 0)::DOUBLE', range(1, 10))} AS bx, "
        f'{target} AS "by" FROM demand, edges'
        for c in MI_FEATURES
    )
    return BASE + f""", edges AS (SELECT {table}), binned AS ({rows}),
    cells2 AS (SELECT feature, bx, "by", count(*)::DOUBLE AS nxy FROM binned GROUP BY ALL),
    p AS (SELECT feature, nxy, sum(nxy) OVER (PARTITION BY feature, bx) AS nx,
      sum(nxy) OVER (PARTITION BY feature, "by") AS ny, sum(nxy) OVER (PARTITION BY feature) AS n FROM cells2)
    SELECT feature, round(sum(nxy / n * ln((nxy / n) / ((nx / n) * (ny / n)))), 6) AS mutual_information
    FROM p GROUP BY feature"""


HOUR_PIVOT = ", ".join(f"max(v) FILTER (WHERE h = {h}) AS h{h}" for h in range(24))
HOUR_PIVOT_0 = ", ".join(f"round(coalesce(max(v) FILTER (WHERE h = {h}), 0), 6) AS h{h}" for h in range(24))


def _dispatch(model: str, p: str) -> str:
    sent = f"greatest(ceil({p} * 1.1::DOUBLE)::BIGINT, 1)"
    return f"""SELECT '{model}' AS model, round(round_even(avg(least({sent}, trip_count) / {sent}), 3), 6) AS utilization_rate,
      round(round_even(avg((greatest(trip_count - {sent}, 0) > 0)::INT), 3), 6) AS unfulfilled_trip_rate,
      sum(greatest(trip_count - {sent}, 0))::BIGINT AS total_unfulfilled,
      sum({sent} - least({sent}, trip_count))::BIGINT AS wasted_driver_slots FROM scored"""


def _thresholds(measure: str, column: str, caps, floors) -> str:
    tests = [("at_most", c, f"{column} BETWEEN 0 AND {c}") for c in caps]
    tests += [("below", c, f"{column} < {c}::DOUBLE") for c in floors]
    return " UNION ALL ".join(
        f"SELECT '{kind}' AS test, {c}::DOUBLE AS threshold, round(avg(({cond})::INT), 6) AS share, "
        f"'{measure}' AS measure FROM positive" for kind, c, cond in tests
    )


POSITIVE = ", positive AS (SELECT * FROM trips WHERE trip_distance > 0 AND fare_amount > 0)"
COMPARE = """SELECT 'historical_mean' AS model, avg(abs(prediction - trip_count)) AS mae,
    avg(abs(prediction - trip_count) / greatest(abs(trip_count), 2.220446049250313e-16)) AS mape FROM scored
  UNION ALL SELECT 'seasonal_naive', avg(abs(naive - trip_count)),
    avg(abs(naive - trip_count) / greatest(abs(trip_count), 2.220446049250313e-16)) FROM scored"""
LABELLED = """, threshold AS (SELECT quantile_cont(trip_count, 0.75) AS q FROM scored),
labelled AS (SELECT scored.*, (trip_count >= q)::BIGINT AS y FROM scored, threshold)"""
DEMAND_COLUMNS = """PULocationID, pickup_hour_ts, trip_count, pickup_hour, pickup_dow, pickup_week, pickup_is_weekend,
  is_airport, round(temperature_2m, 6) AS temperature_2m, precipitation, snowfall, is_holiday, is_nyc_event"""


def _interval(c: float) -> str:
    return f"""SELECT round(avg((trip_count BETWEEN lo AND hi)::INT), 6) AS coverage, round(avg(hi - lo), 6) AS mean_width,
      {c}::DOUBLE AS target FROM (
        SELECT trip_count, exp(ln(1 + prediction) - m) - 1 AS lo, exp(ln(1 + prediction) + m) - 1 AS hi
        FROM calibrated, (SELECT quantile_cont(abs(ln(1 + trip_count) - ln(1 + prediction)), {c}) AS m
          FROM calibrated WHERE split = 'calibration') WHERE split = 'test')"""


def _class_report(k: int, name: str) -> str:
    tp, fp, fn = (f"count(*) FILTER (WHERE {c})" for c in (f"y = {k} AND p = {k}", f"y <> {k} AND p = {k}", f"y = {k} AND p <> {k}"))
    return f"""SELECT '{name}' AS class, round(coalesce({tp} / nullif({tp} + {fp}, 0), 0.0), 6) AS precision,
      round(coalesce({tp} / nullif({tp} + {fn}, 0), 0.0), 6) AS recall,
      round(coalesce(2 * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0), 0.0), 6) AS f1, ({tp} + {fn})::BIGINT AS support
      FROM (SELECT y, (prediction >= 2)::INT AS p FROM labelled)"""


ORACLES: dict[str, str] = {
    "scan_trips": BASE + FILED + """ SELECT year(file_start)::BIGINT AS file_year, month(file_start)::BIGINT AS file_month,
      count(*)::BIGINT AS n, round(sum(fare_amount), 6) AS fares, round(sum((epoch_us(tpep_dropoff_datetime)
        - epoch_us(tpep_pickup_datetime)) / 60000000.0::DOUBLE), 6) AS minutes, round(sum(coalesce(surcharge, 0.0)), 6) AS extras
      FROM filed WHERE trip_distance > 0.15 AND trip_distance <= 40 AND fare_amount > 3.5 AND fare_amount <= 150
        AND date_trunc('month', tpep_pickup_datetime) = file_start GROUP BY ALL""",
    "scan_mixed_schemas": BASE + """, read AS (
      SELECT *, month(tpep_pickup_datetime) % 2 = 0 AS even,
        CASE WHEN month(tpep_pickup_datetime) % 2 = 0 THEN trip_distance::FLOAT::DOUBLE ELSE trip_distance END AS d
      FROM trips)
      SELECT year(tpep_pickup_datetime)::BIGINT AS file_year, month(tpep_pickup_datetime)::BIGINT AS file_month,
        count(*)::BIGINT AS n, round(sum(fare_amount), 6) AS fares, round(sum(coalesce(surcharge, 0.0)), 6) AS fees,
        round(sum(CASE WHEN even THEN coalesce(surcharge, 0.0) ELSE 0.0 END), 6) AS extras,
        count(CASE WHEN even THEN DOLocationID END)::BIGINT AS known_ends, sum(PULocationID)::BIGINT AS zones,
        min(tpep_pickup_datetime) AS first_pickup
      FROM read WHERE d > 0.15 AND d <= 40 AND fare_amount > 3.5 AND fare_amount <= 150 GROUP BY ALL""",
    "scan_one_month": BASE + """ SELECT trip_id, tpep_pickup_datetime, round(trip_duration, 6) AS trip_duration,
      extra AS Airport_fee FROM clean WHERE trip_id % 50 <> 0
      AND tpep_pickup_datetime >= (SELECT date_trunc('month', max(tpep_pickup_datetime)) FROM trips)""",
    "weather_hourly": BASE + " SELECT pickup_hour_ts, round(temperature_2m, 6) AS temperature_2m, precipitation, snowfall FROM weather",
    "weather_from_json": BASE + " SELECT pickup_hour_ts, round(temperature_2m, 6) AS temperature_2m, precipitation, snowfall FROM weather",
    "holiday_dates": """SELECT DISTINCT unnest([make_date(y, 11, 11),
      make_date(y, 11, 1) + CAST((11 - isodow(make_date(y, 11, 1))) % 7 + 21 AS INTEGER)]) AS date
      FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)""",
    "demand_roundtrip": BASE + f" SELECT {DEMAND_COLUMNS}, year(pickup_hour_ts)::BIGINT AS year FROM demand",
    "history_insert_if_absent": BASE + """ SELECT PULocationID AS zone_id, pickup_hour_ts,
      trip_count + 1000 * is_airport AS trip_count, pickup_hour, pickup_dow, round(temperature_2m, 6) AS temperature_2m,
      precipitation, snowfall, is_holiday FROM demand""",
    "predictions_append": EVAL + " SELECT * REPLACE (round(predicted_trips, 6) AS predicted_trips) FROM served",
    "model_version_append": EVAL + " SELECT id, trained_at, name, mae, mape FROM versions",
    "file_completeness": BASE + FILED + """ SELECT year(file_start)::BIGINT AS file_year, month(file_start)::BIGINT AS file_month,
      max(tpep_pickup_datetime) AS last_pickup,
      max(tpep_pickup_datetime)::DATE >= last_day(any_value(file_start)::DATE) AS complete FROM filed GROUP BY file_start""",
    "run_log": EVAL + f""" SELECT model AS run_name, round(mae, 6) AS mae, NULL::VARCHAR AS n_estimators, '0.05' AS learning_rate,
      'PULocationID, pickup_hour, pickup_dow' AS features, round(mape, 6) AS mape, 'batch' AS source FROM ({COMPARE})""",
    "clean_trips": BASE + """ SELECT trip_id, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID,
      round(fare_amount, 6) AS fare_amount, round(trip_distance, 6) AS trip_distance, extra AS Airport_fee, extra,
      round(trip_duration, 6) AS trip_duration FROM clean""",
    "trip_duration": BASE + """ SELECT trip_id, round((epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime))
      / 60000000.0::DOUBLE, 6) AS trip_duration FROM trips""",
    "demand_hourly": BASE + " SELECT * FROM cells",
    "calendar_features": BASE + " SELECT * FROM calendar",
    "order_calendar": """SELECT o_orderkey, 132::BIGINT AS PULocationID, o_orderdate, hour(o_orderdate)::BIGINT AS pickup_hour,
      (isodow(o_orderdate) - 1)::BIGINT AS pickup_dow, week(o_orderdate)::BIGINT AS pickup_week,
      isodow(o_orderdate) >= 6 AS pickup_is_weekend, 1::BIGINT AS is_airport FROM orders""",
    "drop_incomplete": BASE + f""" SELECT {CELL}, round(temperature_2m, 6) AS temperature_2m, precipitation, snowfall
      FROM demand WHERE temperature_2m IS NOT NULL AND precipitation IS NOT NULL AND snowfall IS NOT NULL""",
    "min_trips": BASE + f" SELECT {CELL}, trip_count FROM demand WHERE trip_count > 1",
    "latest_year": """SELECT o_orderkey, o_orderdate FROM orders
      WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""",
    "validate_trips": BASE + " " + _failures([
        ("tpep_pickup_datetime", "present", "tpep_pickup_datetime IS NOT NULL"),
        ("trip_distance", "above(0)", "trip_distance > 0"), ("fare_amount", "above(0)", "fare_amount > 0"),
        ("PULocationID", "in_range(1, 265)", "PULocationID BETWEEN 1 AND 265")], "trips"),
    "validate_demand": BASE + DAMAGED + " " + _failures(DEMAND_RULES, "damaged"),
    "validation_failures": BASE + DAMAGED + " " + " UNION ALL ".join(
        f"SELECT pickup_hour_ts, '{c}' AS \"column\", '{name}' AS rule, {c}::VARCHAR AS value FROM damaged "
        f"WHERE NOT coalesce({ok}, false)"
        for c, name, ok in DEMAND_RULES),
    "validate_requests": BASE + """, requests AS (
      SELECT PULocationID AS zone_id, pickup_hour + pickup_dow AS hour, pickup_dow AS day_of_week, pickup_week + 5 AS week,
        is_holiday, coalesce(snowfall - 1, 0) AS snowfall, CASE WHEN trip_count > 1 THEN trip_count ELSE 0 END AS lag_24h FROM demand)
      SELECT zone_id, CASE WHEN hour <= 23 AND week <= 53 AND snowfall >= 0 THEN 'valid' ELSE 'rejected' END AS outcome,
        count(*)::BIGINT AS n, sum(lag_24h)::BIGINT AS lags FROM requests GROUP BY ALL""",
    "feature_matrix": EVAL + """ SELECT PULocationID, pickup_hour, pickup_dow, pickup_week, is_holiday, coalesce(snowfall, 0.0) AS snowfall,
      lag_24h, lag_168h, is_airport, is_nyc_event, trip_count FROM lagged WHERE lag_24h IS NOT NULL AND lag_168h IS NOT NULL""",
    "weather_filled": BASE + f""" SELECT {CELL}, round(coalesce(temperature_2m, 0), 6) AS temperature_2m,
      coalesce(precipitation, 0.0) AS precipitation, coalesce(snowfall, 0.0) AS snowfall, is_holiday FROM demand""",
    "snow_buckets": BASE + f" SELECT {CELL}, {SNOW} AS snow_bucket FROM (SELECT *, coalesce(snowfall, 0) AS s FROM demand)",
    "demand_bands": BASE + f" SELECT {CELL}, {BAND} AS demand_band, {COARSE} AS coarse_band FROM demand",
    "threshold_shares": BASE + POSITIVE + " " + _thresholds("fare_amount", "fare_amount", [50, 100, 150, 200], [0.5 * i for i in range(1, 10)])
    + " UNION ALL " + _thresholds("trip_distance", "trip_distance", [], [0.05, 0.1, 0.15, 0.2, 0.25]),
    "iqr_bounds": BASE + POSITIVE + """ SELECT round(q1, 6) AS q1, round(q3, 6) AS q3, round(q1 - 1.5 * (q3 - q1), 6) AS lower,
      round(q3 + 1.5 * (q3 - q1), 6) AS upper
      FROM (SELECT quantile_cont(fare_amount, 0.25) AS q1, quantile_cont(fare_amount, 0.75) AS q3 FROM positive)""",
    "out_of_month": BASE + FILED + """ SELECT trip_id, tpep_pickup_datetime, year(file_start)::BIGINT AS file_year,
      month(file_start)::BIGINT AS file_month FROM filed WHERE date_trunc('month', tpep_pickup_datetime) <> file_start""",
    "high_demand_label": BASE + f""" SELECT {CELL}, trip_count,
      (trip_count >= (SELECT quantile_cont(trip_count, 0.75) FROM demand))::BIGINT AS high_demand FROM demand""",
    "ab_route": BASE + f""", requests AS (SELECT PULocationID AS zone_id, pickup_hour_ts + INTERVAL 1 DAY
      + to_minutes(CAST(PULocationID % 60 AS INTEGER)) AS prediction_time FROM demand)
      SELECT zone_id, prediction_time, CASE WHEN {UNIT.format(key="zone_id::VARCHAR || '|' || prediction_time::VARCHAR || '|ab'")} < 0.5
      THEN 'B' ELSE 'A' END AS variant FROM requests""",
    "hash_sample": BASE + f""" SELECT trip_id, fare_amount FROM clean
      WHERE {UNIT.format(key="trip_id::VARCHAR || '|42'")} < 0.1::DOUBLE""",
    "hash_sample_rows": BASE + f""" SELECT trip_id FROM clean ORDER BY {UNIT.format(key="trip_id::VARCHAR || '|42'")}, trip_id LIMIT 500""",
    "demand_with_weather": BASE + """ SELECT c.*, round(temperature_2m, 6) AS temperature_2m, precipitation, snowfall
      FROM cells c LEFT JOIN weather USING (pickup_hour_ts)""",
    "demand_with_holiday": BASE + " SELECT PULocationID, pickup_hour_ts, trip_count, is_holiday FROM demand",
    "demand_with_city_event": BASE + " SELECT PULocationID, pickup_hour_ts, trip_count, is_nyc_event FROM demand",
    "demand_with_listed_event": BASE + " SELECT PULocationID, pickup_hour_ts, trip_count, is_nyc_event FROM demand",
    "city_event_calendar": f"""SELECT DISTINCT e.d AS event_date, unnest(e.z)::BIGINT AS zone_id FROM (
      {_event_days("y")} FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders
        UNION SELECT year(ts + INTERVAL 303 DAY) FROM events))""",
    "demand_table": BASE + f" SELECT {DEMAND_COLUMNS} FROM demand",
    "seasonal_naive": EVAL + f" SELECT {CELL}, trip_count, round(naive, 6) AS prediction FROM scored",
    "historical_mean": EVAL + f" SELECT {CELL}, trip_count, round(prediction, 6) AS prediction FROM scored",
    "lag_by_time": EVAL + f" SELECT {CELL}, coalesce(lag_24h, 0.0) AS lag_24h, coalesce(lag_168h, 0.0) AS lag_168h FROM lagged",
    "lag_by_rows": BASE + ROW_LAGS + f" SELECT {CELL}, lag_24h, lag_168h FROM row_lagged",
    "ab_results": EVAL + """ SELECT v.id, v.name, v.trained_at, v.mae, v.mape, count(s.zone_id)::BIGINT AS prediction_count
      FROM (SELECT * FROM versions ORDER BY trained_at DESC, name LIMIT 10) v
      LEFT JOIN served s ON s.model_version_id = v.id GROUP BY ALL""",
    "top_zone_rows": BASE + f""" SELECT {CELL}, trip_count FROM demand WHERE PULocationID IN (
      SELECT PULocationID FROM demand GROUP BY ALL ORDER BY sum(trip_count) DESC, PULocationID LIMIT 4)""",
    "ab_pairs": BASE + ROW_LAGS + _windows("row_lagged") + f""" SELECT {CELL}, trip_count::DOUBLE AS target, lag_24h, lag_168h,
      round(history_trips / steps, 6) AS history_mean FROM windows WHERE part = 'test'""",
    "demand_by_hour_dow": BASE + """ SELECT PULocationID, hour(tpep_pickup_datetime)::BIGINT AS pickup_hour,
      (isodow(tpep_pickup_datetime) - 1)::BIGINT AS pickup_dow, count(*)::BIGINT AS trip_count FROM clean GROUP BY ALL""",
    "busy_cell_share": BASE + """ SELECT count(*)::BIGINT AS cells, round(avg((n >= 10)::INT) * 100, 6) AS pct_at_least FROM (
      SELECT count(*) AS n FROM clean GROUP BY PULocationID, hour(tpep_pickup_datetime), isodow(tpep_pickup_datetime))""",
    "cells_by_hour": BASE + """ SELECT pickup_hour, count(*)::BIGINT AS cells FROM (
      SELECT DISTINCT PULocationID, hour(tpep_pickup_datetime)::BIGINT AS pickup_hour, isodow(tpep_pickup_datetime) FROM clean) GROUP BY 1""",
    "null_counts": BASE + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL)::BIGINT AS n_null FROM demand" for c in (
            "PULocationID", "pickup_hour_ts", "trip_count", "pickup_hour", "pickup_dow", "pickup_week", "pickup_is_weekend",
            "is_airport", "temperature_2m", "precipitation", "snowfall", "is_holiday", "is_nyc_event")),
    "trips_by_hour": BASE + " SELECT hour(tpep_pickup_datetime)::BIGINT AS pickup_hour, count(*)::BIGINT AS trips FROM clean GROUP BY 1",
    "trips_by_dow": BASE + " SELECT (isodow(tpep_pickup_datetime) - 1)::BIGINT AS pickup_dow, count(*)::BIGINT AS trips FROM clean GROUP BY 1",
    "trips_dow_hour_pivot": BASE + f""" SELECT pickup_dow, {HOUR_PIVOT} FROM (
      SELECT (isodow(tpep_pickup_datetime) - 1)::BIGINT AS pickup_dow, hour(tpep_pickup_datetime) AS h, count(*)::BIGINT AS v
      FROM clean GROUP BY 1, 2) GROUP BY pickup_dow""",
    "zone_profiles": BASE + f""" SELECT PULocationID, {HOUR_PIVOT_0} FROM (
      SELECT PULocationID, pickup_hour AS h, avg(trip_count) AS v FROM demand GROUP BY 1, 2) GROUP BY PULocationID""",
    "dow_hour_profile": BASE + " SELECT pickup_dow, pickup_hour, round(avg(trip_count), 6) AS mean_trips FROM demand GROUP BY 1, 2",
    "hour_profile": BASE + """ SELECT pickup_hour, round(avg(m), 6) AS mean_trips FROM (
      SELECT pickup_dow, pickup_hour, avg(trip_count) AS m FROM demand GROUP BY 1, 2) GROUP BY 1""",
    "peak_trough": BASE + """, hours AS (SELECT pickup_hour, avg(m) AS m FROM (
      SELECT pickup_dow, pickup_hour, avg(trip_count) AS m FROM demand GROUP BY 1, 2) GROUP BY 1)
      SELECT (SELECT pickup_hour FROM hours ORDER BY m DESC, pickup_hour LIMIT 1) AS peak_hour,
        (SELECT pickup_hour FROM hours ORDER BY m, pickup_hour LIMIT 1) AS trough_hour,
        round((SELECT max(m) / min(m) FROM hours), 6) AS ratio""",
    "zone_concentration": BASE + """, z AS (SELECT PULocationID, sum(trip_count) AS s,
        row_number() OVER (ORDER BY sum(trip_count) DESC, PULocationID) AS rk FROM demand GROUP BY 1)
      SELECT count(*)::BIGINT AS n_zones, round(sum(s) FILTER (WHERE rk <= 3) / sum(s), 6) AS top3_share,
        round(sum(s) FILTER (WHERE rk <= 5) / sum(s), 6) AS top5_share FROM z""",
    "lorenz_curve": BASE + """ SELECT PULocationID, s::BIGINT AS total_trips, row_number() OVER o AS zone_rank,
      round(sum(s) OVER o / sum(s) OVER (), 6) AS cumulative_share
      FROM (SELECT PULocationID, sum(trip_count) AS s FROM demand GROUP BY 1)
      WINDOW o AS (ORDER BY s DESC, PULocationID ROWS UNBOUNDED PRECEDING)""",
    "snow_effect": BASE + f""", b AS (SELECT snow_bucket, avg(trip_count) AS m, count(*) AS n FROM (
        SELECT trip_count, coalesce({SNOW}, 'invalid: below 0') AS snow_bucket FROM (SELECT *, coalesce(snowfall, 0) AS s FROM demand)) GROUP BY 1)
      SELECT snow_bucket, round(m, 6) AS mean_trips, n::BIGINT AS n_obs,
        round(m / (SELECT m FROM b WHERE snow_bucket = 'none') - 1, 6) AS vs_no_snow FROM b""",
    "holiday_effect": BASE + """ SELECT is_holiday, round(avg(trip_count), 6) AS mean_trips, count(*)::BIGINT AS n_obs,
      round(median(trip_count), 6) AS median_trips,
      round(avg(trip_count) / (SELECT avg(trip_count) FROM demand WHERE is_holiday = 0) - 1, 6) AS lift FROM demand GROUP BY 1""",
    "holiday_by_hour": BASE + """ SELECT pickup_hour, round(avg(trip_count) FILTER (WHERE is_holiday = 0), 6) AS ordinary_mean,
      round(avg(trip_count) FILTER (WHERE is_holiday = 1), 6) AS holiday_mean FROM demand GROUP BY 1""",
    "describe_trip_count": BASE + " " + _describe(["trip_count", "temperature_2m", "precipitation", "snowfall"], "demand"),
    "describe_trips": BASE + " " + _describe(["trip_distance", "fare_amount", "trip_duration"], "clean"),
    "distribution_shape": BASE + """ SELECT round(skewness(trip_count), 6) AS skewness, round(kurtosis(trip_count), 6) AS kurtosis,
      round(avg((trip_count = 0)::INT), 6) AS zero_share FROM demand""",
    "histogram_trip_count": BASE + _histogram("trip_count", "demand", 80),
    "histogram_log_trip_count": BASE + _histogram("ln(1 + trip_count)", "demand", 80),
    "histogram_fares": BASE + POSITIVE + _histogram("fare_amount", "positive WHERE fare_amount BETWEEN 0.01 AND 200", 33),
    "ecdf_trip_count": BASE + " " + _ecdf("trip_count", "demand"),
    "ecdf_fares": BASE + " " + _ecdf("fare_amount", "clean"),
    "feature_correlations": BASE + " " + " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, {_corr(a, b)} AS r FROM demand" for i, a in enumerate(NUMERIC) for b in NUMERIC[:i]),
    "target_correlations": BASE + " SELECT feature, r, abs(r) AS abs_r FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {_corr(c, 'trip_count')} AS r FROM demand" for c in NUMERIC[1:]) + ")",
    "profile_merged": BASE + """, own AS (SELECT * FROM clean WHERE trip_id % 50 <> 0),
      wide AS (""" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {x}::DOUBLE AS x, {known} IS NULL AS missing FROM own" for c, x, known in (
            ("trip_distance", "trip_distance", "trip_distance"), ("fare_amount", "fare_amount", "fare_amount"),
            ("trip_duration", "trip_duration", "trip_duration"), ("extra", "extra", "extra"),
            *((c, "NULL", c) for c in ("PULocationID", "DOLocationID", "trip_id")))) + """)
      SELECT feature, count(*) FILTER (WHERE NOT missing)::BIGINT AS n, count(*) FILTER (WHERE missing)::BIGINT AS n_null,
      round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, round(min(x), 6) AS lowest, round(max(x), 6) AS highest
      FROM wide GROUP BY feature""",
    "profile_trips": BASE + """ SELECT count(*)::BIGINT AS n_rows, min(tpep_pickup_datetime) AS first_ts, max(tpep_pickup_datetime) AS last_ts,
      count(*) FILTER (WHERE surcharge IS NULL)::BIGINT AS null_Airport_fee, count(*) FILTER (WHERE surcharge IS NULL)::BIGINT AS null_extra,
      count(*) FILTER (WHERE fare_amount IS NULL)::BIGINT AS null_fare_amount,
      count(DISTINCT PULocationID)::BIGINT AS distinct_PULocationID, count(DISTINCT DOLocationID)::BIGINT AS distinct_DOLocationID FROM trips""",
    "demand_years": BASE + " SELECT DISTINCT year(pickup_hour_ts)::BIGINT AS year FROM demand",
    "forecast_errors": EVAL + " SELECT round_even(avg(abs_error), 2) AS mae, round_even(avg(ape), 2) AS mape FROM residuals",
    "forecast_errors_zero_safe": EVAL + """ SELECT round(avg(abs(y - prediction)), 6) AS mae,
      round(avg(abs((y - prediction) / CASE WHEN y = 0 THEN 1 ELSE y END)), 6) AS mape_zero_safe
      FROM (SELECT prediction, trip_count - 1 AS y FROM scored)""",
    "baseline_comparison": EVAL + f" SELECT model, round(mae, 6) AS mae, round(mape, 6) AS mape FROM ({COMPARE})",
    "residual_summary": EVAL + """ SELECT round(avg(residual), 6) AS bias, round(stddev_pop(residual), 6) AS residual_std,
      round(avg(abs_error), 6) AS mae, round(avg(trip_count), 6) AS mean_actual, round(quantile_cont(abs_error, 0.95), 6) AS p95_abs_error,
      round(avg(abs_error) / avg(trip_count), 6) AS mae_over_mean FROM residuals""",
    "error_by_band": EVAL + f" SELECT coalesce({BAND}, 'no band: 0 or missing') AS demand_band, {ERRORS} FROM residuals GROUP BY 1",
    "error_by_zone": EVAL + f" SELECT PULocationID, {ERRORS} FROM residuals GROUP BY 1",
    "error_by_hour": EVAL + f" SELECT pickup_hour, {ERRORS} FROM residuals GROUP BY 1",
    "worst_hours": EVAL + """, h AS (SELECT pickup_hour, avg(abs_error) AS m, avg(rel_error) * 100 AS r FROM residuals GROUP BY 1)
      SELECT (SELECT pickup_hour FROM h ORDER BY m DESC, pickup_hour LIMIT 1) AS worst_abs_hour, round(max(m), 6) AS worst_mae,
        (SELECT pickup_hour FROM h ORDER BY r DESC, pickup_hour LIMIT 1) AS worst_rel_hour, round(max(r), 6) AS worst_rel_error_pct FROM h""",
    "error_by_week": EVAL + f" SELECT week(pickup_hour_ts)::BIGINT AS week_of_year, {ERRORS} FROM residuals GROUP BY 1",
    "weekly_stability": EVAL + """, w AS (SELECT pickup_week, avg(abs_error) AS m FROM residuals GROUP BY 1)
      SELECT round(min(m), 6) AS best_mae, round(max(m), 6) AS worst_mae,
        (SELECT pickup_week FROM w ORDER BY m DESC, pickup_week LIMIT 1) AS worst_week,
        round(stddev_samp(m) / avg(m), 6) AS coefficient_of_variation FROM w""",
    "bias_by_quintile": EVAL + """, q AS (SELECT quantile_cont(trip_count, 0.2) AS a, quantile_cont(trip_count, 0.4) AS b,
        quantile_cont(trip_count, 0.6) AS c, quantile_cont(trip_count, 0.8) AS d FROM scored)
      SELECT CASE WHEN trip_count <= a THEN 'Q1 (lowest)' WHEN trip_count <= b THEN 'Q2' WHEN trip_count <= c THEN 'Q3'
        WHEN trip_count <= d THEN 'Q4' ELSE 'Q5 (highest)' END AS demand_quintile,
        round(avg(prediction - trip_count), 6) AS mean_residual, count(*)::BIGINT AS n FROM scored, q GROUP BY 1""",
    "airport_errors": EVAL + f" SELECT is_airport, {ERRORS} FROM residuals GROUP BY 1",
    "cv_baseline_mae": EVAL + " SELECT fold::BIGINT AS fold, round(mae, 6) AS mae FROM fold_errors",
    "cv_summary": EVAL + """ SELECT round_even(avg(mae), 3) AS mean, round_even(stddev_pop(mae), 3) AS std, round_even(min(mae), 3) AS min,
      round_even(max(mae), 3) AS max, string_agg(format('{:.3f}', round_even(mae, 3)), ',' ORDER BY fold) AS folds FROM fold_errors""",
    "ab_ttest_stats": EVAL + f""" {PAIR_MOMENTS} FROM (SELECT abs(trip_count - greatest(prediction, 0)) AS ea,
      abs(trip_count - greatest(naive, 0)) AS eb FROM scored)""",
    "ab_compare": BASE + ROW_LAGS + _windows("row_lagged") + f""" {PAIR_MOMENTS} FROM (
      SELECT abs(trip_count - lag_24h) AS ea, abs(trip_count - lag_168h) AS eb FROM windows WHERE part = 'test')""",
    "ab_power": EVAL + """ SELECT round(s, 6) AS pooled_std, n AS n_actual, round(1 / s, 6) AS effect_size,
      ceil(2 * pow((1.959963984540054 + 0.8416212335729143) / (1 / s), 2))::BIGINT AS n_needed,
      n >= ceil(2 * pow((1.959963984540054 + 0.8416212335729143) / (1 / s), 2)) AS powered
      FROM (SELECT stddev_pop(abs_error) AS s, count(*)::BIGINT AS n FROM residuals)""",
    "label_rates": BASE + """, c AS (SELECT * FROM demand WHERE temperature_2m IS NOT NULL),
      e AS (SELECT epoch_us(min(pickup_hour_ts)) AS lo, epoch_us(max(pickup_hour_ts)) AS hi, quantile_cont(trip_count, 0.75) AS q FROM c)
      SELECT CASE WHEN epoch_us(pickup_hour_ts) < lo + (hi - lo) * 0.8::DOUBLE THEN 'train' ELSE 'test' END AS split,
        count(*)::BIGINT AS n, round(avg((trip_count >= q)::INT), 6) AS rate FROM c, e GROUP BY 1""",
    "dispatch_simulation": EVAL + " " + _dispatch("historical_mean", "prediction") + " UNION ALL " + _dispatch("seasonal_naive", "naive"),
    "autocorrelation": _autocorrelation([1, 2, 6, 12, 24, 48, 72, 168], False),
    "autocorrelation_every_zone": _autocorrelation([1, 24, 168], True),
    "autocorrelation_function": _autocorrelation(range(1, 200), False),
    "sequence_windows": BASE + _windows("demand") + f""" SELECT {CELL}, trip_count::DOUBLE AS target, part AS split, steps::BIGINT AS steps,
      history_trips::BIGINT AS history_trips, oldest, newest FROM windows WHERE part IS NOT NULL""",
    "last_24_history": BASE + """ SELECT PULocationID AS zone_id, pickup_hour_ts, trip_count, 25 - back AS step FROM (
      SELECT *, row_number() OVER (PARTITION BY PULocationID ORDER BY pickup_hour_ts DESC) AS back,
        count(*) OVER (PARTITION BY PULocationID) AS n FROM demand) WHERE back <= 24 AND n >= 24""",
    "short_histories": BASE + " SELECT PULocationID AS zone_id, count(*)::BIGINT AS rows FROM demand GROUP BY 1 HAVING count(*) < 600",
    "latest_model_version": EVAL + """ SELECT id, name, trained_at, mae, mape FROM versions
      QUALIFY row_number() OVER (PARTITION BY name ORDER BY trained_at DESC, id DESC) = 1""",
    "top_zones": BASE + " SELECT PULocationID, sum(trip_count)::BIGINT AS total_trips FROM demand GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
    "worst_zones": EVAL + f" SELECT PULocationID, {ERRORS} FROM residuals GROUP BY 1 ORDER BY avg(abs_error) DESC, 1 LIMIT 5",
    "recent_models": EVAL + " SELECT id, name, trained_at, mae, mape FROM versions ORDER BY trained_at DESC, name LIMIT 20",
    "recent_history": BASE + """ SELECT PULocationID, pickup_hour, pickup_dow, is_holiday, coalesce(snowfall, 0.0) AS snowfall, is_airport
      FROM demand ORDER BY pickup_hour_ts DESC, PULocationID LIMIT 2000""",
    "time_split": EVAL + f" SELECT {CELL}, split FROM parts",
    "trip_time_split": BASE + """, e AS (SELECT epoch_us(min(tpep_pickup_datetime)) AS lo, epoch_us(max(tpep_pickup_datetime)) AS hi FROM clean)
      SELECT CASE WHEN epoch_us(tpep_pickup_datetime) < lo + (hi - lo) * 0.8::DOUBLE THEN 'train' ELSE 'test' END AS split,
        count(*)::BIGINT AS n, min(tpep_pickup_datetime) AS first_ts, max(tpep_pickup_datetime) AS last_ts FROM clean, e GROUP BY 1""",
    "fare_line": BASE + """, e AS (SELECT epoch_us(min(tpep_pickup_datetime)) AS lo, epoch_us(max(tpep_pickup_datetime)) AS hi FROM clean)
      SELECT count(*)::BIGINT AS n, round(regr_slope(fare_amount, trip_distance), 6) AS slope,
        round(regr_intercept(fare_amount, trip_distance), 6) AS intercept
      FROM clean, e WHERE epoch_us(tpep_pickup_datetime) < lo + (hi - lo) * 0.8::DOUBLE""",
    "three_way_split": EVAL + f" SELECT {CELL}, split FROM three",
    "cv_folds": EVAL + """ SELECT fold::BIGINT AS fold, role, count(*)::BIGINT AS n, min(pickup_hour_ts) AS first_ts,
      max(pickup_hour_ts) AS last_ts FROM fold_rows GROUP BY fold, role""",
    "sample_weights": EVAL + f""", z AS (SELECT *, avg(trip_count) OVER (PARTITION BY PULocationID) AS zm, avg(trip_count) OVER () AS am,
        quantile_cont(trip_count, 0.8) OVER () AS q FROM train),
      i AS (SELECT *, 1.0 / (zm / am + 0.1) AS inv FROM z),
      w AS (SELECT *, CASE WHEN trip_count >= q THEN 2.0 ELSE 1.0 END * inv / avg(inv) OVER () AS w FROM i)
      SELECT {CELL}, round(w / avg(w) OVER (), 6) AS sample_weight FROM w""",
    "standardize": EVAL + f""" SELECT {CELL}, round((pickup_hour - hm) / hs, 6) AS pickup_hour_z, round((trip_count - cm) / cs, 6) AS trip_count_z,
      round((is_holiday - im) / ist, 6) AS is_holiday_z FROM demand, (SELECT avg(pickup_hour) AS hm, stddev_pop(pickup_hour) AS hs,
        avg(trip_count) AS cm, stddev_pop(trip_count) AS cs, avg(is_holiday) AS im, stddev_pop(is_holiday) AS ist FROM train)""",
    "conformal_bounds": EVAL + " " + " UNION ALL ".join(
        f"SELECT {c}::DOUBLE AS coverage, round(quantile_cont({gap}, {c}), 6) AS margin, '{scale}' AS scale FROM calibrated "
        "WHERE split = 'calibration'" for c in (0.8, 0.95) for gap, scale in (
            ("abs(trip_count - prediction)", "linear"), ("abs(ln(1 + trip_count) - ln(1 + prediction))", "log"))),
    "interval_coverage": EVAL + " " + _interval(0.8) + " UNION ALL " + _interval(0.95),
    "classification_metrics": EVAL + LABELLED + """, s AS (SELECT prediction, sum(y) AS p, count(*) AS n FROM labelled GROUP BY 1),
      r AS (SELECT *, sum(p) OVER (ORDER BY prediction DESC) AS pf, sum(n) OVER (ORDER BY prediction DESC) AS nf,
        sum(p) OVER () AS pt, sum(n) OVER () AS nt FROM s)
      SELECT round(sum((n - p) * (pf - p + p / 2.0::DOUBLE)) / max(pt * (nt - pt)), 6) AS roc_auc,
        round(sum(p / pt * pf / nf), 6) AS average_precision FROM r""",
    "classification_report": EVAL + LABELLED + " " + _class_report(0, "normal") + " UNION ALL " + _class_report(1, "high_demand"),
    "mutual_information": _mutual_information(),
    "feature_baseline": DRIFT + """ SELECT feature, n, unnest(range(11))::BIGINT AS decile, round(unnest(points), 6) AS breakpoint FROM baseline""",
    "feature_psi": DRIFT + _psi(DRIFT_FEATURES, "d_test") + " SELECT feature, n, round(psi, 6) AS psi FROM psi",
    "drifted_features": DRIFT + _psi(DRIFT_FEATURES, "d_test") + " SELECT feature, n, round(psi, 6) AS psi FROM psi WHERE psi > 0.2",
    "recent_drift": DRIFT + """, inputs AS (SELECT PULocationID, pickup_hour, pickup_dow, is_holiday, coalesce(snowfall, 0.0) AS snowfall,
        is_airport FROM demand ORDER BY pickup_hour_ts DESC, PULocationID LIMIT 2000)""" + _psi(["pickup_hour", "pickup_dow"], "inputs")
    + """ SELECT (SELECT count(*) FROM inputs)::BIGINT AS rows_analyzed, 6::BIGINT AS n_checked,
        (SELECT coalesce(string_agg(feature, ',' ORDER BY feature), '') FROM psi WHERE psi > 0.2) AS drifted, true AS baseline_exists""",
    "output_drift": EVAL + VERSION_DRIFT + """ SELECT name, runs, round(baseline_mae, 6) AS baseline_mae, current_mae,
      round(drift_pct, 6) AS drift_pct, drifted FROM drifted""",
    "retrain_decision": DRIFT + _psi(DRIFT_FEATURES, "d_test") + VERSION_DRIFT + """, reasons AS (
      SELECT v.id, v.name, concat_ws('; ',
        CASE WHEN mae > 7 THEN 'mean error ' || format('{:.2f}', mae) || ' is above 7' END,
        CASE WHEN mape > 0.15 THEN 'percentage error ' || format('{:.2f}', mape * 100) || '% is above 15.00%' END,
        CASE WHEN d.drifted THEN 'errors rose against earlier runs' END,
        (SELECT 'inputs have shifted: ' || string_agg(feature, ', ' ORDER BY feature) FROM psi WHERE psi > 0.2)) AS reasons
      FROM versions v JOIN drifted d USING (name))
      SELECT id, name, length(reasons) > 0 AS retrain, reasons FROM reasons""",
    "request_features": BASE + """, requests AS (SELECT PULocationID AS zone_id, pickup_hour_ts + INTERVAL 1 DAY
        + to_minutes(CAST(PULocationID % 60 AS INTEGER)) AS prediction_time FROM demand),
      r AS (SELECT *, date_trunc('hour', prediction_time) AS hts FROM requests)
      SELECT r.zone_id, prediction_time, r.zone_id AS PULocationID, hour(hts)::BIGINT AS pickup_hour,
        (isodow(hts) - 1)::BIGINT AS pickup_dow, week(hts)::BIGINT AS pickup_week, (h.date IS NOT NULL)::BIGINT AS is_holiday,
        coalesce(w.snowfall, 0.0) AS snowfall, coalesce(a.trip_count, 0)::DOUBLE AS lag_24h, coalesce(b.trip_count, 0)::DOUBLE AS lag_168h,
        (r.zone_id IN (1, 132, 138))::BIGINT AS is_airport, (e.zone_id IS NOT NULL)::BIGINT AS is_nyc_event
      FROM r LEFT JOIN weather w ON w.pickup_hour_ts = hts LEFT JOIN holidays h ON h.date = hts::DATE
      LEFT JOIN event_pairs e ON e.event_date = hts::DATE AND e.zone_id = r.zone_id
      LEFT JOIN demand a ON a.PULocationID = r.zone_id AND a.pickup_hour_ts + INTERVAL 24 HOUR = hts
      LEFT JOIN demand b ON b.PULocationID = r.zone_id AND b.pickup_hour_ts + INTERVAL 168 HOUR = hts""",
    "stream_hourly_demand": BASE + """ SELECT PULocationID, pickup_hour_ts, trip_count,
      pickup_hour_ts + INTERVAL 1 HOUR <= (SELECT to_timestamp(max(epoch_us(tpep_pickup_datetime)) / 1000000.0::DOUBLE)::TIMESTAMP
        FROM clean) - INTERVAL 2 HOUR AS closed FROM cells""",
    "stream_psi": BASE + _baseline(["fare_amount", "trip_distance"], "clean") + _psi(["fare_amount", "trip_distance"], "trips")
    + " SELECT feature, n, round(psi, 6) AS psi FROM psi",
    "stream_history_state": BASE + " SELECT PULocationID, pickup_hour_ts, trip_count FROM cells",
    "stream_history": BASE + " SELECT PULocationID, pickup_hour_ts, trip_count FROM cells",
}
