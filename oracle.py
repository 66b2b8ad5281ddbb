"""DuckDB SQL for every registered query: an independent statement of the
same semantics, used as the correctness oracle at small scale.

Conventions shared with the Spark side: the ``trips`` fixture is derived
from ``lineitem``; averages are rounded as decimals (first to 9 places), money is
summed as decimals; DuckDB's BIGINT / HUGEINT results are cast to
the Spark types; day of week is shifted to 1 = Sunday; quantiles are
``quantile_disc``.
"""

from __future__ import annotations

IQR_COLS = ("trip_distance", "fare_amount", "total_amount")
DEFAULT_MS = (1.5, 2.0, 2.5, 3.0)
ALL_MS = (0.05, 0.1, 0.25, 0.5, 1.5, 2.0, 2.5, 3.0)

TRIP_COLS = (
    "l_orderkey, l_linenumber, VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, "
    "trip_distance, fare_amount, tip_amount, total_amount, payment_type, PULocationID, DOLocationID"
)

_OFF = "((l_orderkey * 7919 + l_partkey * 613 + l_linenumber * 3571) % 3024000)"
_DUR = "(CASE WHEN l_suppkey % 50 = 7 THEN 30000 ELSE (l_partkey * 37 + l_orderkey * 11) % 4000 - 100 END)"

PLANTED = {
    1: ("tpep_pickup_datetime", "NULL"), 2: ("tpep_dropoff_datetime", "NULL"), 3: ("trip_distance", "NULL"),
    4: ("fare_amount", "NULL"), 5: ("total_amount", "NULL"), 6: ("PULocationID", "NULL"),
    7: ("DOLocationID", "NULL"), 8: ("VendorID", "NULL"), 9: ("fare_amount", "600.0::DOUBLE"),
    10: ("total_amount", "-1.0::DOUBLE"), 11: ("total_amount", "1500.0::DOUBLE"),
    12: ("tip_amount", "-0.5::DOUBLE"), 13: ("passenger_count", "0::BIGINT"),
}


def _planted_columns() -> str:
    out = []
    for c in (x.strip() for x in TRIP_COLS.split(",")):
        cases = "".join(f" WHEN l_partkey % 199 = {k} THEN {v}" for k, (name, v) in PLANTED.items() if name == c)
        out.append(f"CASE{cases} ELSE {c} END AS {c}" if cases else c)
    return ", ".join(out)


TRIPS = f"""mapped AS (
  SELECT l_partkey, l_orderkey, l_linenumber,
    CAST(CASE WHEN l_suppkey % 10 = 0 THEN 6 ELSE 1 + l_suppkey % 2 END AS INTEGER) AS VendorID,
    TIMESTAMP '2025-12-30 00:00:00' + to_seconds({_OFF}) AS tpep_pickup_datetime,
    TIMESTAMP '2025-12-30 00:00:00' + to_seconds({_OFF} + {_DUR}) AS tpep_dropoff_datetime,
    CAST(CASE WHEN l_linenumber = 7 AND l_linestatus = 'O' THEN NULL ELSE l_linenumber END AS BIGINT) AS passenger_count,
    CAST(CASE WHEN l_tax = 0 AND l_linenumber = 1 THEN 0.0::DOUBLE
              WHEN l_partkey % 97 = 0 THEN l_quantity * 5 ELSE l_quantity / 4 END AS DOUBLE) AS trip_distance,
    CASE WHEN l_linenumber = 2 AND l_discount = 0.1::DOUBLE THEN -l_extendedprice / 1000
         ELSE l_extendedprice / 1000 END AS fare_amount,
    l_discount * l_extendedprice / 500 AS tip_amount,
    l_extendedprice / 1000 + l_discount * l_extendedprice / 500 + l_tax * 100 AS total_amount,
    CAST(CASE WHEN l_orderkey % 6 = 5 THEN NULL ELSE l_orderkey % 6 END AS BIGINT) AS payment_type,
    CAST(1 + l_partkey % 40 AS INTEGER) AS PULocationID,
    CAST(1 + l_suppkey % 25 AS INTEGER) AS DOLocationID
  FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 100 = 0) li
),
trips AS (SELECT {_planted_columns()} FROM mapped)"""

SECS = "(floor(epoch(tpep_dropoff_datetime)) - floor(epoch(tpep_pickup_datetime)))"

REQUIRED = """tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
  AND trip_distance IS NOT NULL AND NOT isnan(trip_distance)
  AND fare_amount IS NOT NULL AND NOT isnan(fare_amount)
  AND total_amount IS NOT NULL AND NOT isnan(total_amount)
  AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL
  AND VendorID IS NOT NULL AND passenger_count IS NOT NULL"""

RANGE = """trip_distance > 0 AND trip_distance <= 200 AND fare_amount >= 2.5 AND fare_amount <= 500
  AND total_amount > 0 AND total_amount <= 1000 AND passenger_count >= 1 AND passenger_count <= 6
  AND tip_amount >= 0 AND VendorID IN (1, 2)"""

TIME = f"""tpep_dropoff_datetime > tpep_pickup_datetime AND {SECS} >= 60 AND {SECS} <= 21600
  AND tpep_pickup_datetime >= TIMESTAMP '2026-01-01 00:00:00'
  AND tpep_pickup_datetime < TIMESTAMP '2026-02-01 00:00:00'"""

CLEAN_CTES = f"""{TRIPS},
dedup AS (SELECT DISTINCT * FROM trips),
req AS (SELECT * FROM dedup WHERE {REQUIRED}),
rng AS (SELECT * FROM req WHERE {RANGE}),
tw AS (SELECT * FROM rng WHERE {TIME})"""


def _mtag(m: float) -> str:
    return str(m).replace(".", "_")


def _seq_iqr_ctes(src: str, m: float, cols=IQR_COLS) -> tuple[str, str]:
    """CTEs applying sequential IQR filters with multiplier m; returns (sql, last cte)."""
    t = _mtag(m)
    parts, prev = [], src
    for i, c in enumerate(cols, start=1):
        parts.append(
            f"b{i}_{t} AS (SELECT quantile_disc({c}, 0.25) AS q1, quantile_disc({c}, 0.75) AS q3 FROM {prev})"
        )
        parts.append(
            f"f{i}_{t} AS (SELECT s.* FROM {prev} s, b{i}_{t} b WHERE b.q1 IS NULL OR "
            f"(s.{c} >= b.q1 - {m}::DOUBLE * (b.q3 - b.q1) AND s.{c} <= b.q3 + {m}::DOUBLE * (b.q3 - b.q1)))"
        )
        prev = f"f{i}_{t}"
    return ",\n".join(parts), prev


def _candidates_ctes(ms, name: str = "cand") -> str:
    parts, rows = [], []
    for pos, m in enumerate(ms):
        sql, last = _seq_iqr_ctes("tw", m)
        parts.append(sql)
        rows.append(
            f"SELECT {pos} AS position, {m}::DOUBLE AS multiplier, (SELECT count(*) FROM {last}) AS rows_after"
        )
    union = "\nUNION ALL ".join(rows)
    parts.append(
        f"""{name}_raw AS ({union}),
{name} AS (SELECT CAST(position AS INTEGER) AS position, multiplier, CAST(rows_after AS BIGINT) AS rows_after,
  CAST(n - rows_after AS BIGINT) AS rows_removed,
  CASE WHEN n > 0 THEN rows_after::DOUBLE / n ELSE 0.0 END AS retain_ratio,
  CASE WHEN n > 0 THEN (n - rows_after)::DOUBLE / n ELSE 0.0 END AS remove_ratio
  FROM {name}_raw, (SELECT count(*) AS n FROM tw) t)"""
    )
    return ",\n".join(parts)


def _pick(cand: str, threshold: float) -> str:
    return f"""SELECT * FROM {cand} ORDER BY (retain_ratio >= {threshold}) DESC,
  CASE WHEN retain_ratio >= {threshold} THEN multiplier END ASC NULLS LAST,
  retain_ratio DESC, position ASC LIMIT 1"""


FEATURES = """*,
  round((floor(epoch(tpep_dropoff_datetime)) - floor(epoch(tpep_pickup_datetime))) / 60, 2) AS trip_duration_min,
  CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
  CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
  CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_dayofweek,
  CAST(weekofyear(tpep_pickup_datetime) AS INTEGER) AS pickup_week,
  round(tip_amount / nullif(fare_amount, 0) * 100, 2) AS tip_percentage"""


def _picked_bounds(ms=DEFAULT_MS) -> str:
    rows = []
    for m in ms:
        t = _mtag(m)
        cols = ", ".join(
            f"b{i}.q1 AS q1_{i}, b{i}.q1 - {m}::DOUBLE * (b{i}.q3 - b{i}.q1) AS lo{i}, "
            f"b{i}.q3 + {m}::DOUBLE * (b{i}.q3 - b{i}.q1) AS hi{i}"
            for i in range(1, len(IQR_COLS) + 1)
        )
        rows.append(
            f"SELECT {cols} FROM b1_{t} b1, b2_{t} b2, b3_{t} b3 WHERE (SELECT multiplier FROM pick) = {m}::DOUBLE"
        )
    return "pb AS (" + "\nUNION ALL ".join(rows) + ")"


OUTLIER_KEEP = " AND ".join(
    f"(pb.q1_{i} IS NULL OR (g.{c} >= pb.lo{i} AND g.{c} <= pb.hi{i}))" for i, c in enumerate(IQR_COLS, start=1)
)


def _silver_ctes() -> str:
    cands = _candidates_ctes(DEFAULT_MS)
    picks = "\nUNION ALL ".join(
        f"SELECT * FROM f3_{_mtag(m)} WHERE (SELECT multiplier FROM pick) = {m}::DOUBLE" for m in DEFAULT_MS
    )
    return f"""{CLEAN_CTES},
{cands},
pick AS ({_pick('cand', 0.9)}),
{_picked_bounds()},
kept AS ({picks}),
feat AS (SELECT {FEATURES} FROM kept),
silver AS (SELECT *, round(trip_distance / nullif(trip_duration_min / 60, 0), 2) AS speed_mph FROM feat)"""


def r2(expr: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(28,9)), {digits}) AS DOUBLE)"


def money(column: str) -> str:
    """A sum that no order of additions changes."""
    return f"CAST(round(sum(CAST({column} AS DECIMAL(28,9))), 2) AS DOUBLE)"


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


GOLD = {
    "gold_by_hour": f"""SELECT pickup_hour, count(*) AS total_trips,
  CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
  {r2('avg(trip_distance)')} AS avg_distance_miles, {r2('avg(fare_amount)')} AS avg_fare,
  {money('total_amount')} AS total_revenue, {r2('avg(tip_percentage)')} AS avg_tip_pct,
  {r2('avg(trip_duration_min)')} AS avg_duration_min, {r2('avg(speed_mph)')} AS avg_speed_mph
FROM silver GROUP BY pickup_hour ORDER BY pickup_hour""",
    "gold_by_dayofweek": f"""SELECT pickup_dayofweek, count(*) AS total_trips,
  {r2('avg(trip_distance)')} AS avg_distance, {money('total_amount')} AS total_revenue,
  {r2('avg(fare_amount)')} AS avg_fare, {r2('avg(tip_percentage)')} AS avg_tip_pct,
  CASE pickup_dayofweek WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday'
    WHEN 4 THEN 'Wednesday' WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday' ELSE 'Saturday' END AS day_name
FROM silver GROUP BY pickup_dayofweek ORDER BY pickup_dayofweek""",
    "gold_by_date": f"""SELECT pickup_date, count(*) AS total_trips,
  CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
  {r2('avg(trip_distance)')} AS avg_distance, {money('total_amount')} AS total_revenue,
  {money('fare_amount')} AS total_fare, {money('tip_amount')} AS total_tips,
  {r2('avg(fare_amount)')} AS avg_fare, {r2('avg(tip_percentage)')} AS avg_tip_pct,
  {r2('avg(trip_duration_min)')} AS avg_duration_min
FROM silver GROUP BY pickup_date ORDER BY pickup_date""",
    "gold_by_dow_hour": f"""SELECT pickup_dayofweek, pickup_hour, count(*) AS total_trips,
  {r2('avg(total_amount)')} AS avg_revenue
FROM silver GROUP BY pickup_dayofweek, pickup_hour ORDER BY pickup_dayofweek, pickup_hour""",
    "gold_by_vendor": f"""SELECT VendorID, count(*) AS total_trips,
  CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
  {r2('avg(trip_distance)')} AS avg_distance, {money('total_amount')} AS total_revenue,
  {r2('avg(total_amount)')} AS avg_revenue_per_trip, {r2('avg(fare_amount)')} AS avg_fare,
  {money('tip_amount')} AS total_tips, {r2('avg(tip_percentage)')} AS avg_tip_pct,
  {r2('avg(trip_duration_min)')} AS avg_duration_min, {r2('avg(speed_mph)')} AS avg_speed_mph,
  CASE VendorID WHEN 1 THEN 'Creative Mobile' WHEN 2 THEN 'VeriFone' ELSE 'Unknown' END AS vendor_name
FROM silver GROUP BY VendorID ORDER BY VendorID""",
    "gold_by_payment": f"""SELECT payment_type, count(*) AS total_trips,
  {money('total_amount')} AS total_revenue, {r2('avg(fare_amount)')} AS avg_fare,
  {r2('avg(tip_amount)')} AS avg_tip, {r2('avg(tip_percentage)')} AS avg_tip_pct,
  CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge'
    WHEN 4 THEN 'Dispute' ELSE 'Other' END AS payment_name
FROM silver GROUP BY payment_type ORDER BY total_trips DESC, payment_type NULLS FIRST""",
    "gold_top_pickups": f"""SELECT PULocationID, count(*) AS total_trips,
  {money('total_amount')} AS total_revenue, {r2('avg(trip_distance)')} AS avg_distance,
  {r2('avg(fare_amount)')} AS avg_fare
FROM silver GROUP BY PULocationID ORDER BY total_trips DESC, PULocationID LIMIT 20""",
    "gold_top_routes": f"""SELECT PULocationID, DOLocationID, count(*) AS total_trips,
  {r2('avg(trip_distance)')} AS avg_distance, {r2('avg(total_amount)')} AS avg_revenue,
  {r2('avg(trip_duration_min)')} AS avg_duration
FROM silver GROUP BY PULocationID, DOLocationID
ORDER BY total_trips DESC, PULocationID, DOLocationID LIMIT 50""",
    "silver_summary": f"""SELECT {r2('avg(trip_distance)')} AS avg_trip_distance, {r2('avg(fare_amount)')} AS avg_fare,
  {r2('avg(trip_duration_min)')} AS avg_trip_duration_min, {r2('avg(tip_percentage)')} AS avg_tip_pct,
  {r2('avg(speed_mph)')} AS avg_speed_mph FROM silver""",
}


def _gold_cte(name: str) -> str:
    return f"g_{name} AS ({GOLD[name].replace(chr(10), ' ')})"


PROFILE_NUMERIC = ("passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount")
ALL_TRIP_COLUMNS = [c.strip() for c in TRIP_COLS.split(",")]
FLOAT_COLUMNS = {"trip_distance", "fare_amount", "tip_amount", "total_amount"}
QPROBS = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def _describe() -> str:
    parts = []
    for i, c in enumerate(PROFILE_NUMERIC):
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"""SELECT {i} AS position, '{c}' AS "column", count({x}) AS "count",
  {r2(f'avg({x})', 6)} AS mean, {r2(f'stddev_samp({x})', 6)} AS stddev, min({x}) AS "min", max({x}) AS "max" FROM trips"""
        )
    return _with(TRIPS, "\nUNION ALL ".join(parts))


def _nulls() -> str:
    parts = []
    for i, c in enumerate(ALL_TRIP_COLUMNS):
        nans = f"count(*) FILTER (WHERE isnan({c}))" if c in FLOAT_COLUMNS else "CAST(0 AS BIGINT)"
        parts.append(
            f"""SELECT {i} AS position, '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS nulls, {nans} AS nans FROM trips"""
        )
    return _with(TRIPS, "\nUNION ALL ".join(parts))


def _ranges() -> str:
    parts = []
    for i, c in enumerate(("trip_distance", "fare_amount", "total_amount")):
        parts.append(
            f"""SELECT {i} AS position, '{c}' AS "column", min({c}) AS "min", max({c}) AS "max", {r2(f'avg({c})', 6)} AS "avg" FROM trips"""
        )
    return _with(TRIPS, "\nUNION ALL ".join(parts))


def _quantiles() -> str:
    parts = [
        f"""SELECT '{c}' AS "column", {p}::DOUBLE AS prob, CAST(quantile_disc({c}, {p}) AS DOUBLE) AS "value" FROM trips"""
        for c in ("trip_distance", "fare_amount")
        for p in QPROBS
    ]
    return _with(TRIPS, "\nUNION ALL ".join(parts))


OUT_OF_MONTH = """NOT (tpep_pickup_datetime >= TIMESTAMP '2026-01-01 00:00:00'
  AND tpep_pickup_datetime < TIMESTAMP '2026-02-01 00:00:00')"""


def _issues() -> str:
    checks = [(f"null {c}", "null", f"{c} IS NULL") for c in (
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "fare_amount", "passenger_count", "VendorID")]
    checks += [
        ("distance <= 0", "range", "trip_distance <= 0"),
        ("fare < 0", "range", "fare_amount < 0"),
        ("passengers = 0", "range", "passenger_count = 0"),
        ("dropoff <= pickup", "time", "tpep_dropoff_datetime <= tpep_pickup_datetime"),
        ("outside 2026-01", "time", OUT_OF_MONTH),
    ]
    parts = [
        f"""SELECT {i} AS position, '{name}' AS issue, '{kind}' AS kind, count(*) FILTER (WHERE {cond}) AS "rows" FROM trips"""
        for i, (name, kind, cond) in enumerate(checks)
    ]
    parts.append(
        f"""SELECT {len(checks)} AS position, 'duplicate rows' AS issue, 'duplicate' AS kind,
  (SELECT count(*) FROM trips) - (SELECT count(*) FROM (SELECT DISTINCT * FROM trips)) AS "rows\""""
    )
    body = "SELECT * FROM (" + "\nUNION ALL ".join(parts) + ') WHERE "rows" > 0'
    return _with(TRIPS, body)


def _histogram(lo: float = 0.0, hi: float = 100.0, bins: int = 50) -> str:
    edge = lambda i: f"(CASE WHEN {i} = {bins} THEN mx ELSE CAST({i} AS DOUBLE) * ((mx - mn) / {bins}) + mn END)"
    return _with(
        TRIPS,
        f""",
inside AS (SELECT CAST(fare_amount AS DOUBLE) AS x FROM trips WHERE fare_amount BETWEEN {lo} AND {hi}),
st0 AS (SELECT coalesce(min(x), 0.0) AS mn0, coalesce(max(x), 1.0) AS mx0 FROM inside),
st AS (SELECT CASE WHEN mn0 = mx0 THEN mn0 - 0.5 ELSE mn0 END AS mn,
              CASE WHEN mn0 = mx0 THEN mx0 + 0.5 ELSE mx0 END AS mx FROM st0),
r AS (SELECT x, mn, mx, CAST(trunc((x - mn) / (mx - mn) * {bins}) AS INTEGER) AS raw FROM inside, st),
a AS (SELECT x, mn, mx, CASE WHEN raw = {bins} THEN {bins - 1} ELSE raw END AS i1 FROM r),
b AS (SELECT x, mn, mx, CASE WHEN x < {edge('i1')} THEN i1 - 1 ELSE i1 END AS i2 FROM a),
c AS (SELECT CASE WHEN x >= {edge('(i2 + 1)')} AND i2 <> {bins - 1} THEN i2 + 1 ELSE i2 END AS bin FROM b),
counts AS (SELECT bin, count(*) AS n FROM c GROUP BY bin),
all_bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range({bins}))
SELECT ab.bin, {edge('ab.bin')} AS bin_lo, {edge('(ab.bin + 1)')} AS bin_hi,
  CAST(coalesce(counts.n, 0) AS BIGINT) AS "count"
FROM all_bins ab CROSS JOIN st LEFT JOIN counts ON counts.bin = ab.bin ORDER BY ab.bin""",
    ).replace(f"{TRIPS}\n,", f"{TRIPS},")


def _funnel() -> str:
    tag_sql = f"""CASE WHEN NOT coalesce({REQUIRED.replace(chr(10), ' ')}, false) THEN 1
      WHEN NOT coalesce({RANGE.replace(chr(10), ' ')}, false) THEN 2
      WHEN NOT coalesce({TIME.replace(chr(10), ' ')}, false) THEN 3
      WHEN NOT ({OUTLIER_KEEP}) THEN 4
      ELSE 0 END"""
    return f"""WITH {_silver_ctes()},
grp AS (SELECT {TRIP_COLS}, count(*) AS copies FROM trips GROUP BY ALL),
tagged AS (SELECT g.*, {tag_sql} AS tag FROM grp g CROSS JOIN pb),
s AS (SELECT sum(copies) AS raw, count(*) AS dist,
  count(*) FILTER (WHERE tag = 1) AS r1, count(*) FILTER (WHERE tag = 2) AS r2,
  count(*) FILTER (WHERE tag = 3) AS r3, count(*) FILTER (WHERE tag = 4) AS r4 FROM tagged)
SELECT CAST(step AS INTEGER) AS step, name, CAST(rows_in AS BIGINT) AS rows_in, CAST(rows_out AS BIGINT) AS rows_out,
  CAST(rows_in - rows_out AS BIGINT) AS removed FROM (
  SELECT 0 AS step, 'read' AS name, raw AS rows_in, raw AS rows_out FROM s
  UNION ALL SELECT 1, 'dedupe', raw, dist FROM s
  UNION ALL SELECT 2, 'required', dist, dist - r1 FROM s
  UNION ALL SELECT 3, 'range', dist - r1, dist - r1 - r2 FROM s
  UNION ALL SELECT 4, 'time', dist - r1 - r2, dist - r1 - r2 - r3 FROM s
  UNION ALL SELECT 5, 'outliers', dist - r1 - r2 - r3, dist - r1 - r2 - r3 - r4 FROM s)"""


def _rejects() -> str:
    return f"""WITH {_silver_ctes()},
grp AS (SELECT {TRIP_COLS}, count(*) AS copies FROM trips GROUP BY ALL),
tagged AS (SELECT g.*, CASE WHEN NOT coalesce({REQUIRED.replace(chr(10), ' ')}, false) THEN 'required'
      WHEN NOT coalesce({RANGE.replace(chr(10), ' ')}, false) THEN 'range'
      WHEN NOT coalesce({TIME.replace(chr(10), ' ')}, false) THEN 'time'
      WHEN NOT ({OUTLIER_KEEP}) THEN 'outliers'
      END AS reject_step FROM grp g CROSS JOIN pb)
SELECT {TRIP_COLS}, 'dedupe' AS reject_step, CAST(copies - 1 AS BIGINT) AS copies FROM tagged WHERE copies > 1
UNION ALL
SELECT {TRIP_COLS}, reject_step, CAST(1 AS BIGINT) AS copies FROM tagged WHERE reject_step IS NOT NULL"""


def _bounds(m: float = 3.0) -> str:
    parts = []
    for i, c in enumerate(IQR_COLS, start=1):
        parts.append(
            f"""SELECT {i} AS step, '{c}' AS "column", {m}::DOUBLE AS multiplier, q1, q3, q3 - q1 AS iqr,
  q1 - {m}::DOUBLE * (q3 - q1) AS lower, q3 + {m}::DOUBLE * (q3 - q1) AS upper
FROM (SELECT quantile_disc({c}, 0.25) AS q1, quantile_disc({c}, 0.75) AS q3 FROM tw)"""
        )
    return _with(CLEAN_CTES, "\nUNION ALL ".join(parts))


def _iqr_one(m: float = 1.5) -> str:
    sql, last = _seq_iqr_ctes("tw", m, cols=("trip_distance",))
    return _with(f"{CLEAN_CTES},\n{sql}", f"SELECT * FROM {last}")


def _iqr_all(m: float = 0.25) -> str:
    sql, last = _seq_iqr_ctes("tw", m)
    return _with(f"{CLEAN_CTES},\n{sql}", f"SELECT * FROM {last}")


def _iqr_independent(m: float = 0.25) -> str:
    conds, cte = [], []
    for i, c in enumerate(IQR_COLS, start=1):
        cte.append(f"ib{i} AS (SELECT quantile_disc({c}, 0.25) AS q1, quantile_disc({c}, 0.75) AS q3 FROM tw)")
        conds.append(
            f"{c} >= (SELECT q1 - {m}::DOUBLE * (q3 - q1) FROM ib{i}) AND {c} <= (SELECT q3 + {m}::DOUBLE * (q3 - q1) FROM ib{i})"
        )
    return _with(f"{CLEAN_CTES},\n" + ",\n".join(cte), "SELECT * FROM tw WHERE " + "\n AND ".join(conds))


def _features() -> str:
    return _with(
        f"{CLEAN_CTES},\nfeat AS (SELECT {FEATURES} FROM tw)",
        "SELECT *, round(trip_distance / nullif(trip_duration_min / 60, 0), 2) AS speed_mph FROM feat",
    )


def _gold_report(body: str, *needs: str) -> str:
    ctes = ",\n".join(_gold_cte(n) for n in needs)
    return f"WITH {_silver_ctes()},\n{ctes}\n{body}"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_trips"] = _with(TRIPS, "SELECT * FROM trips")
    q["land_stream"] = q["scan_trips"]
    q["land_report"] = _with(
        TRIPS,
        "SELECT 'landed' AS status, count(*) AS rows_read, count(*) AS rows_written, 13 AS columns, "
        "true AS same_schema, true AS same_content FROM trips",
    )
    q["land_preview"] = _with(TRIPS, "SELECT * FROM trips ORDER BY ALL NULLS FIRST LIMIT 5")
    q["land_skip"] = _with(
        TRIPS,
        "SELECT 'skipped' AS status, CAST(NULL AS BIGINT) AS rows_read, count(*) AS rows_written, 13 AS columns, "
        "true AS same_schema, CAST(NULL AS BOOLEAN) AS same_content FROM trips",
    )
    # profile (bronze)
    q["profile_shape"] = _with(TRIPS, 'SELECT count(*) AS "rows", 13 AS columns FROM trips')
    q["profile_describe"] = _describe()
    q["profile_nulls"] = _nulls()
    q["profile_duplicates"] = _with(
        TRIPS,
        """SELECT "rows", distinct_rows, "rows" - distinct_rows AS duplicates,
  coalesce(round(("rows" - distinct_rows) / nullif("rows", 0) * 100, 2), 0.0) AS duplicate_pct
FROM (SELECT (SELECT count(*) FROM trips) AS "rows", (SELECT count(*) FROM (SELECT DISTINCT * FROM trips)) AS distinct_rows)""",
    )
    q["profile_by_date"] = _with(
        TRIPS,
        'SELECT CAST(tpep_pickup_datetime AS DATE) AS pickup_date, count(*) AS "count" FROM trips GROUP BY 1 ORDER BY 1',
    )
    q["profile_by_hour"] = _with(
        TRIPS,
        'SELECT CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour, count(*) AS "count" FROM trips GROUP BY 1 ORDER BY 1',
    )
    for key, col in (("profile_vendor_dist", "VendorID"), ("profile_payment_dist", "payment_type")):
        q[key] = _with(
            TRIPS,
            f"""SELECT {col}, count(*) AS "count",
  round(count(*) / (SELECT count(*) FROM trips) * 100, 2) AS pct FROM trips GROUP BY {col} ORDER BY {col} NULLS FIRST""",
        )
    q["profile_ranges"] = _ranges()
    q["profile_quantiles"] = _quantiles()
    with_nan = """, odd AS (SELECT CASE WHEN l_orderkey % 7 = 0 THEN 'NaN'::DOUBLE
  WHEN l_orderkey % 7 = 1 THEN 'Infinity'::DOUBLE ELSE trip_distance END AS x FROM trips),
num AS (SELECT x FROM odd WHERE NOT isnan(x))"""
    q["profile_quantiles_nan"] = f"WITH {TRIPS}{with_nan}\n" + "\nUNION ALL ".join(
        f"""SELECT 'trip_distance' AS "column", {p}::DOUBLE AS prob, quantile_disc(x, {p}) AS "value" FROM num"""
        for p in QPROBS
    )
    q["iqr_bounds_nan"] = f"""WITH {TRIPS}{with_nan}
SELECT 1 AS step, 'trip_distance' AS "column", 1.5::DOUBLE AS multiplier, q1, q3, q3 - q1 AS iqr,
  q1 - 1.5::DOUBLE * (q3 - q1) AS lower, q3 + 1.5::DOUBLE * (q3 - q1) AS upper
FROM (SELECT quantile_disc(x, 0.25) AS q1, quantile_disc(x, 0.75) AS q3 FROM num)"""
    q["profile_out_of_month"] = _with(TRIPS, f'SELECT count(*) FILTER (WHERE {OUT_OF_MONTH}) AS "rows" FROM trips')
    q["profile_issues"] = _issues()
    q["profile_fare_histogram"] = _histogram()
    # the same profile operators on other given tables
    q["profile_orders_quantiles"] = "\nUNION ALL ".join(
        f"""SELECT 'o_totalprice' AS "column", {p}::DOUBLE AS prob, CAST(quantile_disc(o_totalprice, {p}) AS DOUBLE) AS "value" FROM orders"""
        for p in QPROBS
    )
    x = "CAST(o_totalprice AS DOUBLE)"
    q["profile_orders_describe"] = f"""SELECT 0 AS position, 'o_totalprice' AS "column", count({x}) AS "count",
  {r2(f'avg({x})', 6)} AS mean, {r2(f'stddev_samp({x})', 6)} AS stddev, min({x}) AS "min", max({x}) AS "max" FROM orders"""
    events = (("event_id", False), ("ts", False), ("user_id", False), ("event_type", False), ("value", True), ("props", False))
    q["profile_events_nulls"] = "\nUNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS nulls, """
        + (f"count(*) FILTER (WHERE isnan({c}))" if is_float else "CAST(0 AS BIGINT)")
        + " AS nans FROM events"
        for i, (c, is_float) in enumerate(events)
    )
    # cleaning
    q["clean_dedupe"] = _with(CLEAN_CTES, "SELECT * FROM dedup")
    q["clean_required"] = _with(CLEAN_CTES, "SELECT * FROM req")
    q["clean_rules"] = _with(CLEAN_CTES, "SELECT * FROM rng")
    q["clean_time_window"] = _with(CLEAN_CTES, "SELECT * FROM tw")
    q["clean_time_window_feb"] = q["clean_time_window"].replace("'2026-02-01", "'2026-03-01").replace(
        "'2026-01-01", "'2026-02-01"
    )
    q["clean_funnel"] = _funnel()
    q["clean_rejects"] = _rejects()
    # outliers
    q["iqr_bounds"] = _bounds(3.0)
    q["iqr_filter_one"] = _iqr_one(1.5)
    q["iqr_filter_all"] = _iqr_all(0.25)
    q["iqr_filter_independent"] = _iqr_independent(0.25)
    q["iqr_candidates"] = f"WITH {CLEAN_CTES},\n{_candidates_ctes(ALL_MS)}\nSELECT * FROM cand"
    q["iqr_pick"] = f"WITH {CLEAN_CTES},\n{_candidates_ctes(DEFAULT_MS)}\n{_pick('cand', 0.9)}"
    q["iqr_pick_fallback"] = f"WITH {CLEAN_CTES},\n{_candidates_ctes(DEFAULT_MS)}\n{_pick('cand', 0.995)}"
    q["clean_outliers"] = f"WITH {_silver_ctes()}\nSELECT * FROM kept"
    q["features"] = _features()
    q["silver"] = f"WITH {_silver_ctes()}\nSELECT * FROM silver"
    q["silver_roundtrip"] = q["silver"]
    q["sketch_quantiles"] = f"""WITH {_silver_ctes()}
SELECT c.col AS "column", CAST(p.prob AS DOUBLE) AS prob, (SELECT count(*) FROM silver) AS "rows", true AS within
FROM (VALUES ('trip_distance'), ('fare_amount'), ('total_amount')) c(col),
     (VALUES (0.1), (0.25), (0.5), (0.75), (0.9), (0.95), (0.99)) p(prob)"""
    # gold
    for key, body in GOLD.items():
        q[key] = f"WITH {_silver_ctes()}\n{body}"
    q["gold_by_date_single"] = q["gold_by_date"]
    q["heavy_pickups"], q["heavy_routes"] = q["gold_top_pickups"], q["gold_top_routes"]
    # reports
    q["report_layers"] = f"""WITH {_silver_ctes()}
SELECT original_rows, cleaned_rows, original_rows - cleaned_rows AS removed,
  round((original_rows - cleaned_rows) / nullif(original_rows, 0) * 100, 1) AS removed_pct
FROM (SELECT (SELECT count(*) FROM trips) AS original_rows, (SELECT count(*) FROM silver) AS cleaned_rows)"""
    q["report_vendor"] = _gold_report(
        "SELECT vendor_name, total_trips, total_revenue, avg_fare, avg_tip_pct FROM g_gold_by_vendor", "gold_by_vendor"
    )
    q["report_payment"] = _gold_report(
        "SELECT * FROM g_gold_by_payment ORDER BY total_trips DESC, payment_type NULLS FIRST", "gold_by_payment"
    )
    q["report_top_hours"] = _gold_report(
        "SELECT * FROM g_gold_by_hour ORDER BY total_trips DESC, pickup_hour LIMIT 5", "gold_by_hour"
    )
    q["report_first_dates"] = _gold_report(
        "SELECT * FROM g_gold_by_date ORDER BY pickup_date LIMIT 5", "gold_by_date"
    )
    q["busy_hours_top10"] = f"""WITH {_silver_ctes()}
SELECT pickup_hour, count(*) AS "count" FROM silver GROUP BY pickup_hour ORDER BY "count" DESC, pickup_hour LIMIT 10"""
    cells = ", ".join(
        f"max(CASE WHEN pickup_hour = {h} THEN total_trips END) AS h{h:02d}" for h in range(24)
    )
    q["heatmap_matrix"] = _gold_report(
        f"SELECT pickup_dayofweek, {cells} FROM g_gold_by_dow_hour GROUP BY pickup_dayofweek ORDER BY pickup_dayofweek",
        "gold_by_dow_hour",
    )
    q["payment_share"] = _gold_report(
        """SELECT payment_type, total_trips,
  coalesce(CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge'
    WHEN 4 THEN 'Dispute' END, CAST(payment_type AS VARCHAR)) AS display_name,
  round(total_trips / (SELECT sum(total_trips) FROM g_gold_by_payment) * 100, 1) AS share_pct
FROM g_gold_by_payment ORDER BY total_trips DESC, payment_type NULLS FIRST""",
        "gold_by_payment",
    )
    return q
