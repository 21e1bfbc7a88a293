"""DuckDB SQL for every registered query, over the driver's tables."""

from __future__ import annotations

# Fixed values, written out here as well, so that a wrong name in the engine does not pass.
ZONE_NAMES = {
    48: "Clinton East", 68: "East Chelsea", 79: "East Harlem North", 90: "Financial District North",
    132: "JFK Airport", 138: "LaGuardia Airport", 140: "Lenox Hill West", 141: "Lenox Hill East",
    142: "Lincoln Square East", 161: "Midtown Center", 162: "Midtown East", 163: "Midtown North",
    164: "Midtown South", 170: "Murray Hill", 186: "Penn Station/Madison Sq West",
    230: "Times Sq/Theatre District", 234: "Union Sq", 236: "Upper East Side North",
    237: "Upper East Side South", 239: "Upper West Side North",
}
DISPLAY_NAMES = {
    "trip_duration_min": "Trip Duration", "trip_distance": "Trip Distance", "fare_amount": "Fare Amount",
    "tip_amount": "Tip Amount", "total_amount": "Total Amount", "passenger_count": "Passenger Count",
    "temp": "Temperature", "precip": "Precipitation", "hour": "Hour of Day",
}
PAYMENT_NAMES = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute", 5: "Unknown", 6: "Voided Trip"}
CORRELATED = (
    "trip_duration_min", "trip_distance", "fare_amount", "tip_amount", "total_amount", "passenger_count",
    "temp", "precip", "hour",
)

MONEY = "fare_amount, tip_amount, total_amount, extra, tolls_amount, congestion_surcharge, mta_tax"
CHARGES = "fare_amount + extra + mta_tax + tolls_amount + congestion_surcharge + tip_amount"
START, END = "TIMESTAMP '2024-01-02 00:00:00'", "TIMESTAMP '2024-03-28 23:59:59'"
HOURS = "(date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / 1e6 / 3600e0)"


def half_up(x: str, name: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), 2) AS DOUBLE) AS {name}"


def even(x: str, digits: int = 2) -> str:
    return f"(round_even(({x}) * 1e{digits}, 0) / 1e{digits} + 0e0)"


RULES = {
    "negative fare_amount": "fare_amount >= 0",
    "negative tip_amount": "tip_amount >= 0",
    "negative total_amount": "total_amount >= 0",
    "negative trip_distance": "trip_distance >= 0",
    "negative extra": "extra >= 0",
    "negative tolls_amount": "tolls_amount >= 0",
    "negative congestion_surcharge": "congestion_surcharge >= 0",
    "negative mta_tax": "mta_tax >= 0",
    "negative passenger_count": "passenger_count >= 0",
    "passenger count": "passenger_count > 0 AND passenger_count <= 6",
    "pickup date": f"tpep_pickup_datetime BETWEEN {START} AND {END}",
    "distance, duration or speed": (
        f"trip_distance BETWEEN 0.01e0 AND 50e0 AND {HOURS} BETWEEN 0 AND 4 AND trip_distance / nullif({HOURS}, 0) <= 100"
    ),
    "charges": f"total_amount + 1 >= {CHARGES} AND NOT (fare_amount = 0 AND {CHARGES} > 0)",
    "payment type": "payment_type IN (1, 2, 3, 4, 5, 6)",
    "rate code RatecodeID": "RatecodeID IN (1, 2, 3, 4, 5, 6)",
    "location PULocationID": "PULocationID BETWEEN 1 AND 265",
    "location DOLocationID": "DOLocationID BETWEEN 1 AND 265",
}


def metrics(source: str) -> str:
    return f"""SELECT *,
        {even("date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / 1e6 / 60e0")} AS trip_duration_min,
        CASE WHEN fare_amount = 0 THEN 0e0 ELSE {even("tip_amount / fare_amount * 100e0")} END AS tip_percentage
      FROM {source}"""


def dim_datetime(source: str) -> str:
    return f"""SELECT CAST(row_number() OVER (ORDER BY h) AS BIGINT) AS datetime_id, h AS full_datetime,
        CAST(h AS DATE) AS date, CAST(day(h) AS INTEGER) AS day, CAST(month(h) AS INTEGER) AS month,
        CAST(quarter(h) AS INTEGER) AS quarter, CAST(year(h) AS INTEGER) AS year,
        CAST(weekofyear(h) AS INTEGER) AS week, CAST(hour(h) AS INTEGER) AS hour,
        CASE WHEN month(h) IN (12, 1, 2) THEN 'Winter' WHEN month(h) IN (3, 4, 5) THEN 'Spring'
             WHEN month(h) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season
      FROM (SELECT DISTINCT CAST(date_trunc('hour', tpep_pickup_datetime) AS TIMESTAMP) AS h FROM {source}
            WHERE tpep_pickup_datetime IS NOT NULL)"""


ORDERED_MONEY = ", ".join(f"{c.strip()} NULLS FIRST" for c in MONEY.split(","))
SAME_MONEY = " AND ".join(f"f.{c.strip()} IS NOT DISTINCT FROM d.{c.strip()}" for c in MONEY.split(","))
STAR = "fact f JOIN dim_datetime d ON f.datetime_id = d.datetime_id"
DOW = "CAST(dayofweek(d.full_datetime) AS INTEGER)"
YEAR = "d.year >= 2024"
AVERAGE = half_up("avg(f.trip_duration_min)", "avg_duration")

TABLES: dict[str, str] = {
    "trips": """SELECT *, fare_amount + extra + mta_tax + tip_amount + tolls_amount + congestion_surcharge
          - (CASE WHEN event_id % 59 = 0 THEN 5e0 ELSE 0e0 END) AS total_amount
      FROM (SELECT event_id, CAST(1 + event_id % 2 AS INTEGER) AS VendorID,
          ts + to_days(CAST(event_id % 3 AS INTEGER) * 30) AS tpep_pickup_datetime,
          ts + to_days(CAST(event_id % 3 AS INTEGER) * 30) + to_seconds(
            CASE WHEN event_id % 41 = 0 THEN 16200 WHEN event_id % 97 = 0 THEN 0
                 ELSE (event_id * 7919) % 5400 - 30 END) AS tpep_dropoff_datetime,
          CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST(event_id % 8 AS DOUBLE) END AS passenger_count,
          CASE WHEN event_id % 61 = 0 THEN 55e0 ELSE floor(value * 8) / 128e0 END AS trip_distance,
          CASE WHEN event_id % 53 = 0 THEN 99e0 ELSE CAST(1 + event_id % 6 AS DOUBLE) END AS RatecodeID,
          CASE WHEN event_id % 71 = 0 THEN 0 ELSE CAST(1 + user_id % 265 AS INTEGER) END AS PULocationID,
          CAST(1 + (event_id * 13) % 265 AS INTEGER) AS DOLocationID,
          CAST(event_id % 7 AS BIGINT) AS payment_type,
          CASE WHEN event_id % 43 = 0 THEN -5e0 WHEN event_id % 47 = 0 THEN 0e0
               ELSE floor(value / 5) + 3e0 END AS fare_amount,
          CAST(event_id % 3 AS DOUBLE) * 0.5e0 AS extra, 0.5e0 AS mta_tax, CAST(event_id % 5 AS DOUBLE) AS tip_amount,
          CASE WHEN event_id % 10 = 0 THEN 6.5e0 ELSE 0e0 END AS tolls_amount, 2.5e0 AS congestion_surcharge
        FROM events) b""",
    "clean": "SELECT * FROM trips WHERE " + " AND ".join(f"({r})" for r in RULES.values()),
    "derived": metrics("clean"),
    "dim_datetime": dim_datetime("clean"),
    "dim_fare": f"""SELECT CAST(row_number() OVER (ORDER BY {ORDERED_MONEY}) AS BIGINT) AS fare_id, *
      FROM (SELECT DISTINCT {MONEY} FROM clean)""",
    "fact": f"""SELECT f.* EXCLUDE ({MONEY}), h.datetime_id, d.fare_id
      FROM derived f
      LEFT JOIN dim_datetime h ON date_trunc('hour', f.tpep_pickup_datetime) = h.full_datetime
      LEFT JOIN dim_fare d ON {SAME_MONEY}""",
    "weather": """SELECT 0 AS source_order, CASE WHEN eh % 101 = 0 THEN 'n/a' ELSE iso END AS datetime,
        CASE WHEN eh % 29 = 0 THEN NULL ELSE CAST((eh * 7) % 45 - 10 AS DOUBLE) END AS temp,
        CAST(eh % 11 AS DOUBLE) * 0.125e0 AS precip, CAST(40 + eh % 50 AS DOUBLE) AS humidity,
        CASE eh % 5 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Rain' WHEN 2 THEN 'Overcast' WHEN 3 THEN 'Snow'
                    ELSE 'Partially cloudy' END AS conditions
      FROM weather_hours
      UNION ALL
      SELECT 1, iso, 99e0, 0e0, 0e0, 'Duplicate' FROM weather_hours WHERE eh % 50 = 0""",
    "matched": """SELECT w.*, d.datetime_id FROM weather w
      JOIN dim_datetime d ON TRY_CAST(w.datetime AS TIMESTAMP) = d.full_datetime""",
    "dim_weather": """SELECT datetime_id, temp, humidity, precip, conditions FROM (
        SELECT *, row_number() OVER (PARTITION BY datetime_id ORDER BY source_order) AS place FROM matched)
      WHERE place = 1""",
    "lookup": """SELECT CAST(s_suppkey + 1 AS INTEGER) AS LocationID, n_name AS Borough, s_name AS Zone,
        CASE WHEN s_suppkey % 2 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone
      FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "built_in": "SELECT * FROM (VALUES "
    + ", ".join(f"({k}, '{v}')" for k, v in ZONE_NAMES.items())
    + ") AS t(zone_id, zone_text)",
    "monthly": f"""SELECT d.year, d.month, {AVERAGE}, count(*) AS trip_count FROM {STAR} WHERE {YEAR} GROUP BY 1, 2""",
    "weekday": f"""SELECT {DOW} AS day_of_week, {AVERAGE}, count(*) AS trip_count FROM {STAR} WHERE {YEAR} GROUP BY 1""",
    "heatmap": f"""SELECT d.month, {DOW} AS day_of_week, count(*) AS trip_count FROM {STAR} WHERE {YEAR} GROUP BY 1, 2""",
    "fare_weekday": f"""SELECT {DOW} AS day_of_week, {half_up("sum(m.total_amount)", "total_revenue")},
        {half_up("sum(m.fare_amount)", "total_fare")}, {half_up("sum(m.tip_amount)", "total_tip")}
      FROM {STAR} JOIN dim_fare m ON f.fare_id = m.fare_id WHERE {YEAR} GROUP BY 1""",
    "hourly": f"""SELECT d.hour, count(*) AS trip_count, {AVERAGE} FROM {STAR} WHERE {YEAR} GROUP BY 1""",
    "top_pickup": f"""SELECT f.PULocationID AS pulocationid, count(*) AS trip_count FROM {STAR} WHERE {YEAR}
      GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "payment": f"""SELECT f.payment_type, CASE f.payment_type
        {" ".join(f"WHEN {k} THEN '{v}'" for k, v in PAYMENT_NAMES.items())} ELSE 'Other' END AS payment_name,
        count(*) AS trip_count
      FROM {STAR} WHERE {YEAR} GROUP BY 1, 2""",
    "weather_trips": f"""SELECT w.*, f.datetime_id AS trip, d.full_datetime
      FROM dim_weather w LEFT JOIN fact f ON f.datetime_id = w.datetime_id
      JOIN dim_datetime d ON w.datetime_id = d.datetime_id WHERE {YEAR}""",
    "correlation": f"""SELECT f.trip_duration_min, f.trip_distance, m.fare_amount, m.tip_amount, m.total_amount,
        f.passenger_count, w.temp, w.precip, d.hour
      FROM {STAR} JOIN dim_fare m ON f.fare_id = m.fare_id LEFT JOIN dim_weather w ON f.datetime_id = w.datetime_id
      WHERE {YEAR} AND f.trip_duration_min IS NOT NULL AND f.trip_distance IS NOT NULL
        AND m.fare_amount IS NOT NULL AND m.tip_amount IS NOT NULL""",
    "clustering": f"""SELECT f.trip_duration_min, f.trip_distance, d.hour, {DOW} AS day_of_week, m.fare_amount,
        m.total_amount, m.tip_amount, f.event_id
      FROM {STAR} JOIN dim_fare m ON f.fare_id = m.fare_id
      WHERE {YEAR} AND f.trip_duration_min > 0 AND f.trip_duration_min < 180
        AND f.trip_distance > 0 AND f.trip_distance < 100 AND m.fare_amount > 0""",
    "pickup_counts": f"SELECT f.PULocationID AS location_id, count(*) AS trip_count FROM {STAR} WHERE {YEAR} GROUP BY 1",
    "dropoff_counts": f"SELECT f.DOLocationID AS location_id, count(*) AS trip_count FROM {STAR} WHERE {YEAR} GROUP BY 1",
    "labelled": """SELECT c.location_id, c.trip_count,
        coalesce(l.Zone || ' (' || l.Borough || ')', b.zone_text, 'Zone ' || c.location_id) AS zone_label
      FROM pickup_counts c LEFT JOIN lookup l ON c.location_id = l.LocationID
      LEFT JOIN built_in b ON c.location_id = b.zone_id""",
    "assigned": """SELECT *, CASE WHEN
          (trip_duration_min - 60e0) * (trip_duration_min - 60e0) + (fare_amount - 32e0) * (fare_amount - 32e0)
            + (trip_distance - 8e0) * (trip_distance - 8e0)
          < (trip_duration_min - 20e0) * (trip_duration_min - 20e0) + (fare_amount - 8e0) * (fare_amount - 8e0)
            + (trip_distance - 2e0) * (trip_distance - 2e0) THEN 1 ELSE 0 END AS trip_cluster
      FROM clustering""",
    "levels": """SELECT trip_cluster, (avg(trip_duration_min) + avg(fare_amount) + avg(trip_distance)) / 3e0 AS level
      FROM assigned GROUP BY 1""",
    "named": """SELECT a.*, CASE WHEN l.level = (SELECT min(level) FROM levels) THEN 'Economy / Short Trips'
          ELSE 'Premium / Long Trips' END AS trip_type
      FROM assigned a JOIN levels l ON a.trip_cluster = l.trip_cluster""",
    "customers": """SELECT c_custkey AS k, CAST(1 + c_custkey % 265 AS INTEGER) AS id,
        -74e0 + CAST(c_custkey % 512 AS DOUBLE) / 1024e0 AS x,
        40.5e0 + CAST((c_custkey * 7) % 512 AS DOUBLE) / 1024e0 AS y,
        CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_custkey % 37 = 0 THEN 'Point'
             WHEN c_custkey % 3 = 0 THEN 'Polygon' ELSE 'MultiPolygon' END AS geometry_type
      FROM customer""",
    "features": """SELECT *, CASE WHEN k % 19 = 0 OR k % 23 = 0 OR k % 29 = 0 THEN NULL ELSE id END AS location_id,
        CASE WHEN k % 19 = 0 THEN 'x' WHEN k % 23 = 0 OR k % 29 = 0 THEN NULL ELSE CAST(id AS VARCHAR) END AS location_text,
        CASE WHEN geometry_type = 'Polygon' THEN x + 0.125e0 WHEN geometry_type = 'MultiPolygon' THEN x + 0.25e0 END AS lon,
        CASE WHEN geometry_type = 'Polygon' THEN y + 0.125e0 WHEN geometry_type = 'MultiPolygon' THEN y + 0.25e0 END AS lat
      FROM customers""",
    "centroids": """SELECT location_id, lon, lat FROM (
        SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY k DESC) AS place FROM features
        WHERE location_id IS NOT NULL AND lon IS NOT NULL) WHERE place = 1""",
    "vertices": """SELECT CAST(c_nationkey + 1 AS BIGINT) AS feature_id,
        CASE WHEN (c_nationkey + 1) % 3 = 0 THEN 0 ELSE CAST(c_custkey % 2 AS INTEGER) END AS part, c_custkey AS seq,
        CAST(913000 + (c_custkey * 37) % 150000 AS DOUBLE) AS x, CAST(120000 + (c_custkey * 53) % 150000 AS DOUBLE) AS y
      FROM customer""",
}
TABLES = {
    **{k: v for k, v in TABLES.items() if k != "weather"},
    "weather_hours": """SELECT dayofyear(h) * 24 + hour(h) AS eh, strftime(h, '%Y-%m-%dT%H:%M:%S') AS iso
      FROM (SELECT DISTINCT CAST(date_trunc('hour', tpep_pickup_datetime) AS TIMESTAMP) AS h FROM trips)
      WHERE (dayofyear(h) * 24 + hour(h)) % 17 <> 0""",
    "weather": TABLES["weather"],
}


def _needs(sql: str) -> list[str]:
    import re

    words = set(re.findall(r"\b(?:FROM|JOIN)\s+([a-z_]+)", sql))
    return [name for name in TABLES if name in words]


def statement(body: str) -> str:
    """The body with the tables it uses, in order of dependency, in front."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in _needs(sql):
            if name not in ordered:
                visit(TABLES[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({TABLES[name]})" for name in ordered) + "\n" + body


def _points(ring_x: float, axis_start: int) -> list[tuple[int, str, str]]:
    s = ring_x
    corners = [("x", "y"), (f"x + {s}e0", "y"), (f"x + {s}e0", f"y + {s}e0"), ("x", "y")]
    return [(axis_start + i, cx, cy) for i, (cx, cy) in enumerate(corners)]


def points_sql() -> str:
    parts = [
        f"SELECT k, {i} AS position, {x} AS lon, {y} AS lat FROM features WHERE geometry_type IN ('Polygon', 'MultiPolygon')"
        for i, x, y in _points(0.25, 0)
    ] + [
        f"SELECT k, {i} AS position, {x} AS lon, {y} AS lat FROM features WHERE geometry_type = 'MultiPolygon'"
        for i, x, y in _points(0.5, 4)
    ]
    return " UNION ALL ".join(parts)


def projected_sql() -> str:
    """The inverse projection from its published definition (EPSG:2263, GRS 80), all of it in SQL.

    m and t are Snyder's auxiliary functions of a latitude.
    """
    e = "sqrt(2 / 298.257222101e0 - 1 / (298.257222101e0 * 298.257222101e0))"

    def m(latitude: str) -> str:
        return f"(cos(radians({latitude})) / sqrt(1 - pow({e} * sin(radians({latitude})), 2)))"

    def t(latitude: str) -> str:
        s = f"{e} * sin(radians({latitude}))"
        return f"(tan(pi() / 4 - radians({latitude}) / 2) / pow((1 - {s}) / (1 + {s}), {e} / 2))"

    south, north, origin = "(40 + 40 / 60e0)", "(41 + 2 / 60e0)", "(40 + 10 / 60e0)"
    constants = f"""SELECT *, 6378137e0 * {m(south)} / (n * pow({t(south)}, n)) AS radius_unit FROM (
        SELECT (ln({m(south)}) - ln({m(north)})) / (ln({t(south)}) - ln({t(north)})) AS n)"""
    steps = f"""SELECT feature_id, part, seq, t, theta, pi() / 2 - 2 * atan(t) AS p0 FROM (
        SELECT *, pow(sqrt(east * east + north * north) / radius_unit, 1 / n) AS t, atan2(east, north) / n AS theta
        FROM (SELECT v.*, c.*, x * (1200 / 3937e0) - 300000 AS east,
                c.radius_unit * pow({t(origin)}, c.n) - y * (1200 / 3937e0) AS north FROM vertices v, ({constants}) c))"""
    for i in range(5):
        s = f"{e} * sin(p{i})"
        steps = f"SELECT *, pi() / 2 - 2 * atan(t * pow((1 - {s}) / (1 + {s}), {e} / 2)) AS p{i + 1} FROM ({steps})"
    return f"""SELECT feature_id, part, seq, {even(f"degrees(theta) - 74e0", 6)} AS lon,
        {even(f"degrees(p5)", 6)} AS lat FROM ({steps})"""


def correlation_sql() -> str:
    def pearson(x: str, y: str) -> str:
        both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
        a = f"stddev_pop({x}) FILTER (WHERE {both})"
        b = f"stddev_pop({y}) FILTER (WHERE {both})"
        return f"covar_pop({y}, {x}) / nullif({a} * {b}, 0)"

    cells = [
        f"SELECT {i + 1} AS row_no, {j + 1} AS col_no, '{x}' AS variable, '{y}' AS other, {pearson(x, y)} AS r FROM correlation"
        for i, x in enumerate(CORRELATED)
        for j, y in enumerate(CORRELATED)
    ]
    return " UNION ALL ".join(cells)


def _display(column: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DISPLAY_NAMES.items())
    return f"CASE {column} {cases} ELSE {column} END AS {column}"


def _keep(rule: str) -> str:
    return statement(f"SELECT event_id FROM trips WHERE {rule}")


def _removals() -> str:
    cases = " ".join(f"WHEN NOT coalesce(({rule}), false) THEN {i + 1}" for i, rule in enumerate(RULES.values()))
    names = ", ".join(f"({i + 1}, '{name}')" for i, name in enumerate(RULES))
    return statement(
        f"""SELECT CAST(r.rule_no AS INTEGER) AS rule_no, r.rule, count(t.event_id) AS removed
        FROM (VALUES {names}) AS r(rule_no, rule)
        LEFT JOIN (SELECT event_id, CASE {cases} END AS failed FROM trips) t ON t.failed = r.rule_no GROUP BY 1, 2"""
    )


def _checks(rows: list[tuple[str, str]]) -> str:
    parts = [
        f"SELECT CAST({i + 1} AS INTEGER) AS check_no, '{name}' AS check_name, CAST(({sql}) AS BIGINT) AS violations"
        for i, (name, sql) in enumerate(rows)
    ]
    return statement(f"SELECT *, violations = 0 AS passed FROM ({' UNION ALL '.join(parts)})")


LATE = "TIMESTAMP '2024-01-05 00:00:00'"
EARLY = "TIMESTAMP '2024-03-20 23:59:59'"


def _outside(column: str) -> str:
    return f"({column} < {LATE} OR {column} > {EARLY})"


ROW_COUNT = ("row_count", "SELECT abs((SELECT count(*) FROM trips) - (SELECT count(*) FROM fact))")
COVERAGE = (
    "hour_coverage",
    """SELECT count(*) FROM (SELECT DISTINCT date_trunc('hour', tpep_pickup_datetime) AS h FROM trips)
       WHERE h NOT IN (SELECT full_datetime FROM dim_datetime)""",
)
INPUT_RANGE = ("input_range", f"SELECT count(*) FROM trips WHERE {_outside('tpep_pickup_datetime')}")
HOUR_RANGE = ("hour_range", f"SELECT count(*) FROM dim_datetime WHERE {_outside('full_datetime')}")
FACT_RANGE = (
    "fact_range",
    f"SELECT count(*) FROM fact f LEFT JOIN dim_datetime d ON f.datetime_id = d.datetime_id WHERE {_outside('full_datetime')}",
)
CHECKED = (
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "extra",
    "tolls_amount",
    "congestion_surcharge",
    "mta_tax",
    "trip_duration_min",
)


def _non_negative() -> str:
    raw = metrics("trips")
    rows = [(f"non_negative fact {c}", f"SELECT count(*) FROM ({raw}) WHERE {c} < 0") for c in CHECKED]
    rows += [
        (f"non_negative fare {c}", f"SELECT count(*) FROM (SELECT DISTINCT {MONEY} FROM trips) WHERE {c} < 0")
        for c in CHECKED
        if c in MONEY
    ]
    return _checks(rows)


def _all_checks() -> str:
    rows = [ROW_COUNT]
    rows += [
        (f"non_negative fact {c}", f"SELECT count(*) FROM fact WHERE {c} < 0")
        for c in ("passenger_count", "trip_distance", "trip_duration_min")
    ]
    rows += [(f"non_negative fare {c}", f"SELECT count(*) FROM dim_fare WHERE {c} < 0") for c in CHECKED if c in MONEY]
    return _checks([*rows, COVERAGE, INPUT_RANGE, HOUR_RANGE, FACT_RANGE])


def sql() -> dict[str, str]:
    s = statement
    months = (
        "January", "February", "March", "April", "May", "June",
        "July", "August", "September", "October", "November", "December",
    )
    day = "CASE day_of_week " + " ".join(
        f"WHEN {i} THEN '{n}'"
        for i, n in enumerate(("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"))
    ) + " END AS day_name"
    marts = (
        "monthly weekday heatmap fare_weekday hourly top_pickup payment weather_monthly weather_conditions "
        "weather_scatter correlation clustering cluster_data pickup_counts dropoff_counts"
    ).split()
    # Result columns in table order, and the marts that are not tables above.
    bodies = {m: f"SELECT * FROM {m}" for m in marts}
    bodies["clustering"] = "SELECT * EXCLUDE (event_id) FROM clustering"
    bodies["weather_monthly"] = f"""SELECT CAST(date_trunc('month', full_datetime) AS TIMESTAMP) AS year_month,
        {half_up("avg(temp)", "avg_temp")}, {half_up("avg(precip)", "avg_precip")}, count(trip) AS trip_count
      FROM weather_trips GROUP BY 1"""
    bodies["weather_conditions"] = "SELECT conditions, count(trip) AS trip_count FROM weather_trips GROUP BY 1"
    bodies["weather_scatter"] = "SELECT temp, count(trip) AS trip_count FROM weather_trips GROUP BY 1"
    bodies["cluster_data"] = "SELECT tip_amount, fare_amount, trip_distance FROM correlation"
    clean_columns = "event_id, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance"
    result = {
        "s01_trip_files": s("SELECT event_id, VendorID, fare_amount, CASE WHEN event_id % 3 <> 2 THEN congestion_surcharge END AS congestion_surcharge FROM trips"),
        "s02_weather_csv": s("SELECT source_order, datetime, temp, precip, humidity, conditions FROM weather"),
        "s03_zone_lookup": s("SELECT * FROM lookup"),
        "s04_features": s("""SELECT k AS customer, geometry_type, CASE WHEN k % 19 = 0 THEN 'x' WHEN k % 23 = 0 THEN ''
            WHEN k % 29 = 0 THEN '0' WHEN k % 5 = 2 THEN id || '.0' ELSE CAST(id AS VARCHAR) END AS raw_id FROM features"""),
        "s05_dimension_table": s("SELECT * FROM dim_datetime"),
        "s06_fact_table": s("SELECT * FROM fact"),
        "s09_sql": s("SELECT d.season, d.hour, count(*) AS trips, sum(f.trip_distance) AS distance FROM fact f JOIN dim_datetime d ON f.datetime_id = d.datetime_id GROUP BY 1, 2"),
        "s10_all_marts": s(" UNION ALL ".join(f"SELECT '{name}' AS mart, count(*) AS row_count FROM ({bodies[m]})" for m, name in zip(marts, MART_NAMES))),
        "s10_no_weather": s(" UNION ALL ".join(
            f"SELECT '{name}' AS mart, count(*) * {int(not m.startswith('weather'))} AS row_count FROM ({bodies[m]})"
            for m, name in zip(marts, MART_NAMES)
        )),
        "s07_created_tables": s("SELECT count(*) AS hours FROM dim_datetime"),
        "s08_dropped_tables": s("SELECT 'hours' AS name, count(*) AS rows FROM dim_datetime"),
        "c14_absent_columns": s(f"""SELECT event_id FROM trips WHERE passenger_count > 0 AND passenger_count <= 6
            AND tpep_pickup_datetime BETWEEN {START} AND {END} AND payment_type IN (1, 2, 3, 4, 5, 6)"""),
        "t01_required": s("""SELECT c AS columns, c = 'both' AS accepted, (SELECT count(*) FROM trips) AS trips
            FROM (VALUES ('both'), ('no pickup'), ('no dropoff'), ('neither')) v(c)"""),
        "c01_timestamps": s("""SELECT event_id, CASE WHEN event_id % 83 = 0 THEN NULL ELSE tpep_pickup_datetime END AS tpep_pickup_datetime,
            CASE WHEN event_id % 89 = 0 THEN NULL ELSE tpep_dropoff_datetime END AS tpep_dropoff_datetime FROM trips"""),
        "c02_non_negative": _keep(" AND ".join(r for n, r in RULES.items() if n.startswith("negative"))),
        "c03_passengers": _keep(RULES["passenger count"]),
        "c04_pickup_range": _keep(RULES["pickup date"]),
        "c05_distance": _keep("trip_distance BETWEEN 0.01e0 AND 50e0"),
        "c06_duration": _keep(f"{HOURS} BETWEEN 0 AND 4"),
        "c07_speed": _keep(f"trip_distance / nullif({HOURS}, 0) <= 100"),
        "c08_charge_total": _keep(f"total_amount + 1 >= {CHARGES}"),
        "c09_paid_fare": _keep(f"NOT (fare_amount = 0 AND {CHARGES} > 0)"),
        "c10_payment_type": s("SELECT event_id, payment_type FROM trips WHERE payment_type IN (1, 2, 3, 4, 5, 6) AND event_id % 83 <> 0"),
        "c11_rate_code": s("SELECT event_id, CAST(RatecodeID AS BIGINT) AS RatecodeID FROM trips WHERE RatecodeID IN (1, 2, 3, 4, 5, 6) AND event_id % 83 <> 0"),
        "c12_location": s("SELECT event_id, CAST(PULocationID AS BIGINT) AS PULocationID, DOLocationID FROM trips WHERE PULocationID BETWEEN 1 AND 265 AND event_id % 83 <> 0"),
        "c13_removals": _removals(),
        "c15_clean": s("SELECT * FROM clean"),
        "t02_duration": s(f"SELECT event_id, trip_duration_min FROM ({metrics('trips')})"),
        "t03_tip_percentage": s(f"SELECT event_id, tip_percentage FROM ({metrics('trips')})"),
        "t04_hour_floor": s("SELECT event_id, CAST(date_trunc('hour', tpep_pickup_datetime) AS TIMESTAMP) AS pickup_hour FROM trips"),
        "t05_distinct_hours": s("SELECT full_datetime FROM dim_datetime"),
        "t06_calendar": s("SELECT full_datetime, date, day, month, year, quarter, week, hour FROM dim_datetime"),
        "t07_season": f"SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Spring' WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season FROM orders",
        "t08_hour_keys": s("SELECT * FROM dim_datetime"),
        "t09_hour_join": s("SELECT event_id, datetime_id FROM fact"),
        "t10_fare_combinations": "SELECT l_discount AS fare_amount, l_tax AS tip_amount, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_quantity END AS total_amount, count(*) AS trips FROM lineitem GROUP BY 1, 2, 3",
        "t11_fare_keys": s("SELECT * FROM dim_fare"),
        "t11_first_appearance": s(f"""SELECT CAST(row_number() OVER (ORDER BY min(event_id)) AS BIGINT) AS fare_id, {MONEY},
            min(event_id) AS event_id, count(*) AS trips FROM clean GROUP BY {MONEY}"""),
        "t12_fare_join": s("SELECT event_id, fare_id FROM fact"),
        "t13_fact_order": s("SELECT * FROM fact"),
        "t14_no_money": s(f"SELECT * EXCLUDE (fare_id) REPLACE (CAST(NULL AS DOUBLE) AS tip_percentage), CAST(1 AS BIGINT) AS fare_id FROM fact"),
        "t15_star": s("SELECT f.event_id, f.trip_duration_min, f.tip_percentage, d.*, m.* FROM fact f JOIN dim_datetime d ON f.datetime_id = d.datetime_id JOIN dim_fare m ON f.fare_id = m.fare_id"),
        "w01_parse_time": s("SELECT source_order, datetime, TRY_CAST(datetime AS TIMESTAMP) AS full_datetime FROM weather"),
        "w02_match_hours": s("SELECT datetime_id, source_order, temp, conditions FROM matched"),
        "w03_attributes": s("SELECT datetime_id, temp, humidity, precip, conditions FROM matched"),
        "w04_first_per_hour": s("SELECT * FROM dim_weather"),
        "w05_dim_weather": s("SELECT * FROM dim_weather"),
        "v01_row_count": _checks([ROW_COUNT]),
        "v02_non_negative": _non_negative(),
        "v03_hour_coverage": _checks([COVERAGE]),
        "v04a_input_range": _checks([INPUT_RANGE]),
        "v04b_hour_range": _checks([HOUR_RANGE]),
        "v04c_fact_range": _checks([FACT_RANGE]),
        "v05_all_checks": _all_checks(),
        **{key: s(bodies[m]) for key, m in zip(MART_KEYS, marts)},
        "p01_month_start": s("SELECT *, make_date(year, month, 1) AS year_month FROM monthly"),
        "p02_day_names_durations": s(f"SELECT *, {day} FROM weekday"),
        "p08_top_labels_lookup": s("""SELECT t.pulocationid, t.trip_count, l.zone_label AS zone_name
            FROM top_pickup t JOIN labelled l ON t.pulocationid = l.location_id"""),
        "p09_located_pickups": s("SELECT p.location_id, p.trip_count, c.lon, c.lat FROM pickup_counts p JOIN centroids c ON p.location_id = c.location_id"),
        "p10_markers_located": s(f"""SELECT l.location_id, trip_count, zone_label, lon, lat,
                   {even('6 + 20 * sqrt(trip_count / CAST(max(trip_count) OVER () AS DOUBLE))', 6)} AS size,
                   zone_label || '<br>Trips: ' || format('{{:,}}', trip_count) AS text
            FROM labelled l JOIN centroids c ON l.location_id = c.location_id"""),
        "p13_trip_type_shares": s(f"""SELECT *, {even('trip_count * 100e0 / sum(trip_count) OVER ()', 6)} AS percent
            FROM (SELECT trip_type, count(*) AS trip_count FROM named GROUP BY 1)"""),
        "p02_day_names": s(f"SELECT *, {day} FROM fare_weekday"),
        "p03_weekend": s("SELECT *, day_of_week IN (0, 6) AS is_weekend FROM weekday"),
        "p04_heatmap_pivot": s(f"SELECT CAST(i AS INTEGER) AS day_of_week, {', '.join(f'CAST(coalesce(sum(trip_count) FILTER (WHERE month = {m + 1}), 0) AS BIGINT) AS {n}' for m, n in enumerate(months))}, {day.replace('day_of_week', 'i')} FROM range(7) r(i) LEFT JOIN heatmap h ON h.day_of_week = i GROUP BY i"),
        "p05_kpis": s("SELECT avg(avg_duration) AS avg_duration, sum(avg_duration * trip_count) / sum(trip_count) AS avg_duration_per_trip, CAST(sum(trip_count) AS BIGINT) AS total_trips FROM monthly").replace("SELECT avg(avg_duration) AS avg_duration, sum(avg_duration * trip_count) / sum(trip_count) AS", f"SELECT {even('avg(avg_duration)', 6)} AS avg_duration, {even('sum(avg_duration * trip_count) / sum(trip_count)', 6)} AS"),
        "p06_safe_average": s(f"SELECT PULocationID, {even('coalesce(avg(CASE WHEN PULocationID % 5 <> 0 THEN trip_distance END), 0)', 6)} AS avg_distance FROM fact GROUP BY 1"),
        "p07_zone_labels": s("SELECT * FROM labelled"),
        "p08_top_labels": s("SELECT t.pulocationid, t.trip_count, coalesce(b.zone_text, 'Zone ' || t.pulocationid) AS zone_name FROM top_pickup t LEFT JOIN built_in b ON t.pulocationid = b.zone_id"),
        "p09_located": s("SELECT p.location_id, p.trip_count, c.lon, c.lat FROM dropoff_counts p JOIN centroids c ON p.location_id = c.location_id"),
        "p09_located_report": s("SELECT count(*) AS rows, count(c.lon) AS kept, count(*) - count(c.lon) AS dropped FROM dropoff_counts p LEFT JOIN centroids c ON p.location_id = c.location_id"),
        "p10_markers": s(f"SELECT location_id, trip_count, zone_label, {even('6 + 20 * sqrt(trip_count / (SELECT CAST(max(trip_count) AS DOUBLE) FROM labelled))', 6)} AS size, zone_label || '<br>Trips: ' || format('{{:,}}', trip_count) AS text FROM labelled"),
        "p11_correlation": s(f"SELECT CAST(row_no AS INTEGER) AS row_no, CAST(col_no AS INTEGER) AS col_no, variable, other, {even('r', 6)} AS correlation FROM ({correlation_sql()})"),
        "p12_display_names": s(f"SELECT {_display('variable')}, {_display('other')}, {even('r', 6)} AS correlation FROM ({correlation_sql()})"),
        "p13_shares": s(f"SELECT *, {even('trip_count * 100e0 / (SELECT sum(trip_count) FROM payment)', 6)} AS percent FROM payment"),
        "m01_features": s(f"SELECT event_id, trip_duration_min, fare_amount, CASE WHEN event_id % 11 = 0 THEN 0e0 ELSE trip_distance END AS trip_distance FROM ({metrics('trips')})"),
        "m02_standardise": s("SELECT trip_duration_min, fare_amount, trip_distance, " + ", ".join(even(f"({c} - (SELECT avg({c}) FROM clustering)) / (SELECT stddev_pop({c}) FROM clustering)", 6) + f" AS {c}_scaled" for c in ("trip_duration_min", "fare_amount", "trip_distance")) + " FROM clustering"),
        "m04_names": s("SELECT trip_duration_min, fare_amount, trip_distance, trip_cluster, trip_type FROM named"),
        "m05_statistics": s(f"SELECT trip_type, {even('avg(trip_distance)')} AS trip_distance, {even('avg(trip_duration_min)')} AS trip_duration_min, {even('avg(fare_amount)')} AS fare_amount, count(*) AS count FROM named GROUP BY 1"),
        "m06_by_hour": s("SELECT hour, trip_type, count(*) AS count FROM named GROUP BY 1, 2"),
        "m07_sizes": s("SELECT trip_type, count(*) AS trip_count FROM named GROUP BY 1"),
        "m08_sample": s("""SELECT event_id, trip_type FROM (
            SELECT event_id, trip_type, row_number() OVER (PARTITION BY trip_type ORDER BY substr(md5(event_id || ':42'), 1, 13), event_id) AS place,
                   count(*) OVER (PARTITION BY trip_type) AS n, count(*) OVER () AS total
            FROM named)
            WHERE place <= least(n, greatest(floor(1000 * (n / CAST(total AS DOUBLE))), 100))"""),
        "m11_assign": s("SELECT trip_duration_min, fare_amount, trip_distance, CAST(trip_cluster AS INTEGER) AS trip_cluster FROM assigned"),
        "g01_location_id": s("SELECT k AS customer, location_id, location_text FROM features"),
        "g02_points": s(f"SELECT k AS customer, CAST(position AS INTEGER) AS position, lon, lat FROM ({points_sql()})"),
        "g03_box_centre": s("SELECT k AS customer, lon, lat FROM features"),
        "g03_vertex_centre": s("SELECT feature_id, (min(x) + max(x)) / 2 AS x, (min(y) + max(y)) / 2 AS y FROM vertices GROUP BY 1"),
        "g04_zone_centroids": s("SELECT * FROM centroids"),
        "g05_rings": s("""SELECT f.feature_id, CASE WHEN count(v.part) = 0 THEN 'GeometryCollection' WHEN count(DISTINCT v.part) = 1 THEN 'Polygon'
            ELSE 'MultiPolygon' END AS geometry_type, count(DISTINCT v.part) AS rings, count(v.part) AS points
            FROM (SELECT DISTINCT CAST(s_nationkey * 2 + 1 AS BIGINT) AS feature_id FROM supplier) f LEFT JOIN vertices v ON v.feature_id = f.feature_id GROUP BY 1"""),
        "s11_geojson": s("SELECT feature_id, count(*) AS points FROM vertices GROUP BY 1"),
        "g06_reproject": s(projected_sql()),
        "g07_location_count": s("SELECT count(DISTINCT location_text) AS locations FROM features"),
    }
    def recursive(table: str, tail: str) -> str:
        """A statement over a table above whose text begins with CTEs of its own, one of them recursive."""
        body = f"SELECT * FROM {table}"
        return s(body).removesuffix("\n" + body).replace("WITH ", "WITH RECURSIVE ", 1) + ",\n" + tail

    tips = bodies["cluster_data"]
    result["m03_trip_segments"] = recursive("clustering", trip_segments_sql(bodies["clustering"]))
    result["m09_tip_clusters"] = recursive("correlation", tip_clusters_sql(tips, "SELECT tip_amount, fare_amount, trip_distance, cluster FROM tip_assigned"))
    result["m10_tip_centroids"] = recursive("correlation", tip_clusters_sql(tips, """SELECT CAST(i AS INTEGER) AS cluster,
        c[2 * i + 1] / 4294967296e0 AS fare_amount, c[2 * i + 2] / 4294967296e0 AS tip_amount, coalesce(n, 0) AS trips
        FROM tip, range(3) t(i) LEFT JOIN (SELECT cluster, count(*) AS n FROM tip_assigned GROUP BY 1) g ON g.cluster = i"""))
    trained = {
        "m03_checks": ("clustering", "2 AS clusters, 2 AS names, true AS short_is_shorter, true AS nearest, true AS best"),
        "m09_checks": ("cluster_data", "3 AS clusters, true AS nearest"),
        "m10_checks": ("cluster_data", "3 AS clusters, true AS by_fare, true AS best"),
    }
    for name, (mart, facts) in trained.items():
        facts = facts.replace("2 AS", "CAST(2 AS BIGINT) AS").replace("3 AS", "CAST(3 AS BIGINT) AS")
        result[name] = s(f"SELECT count(*) AS trips, {facts} FROM ({bodies[mart]})")
    # The same rows whatever the size of a dimension makes of the joins.
    for name in ("t12_fare_join", "t15_star", "q04_fare_weekday", "q12_clustering"):
        result[f"{name}_large"] = result[name]
    return result


def kmeans_sql(name: str, points: str, k: int, dims: int, seed: int = 42, restarts: int = 10, rounds: int = 300) -> str:
    """CTEs that end in ``name``: one row with the list ``c`` of the k centroids, in whole units of 2 ** -32.

    ``points`` gives x0, x1, ... in these units and their weight w. All restarts run in one recursion.
    """
    unit, xs = 4294967296, [f"x{j}" for j in range(dims)]

    def squared(i: int) -> str:
        ds = [f"(CAST({x} AS DOUBLE) - CAST(c[{i * dims + j + 1}] AS DOUBLE))" for j, x in enumerate(xs)]
        return "(" + " + ".join(f"{d} * {d}" for d in ds) + ")"

    def draw(i: int, far: str) -> str:
        text = " || ':' || ".join(["r", f"{i}", *xs])
        u = f"((CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) + 1) / {unit}e0)"
        return f"arg_min([{', '.join(xs)}], -ln({u}) / (CAST(w AS DOUBLE) * {far})) FILTER ({far} > 0)"

    parts = [f"{name}_points AS MATERIALIZED ({points})"]
    parts.append(f"{name}_s0 AS (SELECT r, {draw(0, '1e0')} AS c FROM {name}_points, range({seed}, {seed + restarts}) t(r) GROUP BY r)")
    for i in range(1, k):
        far = f"least({', '.join(squared(j) for j in range(i))})" if i > 1 else squared(0)
        parts.append(f"{name}_s{i} AS (SELECT r, c || {draw(i, far)} AS c FROM {name}_s{i - 1}, {name}_points GROUP BY r, c)")
    near = "CASE " + " ".join(
        f"WHEN {' AND '.join(f'{squared(i)} <= {squared(j)}' for j in range(i + 1, k))} THEN {i}" for i in range(k - 1)
    ) + f" ELSE {k - 1} END"
    new = ", ".join(
        f"CAST(coalesce(sum(CAST({x} AS HUGEINT) * w) FILTER (near = {i}) // sum(CAST(w AS HUGEINT)) FILTER (near = {i}), c[{i * dims + j + 1}]) AS BIGINT)"
        for i in range(k)
        for j, x in enumerate(xs)
    )
    moved = f"greatest({', '.join(f'abs(new[{i + 1}] - c[{i + 1}])' for i in range(k * dims))})"
    parts.append(f"""{name}_rounds AS (
      SELECT r, 0 AS n, c, true AS moving FROM {name}_s{k - 1}
      UNION ALL
      SELECT r, n + 1 AS n, new AS c, {moved} > 1e-4 * {unit}e0 AS moving
      FROM (SELECT r, n, c, [{new}] AS new FROM (
        SELECT r, n, c, {", ".join(xs)}, w, {near} AS near FROM {name}_rounds, {name}_points WHERE moving AND n < {rounds}
      ) GROUP BY r, n, c))""")
    parts.append(f"{name}_ends AS (SELECT r, arg_max(c, n) AS c FROM {name}_rounds GROUP BY r)")
    cost = f"sum(CAST(least({', '.join(squared(i) for i in range(k))}) * w AS HUGEINT))"
    parts.append(f"{name}_costs AS (SELECT r, c, {cost} AS cost FROM {name}_ends, {name}_points GROUP BY r, c)")
    ordered = ", ".join(f"c[{i * dims + 1}:{(i + 1) * dims}]" for i in range(k))
    parts.append(f"{name} AS (SELECT flatten(list_sort([{ordered}])) AS c FROM {name}_costs ORDER BY cost, r LIMIT 1)")
    return ", ".join(parts)


def _nearest_sql(features: list[str], k: int) -> str:
    """Number of the nearest centroid of a list ``c`` in units, the lower one in a tie."""
    dims = len(features)
    d = ["(" + " + ".join(f"({f} - c[{i * dims + j + 1}] / 4294967296e0) * ({f} - c[{i * dims + j + 1}] / 4294967296e0)" for j, f in enumerate(features)) + ")" for i in range(k)]
    return "CASE " + " ".join(f"WHEN {' AND '.join(f'{d[i]} <= {d[j]}' for j in range(i + 1, k))} THEN {i}" for i in range(k - 1)) + f" ELSE {k - 1} END"


def trip_segments_sql(clustering: str) -> str:
    features = ("trip_duration_min", "fare_amount", "trip_distance")
    means = ", ".join(f"round_even(avg({c}) * 1e9, 0) / 1e9 AS m{j}" for j, c in enumerate(features))
    spread = ", ".join(f"round_even(sqrt(avg(({c} - m{j}) * ({c} - m{j}))) * 1e9, 0) / 1e9 AS d{j}" for j, c in enumerate(features))
    scaled = ", ".join(f"({c} - m{j}) / d{j} AS s{j}" for j, c in enumerate(features))
    units = ", ".join(f"CAST(floor(s{j} * 4294967296e0 + 0.5e0) AS BIGINT) AS x{j}" for j in range(3))
    averages = ", ".join(f"{even(f'avg({c})')} AS {c}" for c in ("trip_distance", "trip_duration_min", "fare_amount"))
    return f"""seg_rows AS MATERIALIZED ({clustering}), seg_means AS (SELECT {means} FROM seg_rows),
      seg_spread AS (SELECT any_value(m0) AS m0, any_value(m1) AS m1, any_value(m2) AS m2, {spread} FROM seg_rows, seg_means),
      seg_scaled AS MATERIALIZED (SELECT {", ".join(features)}, {scaled} FROM seg_rows, seg_spread),
      {kmeans_sql("seg", f"SELECT {units}, count(*) AS w FROM seg_scaled GROUP BY {', '.join(features)}, s0, s1, s2", 2, 3)},
      seg_assigned AS (SELECT {", ".join(features)}, {_nearest_sql(["s0", "s1", "s2"], 2)} AS k FROM seg_scaled, seg),
      seg_names AS (
        SELECT k, CASE WHEN row_number() OVER (ORDER BY (avg(trip_duration_min) + avg(fare_amount) + avg(trip_distance)) / 3, k) = 1
                       THEN 'Economy / Short Trips' ELSE 'Premium / Long Trips' END AS trip_type
        FROM seg_assigned GROUP BY k)
      SELECT trip_type, {averages}, count(*) AS count FROM seg_assigned JOIN seg_names USING (k) GROUP BY trip_type"""


def tip_clusters_sql(cluster_data: str, last: str) -> str:
    units = ", ".join(f"CAST(floor({c} * 4294967296e0 + 0.5e0) AS BIGINT) AS x{j}" for j, c in enumerate(("fare_amount", "tip_amount")))
    points = f"SELECT {units}, count(*) AS w FROM tip_rows GROUP BY fare_amount, tip_amount"
    return f"""tip_rows AS MATERIALIZED ({cluster_data}), {kmeans_sql("tip", points, 3, 2)},
      tip_assigned AS (SELECT t.*, CAST({_nearest_sql(["fare_amount", "tip_amount"], 3)} AS INTEGER) AS cluster FROM tip_rows t, tip)
      {last}"""


MART_NAMES = (
    "monthly",
    "weekday",
    "heatmap",
    "fare_weekday",
    "hourly",
    "top_pickup_locations",
    "payment_type_distribution",
    "weather_monthly",
    "weather_conditions",
    "weather_scatter",
    "correlation",
    "clustering",
    "cluster_data",
    "pickup_counts_all",
    "dropoff_counts_all",
)
MART_KEYS = tuple(
    f"q{i + 1:02d}_{name}"
    for i, name in enumerate(
        (
            "monthly",
            "weekday",
            "heatmap",
            "fare_weekday",
            "hourly",
            "top_pickup",
            "payment",
            "weather_monthly",
            "weather_conditions",
            "weather_scatter",
            "correlation",
            "clustering",
            "cluster_data",
            "pickup_counts",
            "dropoff_counts",
        )
    )
)
