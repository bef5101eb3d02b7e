"""The analytics tables for SQL users: functions with SQL bodies, views that build on each other, and queries over them.

`register` gives one session the functions and the views `kpi_measures` (over `cleaned_flights`), then one view a grain. SQL
text uses them by name and binds thresholds as named parameters. Functions and views hold no data: Catalyst merges them
into the query, so filters and column choices still reach the scan of the cleaned table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyledger import contract as C
from skyledger.operators import kpi

CLEANED = "cleaned_flights"

_BANDS = " ".join(f"WHEN clock <= '{last}' THEN '{name}'" for name, (_, last) in C.BAND_LIMITS.items())

FUNCTIONS = {
    "completed_flight(status STRING) RETURNS BOOLEAN": "status <=> 'completed'",
    "delayed_flight(status STRING, label INT) RETURNS BOOLEAN": "completed_flight(status) AND label <=> 1",
    "share(part DOUBLE, whole DOUBLE) RETURNS DOUBLE": "part / nullif(whole, 0D)",
    "time_band(clock STRING) RETURNS STRING":
        "CASE WHEN clock IS NULL THEN 'Missing' WHEN clock = '2400' THEN 'Night' "
        f"WHEN NOT regexp_like(clock, r'{C.CLOCK_PATTERN_BELOW_2400}') THEN 'Invalid' {_BANDS} END",
}

_COUNTS = """count(*) AS total_flights,
    count_if(completed_flight(flight_status)) AS completed_flights,
    count_if(flight_status = 'cancelled') AS cancelled_flights,
    count_if(flight_status = 'diverted') AS diverted_flights,
    count_if(delayed_flight(flight_status, ARR_DEL15)) AS delayed_arrival_flights,
    count_if(completed_flight(flight_status) AND ARR_DEL15 = 0) AS on_time_arrival_flights,
    count(ARR_DELAY) FILTER (WHERE completed_flight(flight_status)) AS arrival_delay_observed_flights,
    sum(ARR_DELAY) FILTER (WHERE completed_flight(flight_status)) AS arrival_delay_minutes_sum"""

_SUMS = ", ".join(f"sum({c}) AS {c}" for c in [*C.COUNT_MEASURES, "arrival_delay_minutes_sum"])
_RATIOS = ", ".join(f"share({n}, {d}) AS {name}" for name, (n, d) in C.RATIO_PARTS.items())


def _grain_view(level: str) -> str:
    keys = ", ".join(C.GRAINS[level])
    return f"SELECT *, {_RATIOS} FROM (SELECT {keys}, {_SUMS} FROM kpi_measures GROUP BY {keys})"


# The grains all read the first view.
VIEWS = {
    "kpi_measures": f"SELECT {', '.join(kpi.DIMENSIONS)}, {_COUNTS} FROM {CLEANED} GROUP BY {', '.join(kpi.DIMENSIONS)}",
    "monthly_performance": _grain_view("monthly"),
    "airline_monthly_performance": _grain_view("airline"),
    "origin_airport_monthly_performance": _grain_view("origin_airport"),
    "route_monthly_performance": _grain_view("route"),
}

QUERIES = {
    "airline_ranking": """
        WITH measured AS (
            SELECT *, completed_flights >= :min_completed_flights AS meets_volume_heuristic FROM airline_monthly_performance),
        ranked AS (
            SELECT *, dense_rank() OVER (PARTITION BY YEAR, MONTH, meets_volume_heuristic AND arrival_delay_rate IS NOT NULL
                ORDER BY arrival_delay_rate) AS place FROM measured)
        SELECT YEAR, MONTH, OP_UNIQUE_CARRIER, completed_flights, delayed_arrival_flights, arrival_delay_rate, meets_volume_heuristic,
            CASE WHEN meets_volume_heuristic AND arrival_delay_rate IS NOT NULL AND OP_UNIQUE_CARRIER IS NOT NULL
                AND YEAR IS NOT NULL AND MONTH IS NOT NULL THEN place END AS arrival_delay_rank
        FROM ranked ORDER BY YEAR, MONTH, arrival_delay_rank NULLS LAST, OP_UNIQUE_CARRIER""",
    "high_delay_routes": """
        SELECT YEAR, MONTH, ORIGIN, DEST, completed_flights, delayed_arrival_flights, arrival_delay_rate,
            dense_rank() OVER (PARTITION BY YEAR, MONTH ORDER BY arrival_delay_rate DESC) AS observed_delay_rank
        FROM route_monthly_performance
        WHERE completed_flights >= :min_completed_flights AND arrival_delay_rate IS NOT NULL
        ORDER BY YEAR, MONTH, observed_delay_rank, ORIGIN, DEST""",
    "departure_time_band": f"""
        SELECT *, share(delayed_arrival_flights, completed_flights) AS arrival_delay_rate FROM (
            SELECT YEAR, MONTH, time_band(CRS_DEP_TIME) AS time_band, count(*) AS total_flights,
                count_if(completed_flight(flight_status)) AS completed_flights,
                count_if(delayed_flight(flight_status, ARR_DEL15)) AS delayed_arrival_flights,
                count_if(CRS_DEP_TIME = '2400') AS scheduled_2400_flights
            FROM {CLEANED} GROUP BY ALL)
        ORDER BY YEAR, MONTH, array_position(array({", ".join(f"'{b}'" for b in C.BAND_ORDER)}), time_band)""",
}


def register(cleaned: DataFrame) -> None:
    """Name the cleaned table and make the functions and views in its session, in place of earlier ones."""
    spark = cleaned.sparkSession
    cleaned.createOrReplaceTempView(CLEANED)
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    for name, text in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {text}")


def run(spark: SparkSession, name: str, **parameters) -> DataFrame:
    """One of the named queries with its parameters bound."""
    return spark.sql(QUERIES[name], args=parameters)
