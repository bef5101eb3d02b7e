"""One DuckDB statement per query, written from the definitions rather than from the Spark code."""

from __future__ import annotations

from oracle import views as W
from oracle.views import CLEAN, CLEAN_FAULTY, CLOCK, CLOCK_23, FAULTY, GRAIN_TABLES, dbl, flag, missing, present, statement, trim_null
from skyledger import contract as C

STATEMENTS: dict[str, str] = {}

RAW = C.RAW_COLUMNS
RAW_LIST = ", ".join(RAW)
LINEAGE = ", ".join(C.LINEAGE_COLUMNS)
QUARTER = "YEAR = 1996 AND MONTH IN (1, 2, 3)"
YEARS = ", ".join(str(y) for y in range(1995, 2002))
PERIOD_TABLE = ("SELECT CAST(y.range AS INTEGER) AS YEAR, CAST(m.range AS INTEGER) AS MONTH "
                "FROM range(1995, 2002) AS y, range(1, 13) AS m")
GRAINS = {f"t_{name}": sql for name, sql in GRAIN_TABLES.items()}
GRAINS_FAULTY = {f"f_{name}": W.grain_table(keys, "cleaned_faulty") for name, keys in C.GRAINS.items()}
TYPED_FAULTY = {"typed_faulty": W.cleaned_from("faulty")}


def add(name: str, body: str, *groups: dict[str, str]) -> None:
    STATEMENTS[name] = statement(body, *groups)


def grain(*levels: str) -> dict[str, str]:
    return {f"t_{level}": GRAINS[f"t_{level}"] for level in levels}


def faulty_grain(*levels: str) -> dict[str, str]:
    return {f"f_{level}": GRAINS_FAULTY[f"f_{level}"] for level in levels}


def counted(keys: str, source: str, name: str = "records", where: str = "TRUE") -> str:
    return f"SELECT {keys}, count(*) AS {name} FROM {source} WHERE {where} GROUP BY ALL"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def count_if(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def bad(rule: str) -> str:
    """Rows where the rule is not true, NULL included."""
    return count_if(f"({rule}) IS NOT TRUE")


def long(source: str, rows: list[tuple[str, ...]], names: list[str]) -> str:
    """Several aggregates of one source as rows; the last item of a row is an expression, the rest are texts."""
    columns = ", ".join(f"{row[-1]} AS x{i}" for i, row in enumerate(rows))
    picks = []
    for i, row in enumerate(rows):
        texts = ", ".join(f"'{t}' AS \"{n}\"" for t, n in zip(row[:-1], names))
        picks.append(f"SELECT {texts}, x{i} AS \"{names[-1]}\" FROM wide")
    return f"SELECT * FROM (WITH wide AS (SELECT {columns} FROM {source}) " + " UNION ALL ".join(picks) + ")"


def checks(source: str, tests: dict[str, str]) -> str:
    inner = long(source, [(n, f"CAST(coalesce({e}, 0) AS BIGINT)") for n, e in tests.items()], ["check", "violations"])
    return f"SELECT \"check\", violations, violations = 0 AS passed FROM ({inner})"


def literal_check(name: str, violations: str = "0") -> str:
    return f"SELECT '{name}' AS \"check\", CAST({violations} AS BIGINT) AS violations, CAST({violations} AS BIGINT) = 0 AS passed"


def union(*parts: str) -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


def full_join(left: str, right: str, keys: list[str]) -> str:
    """Two tables side by side as a.* and b.*, NULL keys matching."""
    on = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    return (f"(SELECT a, b FROM (SELECT *, TRUE AS here FROM {left}) AS a FULL JOIN "
            f"(SELECT *, TRUE AS here FROM {right}) AS b ON {on})")


NO_A, NO_B = "a.here IS NULL", "b.here IS NULL"


def near(x: str, y: str, absolute: str = "1e-9", relative: str = "1e-12") -> str:
    return (f"(({x} IS NULL AND {y} IS NULL) OR coalesce(abs({x} - {y}) <= "
            f"greatest({absolute}, {relative} * greatest(abs({x}), abs({y}))), FALSE))")


def quotient_fits(value: str, numerator: str, denominator: str) -> str:
    q = f"(CAST({numerator} AS DOUBLE) / nullif({denominator}, 0))"
    return (f"CASE WHEN {q} IS NULL THEN {value} IS NULL ELSE {value} IS NOT NULL AND {value} BETWEEN 0 AND 1 "
            f"AND {near(value, q)} END")


# --- sources and sinks -----------------------------------------------------------------

_period = "try_cast(nullif(regexp_extract({0}, '_(\\d{{4}})_(\\d{{2}})\\.csv$', {1}), '') AS INTEGER)"
add("with_lineage", counted(
    f"_source_file, {_period.format('_source_file', 1)} AS _source_year, {_period.format('_source_file', 2)} AS _source_month",
    "raw"))
add("lineage_check", checks("raw", {"source_period_known": count_if("_source_month = 7")}))
add("pruned_read", f"SELECT {', '.join(C.SUMMARY_INPUT_COLUMNS)} FROM cleaned", CLEAN)
add("read_raw_csv", "SELECT * FROM raw")
add("write_partitioned", "SELECT * FROM cleaned", CLEAN)
add("roundtrip_parquet", "SELECT * FROM cleaned", CLEAN)


def _reject_rows(source: str) -> str:
    blanks = " , ".join(f"CASE WHEN {trim_null(c)} IS NULL THEN '{c}' END" for c in C.ESSENTIAL_ARRIVAL)
    return (f"SELECT {RAW_LIST}, {LINEAGE}, '{C.REJECTION_REASON}' AS rejection_reason, "
            f"concat_ws(',', {blanks}) AS missing_fields FROM {source} WHERE is_rejected")


add("write_rejected", _reject_rows("judged"), CLEAN)
add("write_aggregate", "SELECT * FROM t_route", CLEAN, grain("route"))
add("union_files", counted("_source_file", "raw"))

# --- typing, cleaning, classification --------------------------------------------------

add("normalize_text", union(*(
    counted(f"'{c}' AS \"column\", {c} AS text, {trim_null(c)} AS normalized", "faulty") for c in RAW
)), FAULTY)
add("binary_flags", union(*(
    counted(f"'{c}' AS \"column\", {c} AS \"value\", CAST({flag(c)} AS INTEGER) AS flag", "faulty") for c in C.FLAG_COLUMNS
)), FAULTY)
add("text_to_int", union(*(
    counted(f"'{c}' AS \"column\", {c} AS text, try_cast(trunc(try_cast({c} AS DOUBLE)) AS INTEGER) AS number", "faulty") for c in C.INT_COLUMNS
)), FAULTY)
add("flight_dates", counted(
    "FL_DATE AS text, CAST(try_strptime(FL_DATE, '%m/%d/%Y %I:%M:%S %p') AS DATE) AS flight_date", "faulty"), FAULTY)
add("clean_flights", "SELECT * FROM typed_faulty", FAULTY, TYPED_FAULTY)
add("typed_columns", long("typed_faulty", [(c, f"count({c})") for c in RAW], ["column", "typed_values"]), FAULTY, TYPED_FAULTY)
add("flight_statuses", counted("CANCELLED, DIVERTED, flight_status", "typed_faulty"), FAULTY, TYPED_FAULTY)
add("raw_statuses", counted(f"_source_file, {W.RAW_STATUS} AS flight_status", "faulty"), FAULTY)
PROFILE_STATUS = f"""CASE WHEN {dbl('CANCELLED')} NOT IN (0, 1) OR {dbl('DIVERTED')} NOT IN (0, 1)
    OR {dbl('CANCELLED')} IS NULL OR {dbl('DIVERTED')} IS NULL THEN 'invalid_or_missing_flags'
    WHEN {dbl('CANCELLED')} + {dbl('DIVERTED')} = 2 THEN 'invalid_both_flags'
    WHEN {dbl('CANCELLED')} = 1 THEN 'cancelled' WHEN {dbl('DIVERTED')} = 1 THEN 'diverted' ELSE 'completed' END"""
add("profile_statuses", counted(f"CANCELLED, DIVERTED, {PROFILE_STATUS} AS status", "faulty"), FAULTY)
_blank_names = ", ".join(f"CASE WHEN {trim_null(c)} IS NULL THEN '{c}' END" for c in C.ESSENTIAL_ARRIVAL)
add("classify_arrival_records",
    f"SELECT {RAW_LIST}, {LINEAGE}, "
    f"CASE WHEN is_rejected THEN '{C.REJECTION_REASON}' END AS rejection_reason, "
    f"concat_ws(',', {_blank_names}) AS missing_fields FROM judged_faulty", FAULTY, CLEAN_FAULTY)
add("split_arrival_records", counted(
    "_source_file, CASE WHEN is_rejected THEN 'rejected' ELSE 'accepted' END AS branch", "judged_faulty"), FAULTY, CLEAN_FAULTY)
add("rejected_records", _reject_rows("judged_faulty"), FAULTY, CLEAN_FAULTY)
# Bands by minutes since midnight instead of by text.
BAND = f"""CASE WHEN CRS_DEP_TIME IS NULL THEN 'Missing'
    WHEN CRS_DEP_TIME = '2400' THEN 'Night'
    WHEN NOT {CLOCK_23.format('CRS_DEP_TIME')} THEN 'Invalid'
    ELSE ['Night', 'Morning', 'Afternoon', 'Evening'][1 + try_cast(left(CRS_DEP_TIME, 2) AS INTEGER) // 6] END"""
add("time_bands", counted(f"CRS_DEP_TIME, {BAND} AS time_band", "cleaned_faulty", "flights"), FAULTY, CLEAN_FAULTY)
ANY_CAUSE = f"coalesce({', '.join(C.CAUSE_COLUMNS)}) IS NOT NULL"
ALL_CAUSES = f"({' + '.join(C.CAUSE_COLUMNS)}) IS NOT NULL"
DELAYED = "flight_status = 'completed' AND ARR_DEL15 = 1"
add("cause_coverage", counted(
    f"YEAR, MONTH, {ANY_CAUSE} AS any_cause, {ALL_CAUSES} AS all_causes", "cleaned_faulty", "flights", DELAYED), FAULTY, CLEAN_FAULTY)
CAUSE_ROWS = union(*(
    f"SELECT YEAR, MONTH, {ANY_CAUSE} AS any_cause_reported, {ALL_CAUSES} AS all_causes_reported, "
    f"'{c}' AS cause_category, {c} AS cause_minutes FROM {{0}} WHERE {DELAYED}" for c in C.CAUSE_COLUMNS
))
add("unpivot_causes", CAUSE_ROWS.format("cleaned_faulty"), FAULTY, CLEAN_FAULTY)
add("unpivot_values", union(*(
    f"SELECT '{c}' AS \"column\", count(*) AS records, count({c}) AS non_null FROM faulty" for c in C.VALUE_COUNT_COLUMNS
)), FAULTY)

# --- filters ---------------------------------------------------------------------------

RAW_COMPLETED = f"{dbl('CANCELLED')} = 0 AND {dbl('DIVERTED')} = 0"
_markers = ", ".join(f"{missing(c)} AS missing_{c.lower()}" for c in C.ESSENTIAL_ARRIVAL)
SUSPECTS = {name: f"SELECT *, {_markers} FROM {source} WHERE {RAW_COMPLETED} AND "
                  f"({' OR '.join(missing(c) for c in C.ESSENTIAL_ARRIVAL)})"
            for name, source in (("suspects", "raw"), ("suspects_faulty", "faulty"))}
MARKERS = [f"missing_{c.lower()}" for c in C.ESSENTIAL_ARRIVAL]


def suspects(name: str) -> dict[str, str]:
    return {name: SUSPECTS[name]}


add("arrival_suspects", "SELECT * FROM suspects_faulty", FAULTY, suspects("suspects_faulty"))
add("eligible_delayed", counted("YEAR, MONTH", "cleaned_faulty", "eligible_flights", DELAYED), FAULTY, CLEAN_FAULTY)
add("volume_threshold", "SELECT * FROM t_airline WHERE completed_flights >= 30 AND arrival_delay_rate IS NOT NULL",
    CLEAN, grain("airline"))
add("period_filter", counted("YEAR, MONTH, flight_status", "cleaned_faulty", "flights", QUARTER), FAULTY, CLEAN_FAULTY)
add("null_is_violation",
    f"SELECT YEAR, MONTH, {bad('ARR_DELAY_NEW >= 0')} AS violations, {count_if('ARR_DELAY_NEW < 0')} AS known_violations "
    "FROM typed_faulty GROUP BY YEAR, MONTH", FAULTY, TYPED_FAULTY)
add("finite_values",
    f"SELECT flight_status, {count_if('isfinite(ARR_DELAY)')} AS finite_delays, "
    f"{count_if('NOT isfinite(ARR_DELAY)')} AS nonfinite_delays FROM typed_faulty GROUP BY flight_status", FAULTY, TYPED_FAULTY)
add("null_safe_equality",
    f"SELECT YEAR, MONTH, {count_if('DEP_DEL15 IS NOT DISTINCT FROM ARR_DEL15')} AS same_label, "
    f"{count_if('DEP_DEL15 IS DISTINCT FROM ARR_DEL15')} AS other_label, count(*) AS status_fits "
    "FROM typed_faulty GROUP BY YEAR, MONTH", FAULTY, TYPED_FAULTY)
_label_shown = ["_source_file", "FL_DATE", "OP_UNIQUE_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST",
                "CANCELLED", "DIVERTED", "flight_status", "ARR_DEL15"]
_sort = ", ".join(f"{c} NULLS FIRST" for c in _label_shown)
add("label_violation_sample",
    f"SELECT {', '.join(_label_shown)} FROM (SELECT * REPLACE (strftime(FL_DATE, '%Y-%m-%d') AS FL_DATE) FROM cleaned_faulty) "
    f"WHERE (flight_status = 'completed') <> (ARR_DEL15 IS NOT NULL) ORDER BY {_sort} LIMIT 5", FAULTY, CLEAN_FAULTY)

# --- KPI aggregates --------------------------------------------------------------------


def summary(prefix: str) -> str:
    parts = []
    for level, keys in C.GRAINS.items():
        columns = [c if c in keys else f"NULL AS {c}" for c in ("YEAR", "MONTH", "OP_UNIQUE_CARRIER", "ORIGIN", "DEST")]
        parts.append(f"SELECT {', '.join(columns)}, '{level}' AS aggregation_level, {', '.join(C.KPI_MEASURES)} FROM {prefix}_{level}")
    return union(*parts)


add("kpi_summary", summary("t"), CLEAN, GRAINS)
add("kpi_summary_direct", summary("t"), CLEAN, GRAINS)
add("kpi_summary_faulty", summary("f"), FAULTY, CLEAN_FAULTY, GRAINS_FAULTY)
for _level, _name in (("monthly", "monthly_performance"), ("airline", "airline_monthly_performance"),
                      ("origin_airport", "origin_airport_monthly_performance"), ("route", "route_monthly_performance")):
    add(_name, f"SELECT * FROM t_{_level}", CLEAN, grain(_level))

COMPLETED = "flight_status = 'completed'"
DELAY_COUNTS = (f"count(*) AS total_flights, {count_if(COMPLETED)} AS completed_flights, "
                f"{count_if(DELAYED)} AS delayed_arrival_flights")
WITH_RATE = "SELECT *, CAST(delayed_arrival_flights AS DOUBLE) / nullif(completed_flights, 0) AS arrival_delay_rate FROM ({0})"


def weekdays(source: str) -> str:
    return WITH_RATE.format(f"SELECT YEAR, MONTH, DAY_OF_WEEK, {DELAY_COUNTS} FROM {source} GROUP BY ALL")


def bands(source: str) -> str:
    midnight = count_if("CRS_DEP_TIME = '2400'")
    return WITH_RATE.format(
        f"SELECT YEAR, MONTH, {BAND} AS time_band, {DELAY_COUNTS}, {midnight} AS scheduled_2400_flights "
        f"FROM {source} GROUP BY ALL")


def causes(source: str) -> str:
    totals = (f"SELECT YEAR, MONTH, cause_category, count(*) AS eligible_delayed_flights, count(cause_minutes) AS reported_cause_flights, "
              f"{count_if('any_cause_reported')} AS flights_with_any_reported_cause, "
              f"{count_if('all_causes_reported')} AS flights_with_all_reported_causes, sum(cause_minutes) AS attributed_minutes "
              f"FROM ({CAUSE_ROWS.format(source)}) GROUP BY ALL")
    months = "SELECT YEAR AS y, MONTH AS m, sum(attributed_minutes) AS monthly_attributed_minutes FROM totals GROUP BY ALL"
    return (f"SELECT * FROM (WITH totals AS ({totals}), months AS ({months}) SELECT totals.*, monthly_attributed_minutes, "
            "attributed_minutes / nullif(monthly_attributed_minutes, 0) AS cause_minute_share FROM totals JOIN months "
            "ON YEAR IS NOT DISTINCT FROM y AND MONTH IS NOT DISTINCT FROM m)")


add("day_of_week", weekdays("cleaned"), CLEAN)
add("departure_time_band", bands("cleaned_faulty"), FAULTY, CLEAN_FAULTY)
add("delay_causes", causes("cleaned_faulty"), FAULTY, CLEAN_FAULTY)
add("write_summary_csv", causes("cleaned"), CLEAN)
TOTALS = (f"SELECT *, {', '.join(f'{W.rate(n, d)} AS {m}' for m, (n, d) in C.RATIO_PARTS.items())} "
          f"FROM (SELECT {W.KPI_COLUMNS} FROM {{0}} WHERE {{1}})")
add("annual_summary", TOTALS.format("cleaned", "TRUE"), CLEAN)
add("window_totals", TOTALS.format("cleaned", QUARTER), CLEAN)

# --- rankings and reports --------------------------------------------------------------

add("airline_ranking", """SELECT YEAR, MONTH, OP_UNIQUE_CARRIER, completed_flights, delayed_arrival_flights, arrival_delay_rate,
    completed_flights >= 30 AS meets_volume_heuristic, CAST(arrival_delay_rank AS INTEGER) AS arrival_delay_rank
    FROM t_airline LEFT JOIN (SELECT YEAR, MONTH, OP_UNIQUE_CARRIER,
        dense_rank() OVER (PARTITION BY YEAR, MONTH ORDER BY arrival_delay_rate) AS arrival_delay_rank
        FROM t_airline WHERE completed_flights >= 30 AND arrival_delay_rate IS NOT NULL) USING (YEAR, MONTH, OP_UNIQUE_CARRIER)""",
    CLEAN, grain("airline"))
add("ranking_preview", """SELECT YEAR, MONTH, OP_UNIQUE_CARRIER, completed_flights,
    delayed_arrival_flights, arrival_delay_rate, completed_flights >= 30 AS meets_volume_heuristic,
    CAST(CASE WHEN completed_flights >= 30 THEN rank END AS INTEGER) AS arrival_delay_rank
    FROM (SELECT *, dense_rank() OVER (PARTITION BY YEAR, MONTH, completed_flights >= 30 ORDER BY arrival_delay_rate) AS rank FROM t_airline)
    ORDER BY YEAR, MONTH, arrival_delay_rank NULLS LAST, OP_UNIQUE_CARRIER LIMIT 20""", CLEAN, grain("airline"))
# The previous observed month by a correlated lookup instead of a window.
add("airline_month_over_month", """SELECT YEAR, MONTH, OP_UNIQUE_CARRIER, completed_flights, delayed_arrival_flights, arrival_delay_rate,
    previous_month, previous_completed_flights, previous_delayed_flights, previous_delay_rate, adjacent AS has_previous_calendar_month,
    CASE WHEN adjacent THEN 100.0 * (arrival_delay_rate - previous_delay_rate) END AS delay_rate_change_pp,
    CASE WHEN adjacent AND previous_delay_rate > 0
        THEN 100.0 * (arrival_delay_rate - previous_delay_rate) / previous_delay_rate END AS delay_rate_relative_change_pct,
    adjacent AND completed_flights >= 30 AND previous_completed_flights >= 30 AS both_months_meet_volume_heuristic
    FROM (SELECT now.*, make_date(before.YEAR, before.MONTH, 1) AS previous_month,
            before.completed_flights AS previous_completed_flights, before.delayed_arrival_flights AS previous_delayed_flights,
            before.arrival_delay_rate AS previous_delay_rate, coalesce(now.n - before.n = 1, FALSE) AS adjacent
        FROM (SELECT *, YEAR * 12 + MONTH AS n FROM t_airline) AS now
        ASOF LEFT JOIN (SELECT *, YEAR * 12 + MONTH AS n FROM t_airline) AS before
        ON now.OP_UNIQUE_CARRIER = before.OP_UNIQUE_CARRIER AND now.n > before.n)""", CLEAN, grain("airline"))


def routes(volume: int) -> str:
    return f"""SELECT YEAR, MONTH, ORIGIN, DEST, completed_flights, delayed_arrival_flights, arrival_delay_rate,
        CAST(dense_rank() OVER (PARTITION BY YEAR, MONTH ORDER BY arrival_delay_rate DESC) AS INTEGER) AS observed_delay_rank
        FROM t_route WHERE completed_flights >= {volume} AND arrival_delay_rate IS NOT NULL"""


add("high_delay_routes", routes(30), CLEAN, grain("route"))
add("high_delay_route_months", routes(300), CLEAN, grain("route"))


def best(measure: str, direction: str) -> str:
    return (f"(SELECT YEAR || '-' || lpad(CAST(MONTH AS VARCHAR), 2, '0') FROM t_monthly WHERE {measure} IS NOT NULL "
            f"ORDER BY {measure} {direction}, YEAR, MONTH LIMIT 1)")


add("monthly_extremes", f"""SELECT {best('arrival_delay_rate', 'DESC')} AS highest_delay_rate_month,
    max(arrival_delay_rate) AS highest_delay_rate, {best('arrival_delay_rate', 'ASC')} AS lowest_delay_rate_month,
    min(arrival_delay_rate) AS lowest_delay_rate,
    100.0 * (max(arrival_delay_rate) - min(arrival_delay_rate)) AS delay_rate_spread_pp,
    {best('delayed_arrival_flights', 'DESC')} AS most_delayed_month, max(delayed_arrival_flights) AS most_delayed_flights,
    {best('cancellation_rate', 'DESC')} AS highest_cancellation_rate_month, max(cancellation_rate) AS highest_cancellation_rate
    FROM t_monthly""", CLEAN, grain("monthly"))
add("month_weekday_heatmap", "SELECT YEAR, MONTH, " + ", ".join(
    f"max(arrival_delay_rate) FILTER (WHERE DAY_OF_WEEK = {d}) AS weekday_{d}" for d in range(1, 8)
) + f" FROM ({weekdays('cleaned')}) GROUP BY YEAR, MONTH", CLEAN)
add("band_overview", WITH_RATE.format(f"SELECT {BAND} AS time_band, {DELAY_COUNTS} FROM cleaned GROUP BY ALL"), CLEAN)
add("annual_cause_share", f"""SELECT cause_category, attributed_minutes, attributed_minutes / sum(attributed_minutes) OVER () AS minute_share,
    (SELECT sum(m) FROM (SELECT sum(cause_minutes) AS m FROM ({CAUSE_ROWS.format('cleaned')}) GROUP BY cause_category ORDER BY m DESC LIMIT 2))
        / sum(attributed_minutes) OVER () AS top_two_share
    FROM (SELECT cause_category, sum(cause_minutes) AS attributed_minutes FROM ({CAUSE_ROWS.format('cleaned')}) GROUP BY ALL)""", CLEAN)


def pooled(key: str) -> str:
    return WITH_RATE.format(f"SELECT {key}, {DELAY_COUNTS} FROM cleaned GROUP BY ALL")


add("top_airlines", f"SELECT * FROM ({pooled('OP_UNIQUE_CARRIER')}) WHERE completed_flights >= 1000 "
    "ORDER BY arrival_delay_rate DESC, OP_UNIQUE_CARRIER LIMIT 5", CLEAN)
for _name, _measure in (("top_origins_by_completed", "completed_flights"), ("top_origins_by_delayed", "delayed_arrival_flights")):
    add(_name, f"SELECT * FROM ({pooled('ORIGIN')}) ORDER BY {_measure} DESC, ORIGIN LIMIT 10", CLEAN)

# --- profiling -------------------------------------------------------------------------

_profile = (f"SELECT {{0}} count(*) AS row_count, " + ", ".join(f"{count_if(missing(c))} AS missing__{c}" for c in RAW) + ", "
            + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS status__{s}" for s in C.PROFILE_STATUSES)
            + f" FROM (SELECT *, {PROFILE_STATUS} AS status FROM faulty) {{1}}")
PROFILE = {"profile": _profile.format(f"{LINEAGE},", f"GROUP BY {LINEAGE}")}
OVERALL = {"overall": _profile.format("", "")}


def missing_long(source: str, keys: str) -> str:
    return union(*(
        f"SELECT {keys} '{c}' AS \"column\", missing__{c} AS missing_count, row_count, "
        f"round(missing__{c} / row_count * 100, 4) AS missing_percent FROM {source}" for c in RAW
    ))


add("file_profile", "SELECT * FROM profile", FAULTY, PROFILE)
add("missing_by_file", missing_long("profile", f"{LINEAGE},"), FAULTY, PROFILE)
add("missing_overall", missing_long("overall", ""), FAULTY, OVERALL)
add("status_profile", f"SELECT {LINEAGE}, row_count, " + ", ".join(f"status__{s} AS {s}" for s in C.PROFILE_STATUSES)
    + ", row_count AS reconciled_total, TRUE AS status_reconciles FROM profile", FAULTY, PROFILE)
add("coverage_checks", union(
    literal_check("all_configured_files_have_rows",
                  "(SELECT count(*) FROM (SELECT DISTINCT _source_file FROM faulty) AS a FULL JOIN "
                  "(SELECT DISTINCT _source_file FROM raw) AS b ON a._source_file = b._source_file "
                  "WHERE a._source_file IS NULL OR b._source_file IS NULL)"),
    literal_check("all_configured_periods_present",
                  f"(SELECT count(*) FROM ({PERIOD_TABLE}) AS p ANTI JOIN faulty AS f ON p.YEAR = f._source_year AND p.MONTH = f._source_month)"),
    literal_check("status_reconciles"),
), FAULTY)

INTS, DOUBLES = C.INT_COLUMNS, [c for c in RAW if c in C.FLAG_COLUMNS + C.MEASURE_COLUMNS]
CAST = {c: W.integer(c) for c in INTS} | {c: dbl(c) for c in DOUBLES} | {"FL_DATE": W.stamp("FL_DATE")}
add("cast_failures", long("faulty", [(c, count_if(f"{present(c)} AND {e} IS NULL")) for c, e in CAST.items()],
                          ["column", "cast_failures"]), FAULTY)
add("numeric_ranges", union(*(
    f"SELECT '{c}' AS \"column\", CAST(min({e}) AS DOUBLE) AS min_value, CAST(max({e}) AS DOUBLE) AS max_value FROM faulty"
    for c, e in CAST.items() if c != "FL_DATE")), FAULTY)
add("distinct_counts", long("faulty", [(c, f"count(DISTINCT {c})") for c in C.CARDINALITY_COLUMNS],
                            ["column", "distinct_non_null"]), FAULTY)
add("value_counts", union(*(
    f"SELECT '{c}' AS \"column\", {c} AS \"value\", count(*) AS value_count FROM faulty GROUP BY {c}" for c in C.VALUE_COUNT_COLUMNS
)), FAULTY)
GROUP_NUMBERS = ("count(*) AS duplicate_groups, CAST(coalesce(sum(copies), 0) AS BIGINT) AS rows_in_groups, "
                 "CAST(coalesce(sum(copies - 1), 0) AS BIGINT) AS excess_rows")
for _name in ("exact_duplicates", "exact_duplicates_direct"):
    add(_name, f"SELECT {GROUP_NUMBERS} FROM (SELECT count(*) AS copies FROM faulty GROUP BY {RAW_LIST} HAVING count(*) > 1)", FAULTY)
KEY = ", ".join(C.CANDIDATE_KEY)
_complete = " AND ".join(present(c) for c in C.CANDIDATE_KEY)
COLLISIONS = f"SELECT {KEY}, count(*) AS copies FROM faulty WHERE {_complete} GROUP BY {KEY} HAVING count(*) > 1"
add("key_collisions", f"SELECT (SELECT {count_if(f'NOT ({_complete})')} FROM faulty) AS incomplete_key_rows, {GROUP_NUMBERS} "
    f"FROM ({COLLISIONS})", FAULTY)
add("collision_samples", f"{COLLISIONS} ORDER BY copies DESC, {KEY} LIMIT 10", FAULTY)

_n = {c: dbl(c) for c in C.FLAG_COLUMNS + C.MEASURE_COLUMNS}
_date, _year, _month, _weekday = W.stamp("FL_DATE"), W.integer("YEAR"), W.integer("MONTH"), W.integer("DAY_OF_WEEK")


def contradiction(delay: str, label: str) -> str:
    return f"({_n[delay]} >= 15 AND {_n[label]} <> 1) OR ({_n[delay]} < 15 AND {_n[label]} <> 0)"


CONFIRMED = {
    "year_outside_scope": f"{present('YEAR')} AND {_year} NOT IN ({YEARS})",
    "month_outside_configured_scope": f"{present('MONTH')} AND {_month} NOT BETWEEN 1 AND 12",
    "day_of_week_outside_1_7": f"{present('DAY_OF_WEEK')} AND {_weekday} NOT BETWEEN 1 AND 7",
    "unparseable_flight_date": f"{present('FL_DATE')} AND {_date} IS NULL",
    "flight_date_year_mismatch": f"year({_date}) <> {_year}",
    "flight_date_month_mismatch": f"month({_date}) <> {_month}",
    "day_of_week_mismatch_with_flight_date": f"isodow({_date}) <> {_weekday}",
    "source_year_mismatch": f"{_year} <> _source_year",
    "source_month_mismatch": f"{_month} <> _source_month",
    "cancelled_and_diverted": f"{_n['CANCELLED']} = 1 AND {_n['DIVERTED']} = 1",
    "distance_nonpositive": f"{_n['DISTANCE']} <= 0",
    "arr_del15_inconsistent_with_arr_delay": contradiction("ARR_DELAY", "ARR_DEL15"),
    "dep_del15_inconsistent_with_dep_delay": contradiction("DEP_DELAY", "DEP_DEL15"),
    "arr_delay_new_negative": f"{_n['ARR_DELAY_NEW']} < 0",
    "arr_delay_new_inconsistent_with_arr_delay":
        f"abs({_n['ARR_DELAY_NEW']} - CASE WHEN {_n['ARR_DELAY']} > 0 THEN {_n['ARR_DELAY']} WHEN {_n['ARR_DELAY']} <= 0 THEN 0 END) > 0.0001",
    **{f"{c.lower()}_outside_0_1": f"{present(c)} AND {_n[c]} NOT IN (0, 1)" for c in C.FLAG_COLUMNS},
    **{f"{c.lower()}_invalid_hhmm": f"{present(c)} AND NOT {CLOCK.format(f'trim({c})')}" for c in C.CLOCK_COLUMNS},
    **{f"{c.lower()}_negative": f"{_n[c]} < 0" for c in C.CAUSE_COLUMNS},
}
SUSPICIOUS = {
    "distance_missing": missing("DISTANCE"),
    "origin_equals_destination": f"{present('ORIGIN_AIRPORT_ID')} AND ORIGIN_AIRPORT_ID = DEST_AIRPORT_ID",
    **{f"completed_missing_{c.lower()}": f"{RAW_COMPLETED} AND {missing(c)}"
       for c in ("DEP_TIME", "ARR_TIME", "ARR_DELAY", "ARR_DEL15")},
    "cancelled_missing_cancellation_code": f"{_n['CANCELLED']} = 1 AND {missing('CANCELLATION_CODE')}",
    "noncancelled_with_cancellation_code": f"{_n['CANCELLED']} = 0 AND {present('CANCELLATION_CODE')}",
    "cancelled_with_arr_time": f"{_n['CANCELLED']} = 1 AND {present('ARR_TIME')}",
    "diverted_with_arr_delay": f"{_n['DIVERTED']} = 1 AND {present('ARR_DELAY')}",
    "delayed_completed_missing_all_delay_causes":
        f"{RAW_COMPLETED} AND {_n['ARR_DEL15']} = 1 AND " + " AND ".join(missing(c) for c in C.CAUSE_COLUMNS),
}
add("anomaly_counts", long("faulty", [(kind, name, count_if(rule)) for kind, group in
                                      (("confirmed_invalid", CONFIRMED), ("suspicious", SUSPICIOUS)) for name, rule in group.items()],
                           ["kind", "rule", "violations"]), FAULTY)
add("missing_patterns", counted(f"{LINEAGE}, {', '.join(MARKERS)}", "suspects_faulty", "n"), FAULTY, suspects("suspects_faulty"))
DIAGNOSTIC = ("SELECT count(*) AS affected_rows, " + ", ".join(f"{count_if(m)} AS {m}" for m in MARKERS)
              + f", {count_if(' AND '.join(MARKERS))} AS missing_all_three FROM {{0}}")
add("arrival_diagnostic", DIAGNOSTIC.format("suspects_faulty"), FAULTY, suspects("suspects_faulty"))
_review = ["_source_file", "FL_DATE", "OP_UNIQUE_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST", "CRS_DEP_TIME"]
_rest = [c for c in RAW + C.LINEAGE_COLUMNS if c not in _review]
add("suspect_sample", f"SELECT {', '.join(_review)}, _source_year, _source_month, {', '.join(MARKERS)} FROM suspects ORDER BY "
    + ", ".join(f"{c} NULLS FIRST" for c in _review + _rest) + " LIMIT 20", suspects("suspects"))
add("sample_is_truncated", "SELECT count(*) AS affected_rows, count(*) > 20 AS rows_truncated FROM suspects", suspects("suspects"))

# --- ledgers and summaries -------------------------------------------------------------

STATUS_COUNTS = ", ".join(f"count(*) FILTER (WHERE flight_status = '{s}') AS {s}" for s in C.STATUSES_WITH_INVALID)
add("raw_summary", f"SELECT {LINEAGE}, count(*) AS row_count, {STATUS_COUNTS} FROM (SELECT *, {W.RAW_STATUS} AS flight_status FROM faulty) "
    f"GROUP BY {LINEAGE}", FAULTY)
LABEL_RULES = {
    "arr_del15_invalid_domain": "ARR_DEL15 NOT IN (0, 1)",
    "completed_arr_del15_invalid": "flight_status = 'completed' AND (ARR_DEL15 IN (0, 1)) IS NOT TRUE",
    "non_completed_arr_del15_present": "flight_status <> 'completed' AND ARR_DEL15 IS NOT NULL",
}
DOMAIN_RULES = {f"{c}__invalid_binary": f"{c} NOT IN (0, 1)" for c in C.FLAG_COLUMNS} | {
    f"{c}__invalid_hhmm": f"NOT {CLOCK.format(c)}" for c in C.CLOCK_COLUMNS}
add("cleaned_summary", f"SELECT YEAR, MONTH, count(*) AS row_count, {STATUS_COUNTS}, {count_if(missing('_source_file'))} AS source_file_nulls, "
    + ", ".join(f"{count_if(r)} AS {n}" for n, r in {**LABEL_RULES, **DOMAIN_RULES}.items())
    + " FROM cleaned_faulty GROUP BY YEAR, MONTH", FAULTY, CLEAN_FAULTY)
_essential_null = " OR ".join(f"{c} IS NULL" for c in C.ESSENTIAL_ARRIVAL)
MISSING_RULES = {
    **{f"completed_missing_{c.lower()}": f"flight_status = 'completed' AND {c} IS NULL" for c in [*C.ESSENTIAL_ARRIVAL, "ARR_DELAY_NEW"]},
    "completed_missing_essential_arrival": f"flight_status = 'completed' AND ({_essential_null})",
    "completed_only_missing_arr_delay_new":
        f"flight_status = 'completed' AND ARR_DELAY_NEW IS NULL AND {CLOCK.format('ARR_TIME')} AND isfinite(ARR_DELAY) AND ARR_DEL15 IN (0, 1)",
}
add("arrival_missingness", "SELECT YEAR, MONTH, " + ", ".join(f"{count_if(r)} AS {n}" for n, r in MISSING_RULES.items())
    + " FROM typed_faulty GROUP BY YEAR, MONTH", FAULTY, TYPED_FAULTY)
add("month_counts", "SELECT CASE WHEN YEAR IS NOT NULL AND MONTH IS NOT NULL THEN printf('%04d-%02d', YEAR, MONTH) "
    f"ELSE '{C.NO_PARTITION}' END AS partition, count(*) AS row_count FROM typed_faulty GROUP BY 1", FAULTY, TYPED_FAULTY)
RAW_PARTS = f"SELECT _source_year AS year, _source_month AS month, _source_file, {W.RAW_STATUS} AS flight_status, count(*) AS n FROM {{0}} GROUP BY ALL"
CLEAN_PARTS = "SELECT YEAR AS year, MONTH AS month, _source_file, flight_status, count(*) AS n FROM {0} GROUP BY ALL"
add("raw_partition_counts", RAW_PARTS.format("faulty"), FAULTY)
add("cleaned_partition_counts", CLEAN_PARTS.format("cleaned_faulty"), FAULTY, CLEAN_FAULTY)
BAD_FLAG = "{0} IS NOT NULL AND coalesce({1} NOT IN (0, 1), TRUE)"
ISSUES = []
for _c in [*INTS, "FL_DATE", *C.MEASURE_COLUMNS, *C.FLAG_COLUMNS]:
    _s, _t = f"{trim_null(_c)} IS NULL", f"({W.typed(_c)}) IS NULL"
    ISSUES += [(_c, "source_nulls", count_if(_s)), (_c, "target_nulls", count_if(_t)),
               (_c, "introduced_nulls", count_if(f"NOT ({_s}) AND {_t}"))]
ISSUES += [(c, "invalid_binary", count_if(BAD_FLAG.format(trim_null(c), dbl(trim_null(c))))) for c in C.FLAG_COLUMNS]
ISSUES += [(c, "invalid_hhmm", count_if(f"NOT {CLOCK.format(trim_null(c))}")) for c in C.CLOCK_COLUMNS]
add("transformation_issues", long("faulty", ISSUES, ["column", "issue", "records"]), FAULTY)
STATUS_FLIGHTS = ", ".join(f"count(*) FILTER (WHERE flight_status = '{s}') AS {s}_flights" for s in C.STATUSES_WITH_INVALID)
BASELINE = "SELECT YEAR, MONTH, count(*) AS total_flights, " + STATUS_FLIGHTS + " FROM {0} GROUP BY YEAR, MONTH"
PROFILE_BASELINE = ("SELECT _source_year AS YEAR, _source_month AS MONTH, count(*) AS total_flights, " + STATUS_FLIGHTS
                    + f" FROM (SELECT *, {W.RAW_STATUS} AS flight_status FROM {{0}}) GROUP BY ALL")
add("baseline_status_by_month", BASELINE.format("cleaned_faulty"), FAULTY, CLEAN_FAULTY)
add("profile_baseline", PROFILE_BASELINE.format("faulty"), FAULTY)

_bad_causes = " OR ".join(f"({c} IS NOT NULL AND (NOT isfinite({c}) OR {c} < 0))" for c in C.CAUSE_COLUMNS)
_status_fits = f"flight_status = {W.STATUS.format(c='CANCELLED', d='DIVERTED')}"
_label_fits = "CASE WHEN flight_status = 'completed' THEN ARR_DEL15 IN (0, 1) ELSE ARR_DEL15 IS NULL END"
_arrival_there = f"{present('ARR_TIME')} AND ARR_DELAY IS NOT NULL AND ARR_DEL15 IS NOT NULL"
SOURCE_COUNTERS = {
    **{f"{s}_flights": count_if(f"flight_status = '{s}'") for s in C.STATUSES},
    "on_time_arrival_flights": count_if("flight_status = 'completed' AND ARR_DEL15 = 0"),
    "delayed_arrival_flights": count_if(DELAYED),
    "missing_completed_arrival": count_if(f"flight_status = 'completed' AND NOT ({_arrival_there})"),
    "nonfinite_arrival_delay": count_if("NOT isfinite(ARR_DELAY)"),
    "missing_times": count_if(f"{BAND} = 'Missing'"),
    "invalid_times": count_if(f"{BAND} = 'Invalid'"),
    "midnight_2400": count_if("CRS_DEP_TIME = '2400'"),
    "invalid_cause_rows": count_if(_bad_causes),
    "any_reported": count_if(f"{DELAYED} AND {ANY_CAUSE}"),
    "all_reported": count_if(f"{DELAYED} AND {ALL_CAUSES}"),
    **{f"weekday_{d}": count_if(f"DAY_OF_WEEK = {d}") for d in range(1, 8)},
    **{f"band_{b}": count_if(f"{BAND} = '{b}'") for b in C.BAND_LIMITS},
    "invalid_weekdays": bad("DAY_OF_WEEK BETWEEN 1 AND 7"),
    "invalid_statuses": bad("flight_status IN ('completed', 'cancelled', 'diverted')"),
    "status_flag_mismatches": bad(_status_fits),
    "invalid_labels": bad(_label_fits),
    **{f"reported_{c}": f"count({c}) FILTER (WHERE {DELAYED})" for c in C.CAUSE_COLUMNS},
    **{f"minutes_{c}": f"sum({c}) FILTER (WHERE {DELAYED})" for c in C.CAUSE_COLUMNS},
}


def recount(source: str) -> str:
    return ("SELECT YEAR, MONTH, count(*) AS total_flights, " + ", ".join(f"{e} AS {n}" for n, e in SOURCE_COUNTERS.items())
            + f" FROM {source} GROUP BY YEAR, MONTH")


add("source_months", recount("cleaned_faulty"), FAULTY, CLEAN_FAULTY)
INPUT_RULES = {
    "invalid_period": f"YEAR IN ({YEARS}) AND MONTH BETWEEN 1 AND 12",
    "invalid_date": "year(FL_DATE) = YEAR AND month(FL_DATE) = MONTH",
    "missing_grouping_keys": " AND ".join(present(c) for c in ("OP_UNIQUE_CARRIER", "ORIGIN", "DEST")),
    "invalid_status": "flight_status IN ('completed', 'cancelled', 'diverted')",
    "status_flag_mismatch": _status_fits,
    "invalid_arrival_label": _label_fits,
    "missing_completed_arrival": f"flight_status <> 'completed' OR ({_arrival_there})",
    "invalid_completed_arrival_time": f"flight_status <> 'completed' OR {CLOCK.format('ARR_TIME')}",
    "nonfinite_completed_delay": "flight_status <> 'completed' OR ARR_DELAY IS NULL OR isfinite(ARR_DELAY)",
}
add("monthly_input_violations", "SELECT YEAR, MONTH, count(*) AS total_flights, "
    + ", ".join(f"count(*) FILTER (WHERE flight_status = '{s}') AS {s}_flights" for s in C.STATUSES) + ", "
    + ", ".join(f"{bad(r)} AS {n}" for n, r in INPUT_RULES.items()) + " FROM cleaned_faulty GROUP BY YEAR, MONTH", FAULTY, CLEAN_FAULTY)
add("input_checks", checks("cleaned_faulty", {"input_not_empty": "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END",
                                              **{n: bad(r) for n, r in INPUT_RULES.items()}}), FAULTY, CLEAN_FAULTY)
add("grain_stats", f"SELECT count(*) AS \"rows\", count(DISTINCT (YEAR, MONTH, ORIGIN, DEST)) AS unique_keys, "
    f"{bad(f'{QUARTER} AND ORIGIN IS NOT NULL AND DEST IS NOT NULL')} AS invalid_keys, count(DISTINCT (YEAR, MONTH)) AS periods FROM f_route",
    FAULTY, CLEAN_FAULTY, faulty_grain("route"))


def ratio_rule(metric: str) -> str:
    numerator, denominator = C.RATIO_PARTS[metric]
    expected = f"(CAST({numerator} AS DOUBLE) / nullif({denominator}, 0))"
    bounds = f" AND {metric} BETWEEN 0 AND 1" if metric in C.RATE_PARTS else ""
    return (f"CASE WHEN {denominator} = 0 THEN {metric} IS NULL ELSE {metric} IS NOT NULL "
            f"AND abs({metric} - {expected}) <= 1e-12 * greatest(1.0, abs({expected})){bounds} END")


METRIC_RULES = {
    "invalid_counts": " AND ".join(f"{c} IS NOT NULL AND {c} >= 0" for c in C.COUNT_MEASURES),
    "empty_group": "total_flights > 0",
    "status_reconciliation": "total_flights - completed_flights - cancelled_flights - diverted_flights = 0",
    "label_reconciliation": "completed_flights - delayed_arrival_flights - on_time_arrival_flights = 0",
    "observation_count": "completed_flights >= arrival_delay_observed_flights",
    "reviewed_completed_delay_present": "completed_flights = arrival_delay_observed_flights",
    "delay_sum_null_handling": "(arrival_delay_observed_flights = 0) = (arrival_delay_minutes_sum IS NULL)",
    **{f"{m}_formula_or_null": ratio_rule(m) for m in C.RATIO_PARTS},
}


def aggregate_tests(keys: list[str]) -> dict[str, str]:
    return {
        "not_empty": "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END",
        **{n: bad(r) for n, r in METRIC_RULES.items()},
        "null_grain": count_if(" OR ".join(f"{k} IS NULL" for k in keys)),
        "duplicate_excess": f"count(*) - count(DISTINCT ({', '.join(keys)}))",
    }


add("table_summary", "SELECT YEAR, MONTH, count(*) AS aggregate_rows, count(*) - 1 AS duplicate_excess, "
    + ", ".join(f"{big(f'sum({c})')} AS {c}" for c in C.COUNT_MEASURES) + ", sum(arrival_delay_minutes_sum) AS arrival_delay_minutes_sum, "
    + ", ".join(f"{bad(r)} AS {n}" for n, r in METRIC_RULES.items())
    + f", {count_if('YEAR IS NULL OR MONTH IS NULL')} AS null_grain FROM f_origin_airport GROUP BY YEAR, MONTH",
    FAULTY, CLEAN_FAULTY, faulty_grain("origin_airport"))
add("metric_rule_violations", checks(
    "(SELECT * REPLACE (completed_flights + CASE WHEN DEST = 'D0' THEN 1 ELSE 0 END AS completed_flights, "
    "arrival_delay_rate + CASE WHEN DEST = 'D1' THEN 1.0 ELSE 0.0 END AS arrival_delay_rate, "
    "CASE WHEN DEST <> 'D2' THEN arrival_delay_minutes_sum END AS arrival_delay_minutes_sum) FROM t_route)",
    aggregate_tests(C.GRAINS["route"])), CLEAN, grain("route"))

# --- comparisons -----------------------------------------------------------------------

BENT_AIRLINE = {"bent": f"""SELECT * REPLACE (
    completed_flights + CASE WHEN OP_UNIQUE_CARRIER = 'C03' THEN 1 ELSE 0 END AS completed_flights,
    arrival_delay_rate + CASE OP_UNIQUE_CARRIER WHEN 'C02' THEN 1e-13 WHEN 'C04' THEN 0.001 ELSE 0.0 END AS arrival_delay_rate,
    CASE WHEN OP_UNIQUE_CARRIER <> 'C06' THEN arrival_delay_minutes_sum END AS arrival_delay_minutes_sum,
    CASE WHEN OP_UNIQUE_CARRIER = 'C08' THEN 'ZZ' ELSE OP_UNIQUE_CARRIER END AS OP_UNIQUE_CARRIER)
    FROM t_airline WHERE {QUARTER} AND OP_UNIQUE_CARRIER <> 'C05'"""}


def comparison(new: str, old: str, keys: list[str], counts: list[str], doubles: list[str], common: bool) -> list[tuple[str, str, str]]:
    both = "a.here AND b.here AND " if common else ""
    listed = ", ".join(keys)
    repeats = " UNION ".join(f"(SELECT {listed} FROM {t} GROUP BY ALL HAVING count(*) > 1)" for t in (new, old))
    tests = [("keys", "missing_keys", count_if(NO_A)), ("keys", "extra_keys", count_if(NO_B)),
             ("keys", "repeated_keys", f"(SELECT count(*) FROM ({repeats}))")]
    tests += [("counts", c, count_if(f"{both}a.{c} IS DISTINCT FROM b.{c}")) for c in counts]
    return tests + [("doubles", d, count_if(f"{both}NOT {near(f'a.{d}', f'b.{d}')}")) for d in doubles]


_airline_tests = comparison(f"(SELECT * FROM t_airline WHERE {QUARTER})", "bent", C.GRAINS["airline"], C.COUNT_MEASURES, C.DOUBLE_MEASURES, False)
_airline_pairs = full_join(f"(SELECT * FROM t_airline WHERE {QUARTER})", "bent", C.GRAINS["airline"])
add("compare_aggregates", long(_airline_pairs, _airline_tests, ["kind", "measure", "mismatches"]), CLEAN, grain("airline"), BENT_AIRLINE)


def malformed(source: str, side: str) -> str:
    distinct = "count(DISTINCT (YEAR, MONTH, OP_UNIQUE_CARRIER))"
    return checks(source, {f"{side}_grain_and_periods":
                           f"CASE WHEN count(*) = 0 OR count(*) <> {distinct} OR count(DISTINCT (YEAR, MONTH)) <> 3 THEN 1 ELSE 0 END "
                           f"+ {bad(QUARTER)}"})


add("aggregate_regression", union(
    literal_check("schema"),
    malformed(f"(SELECT * FROM t_airline WHERE {QUARTER})", "current"),
    malformed("bent", "reference"),
    checks(_airline_pairs, {f"{kind}.{measure}": e for kind, measure, e in _airline_tests}),
), CLEAN, grain("airline"), BENT_AIRLINE)
BAND_COUNTS = ["total_flights", "completed_flights", "delayed_arrival_flights", "scheduled_2400_flights"]
_bent_bands = ("(SELECT * REPLACE (total_flights + CASE WHEN time_band = 'Night' THEN 1 ELSE 0 END AS total_flights, "
               "CASE WHEN time_band <> 'Evening' THEN arrival_delay_rate + 1e-13 END AS arrival_delay_rate) FROM all_bands "
               f"WHERE {QUARTER} AND time_band <> 'Missing')")
add("compare_summary", long(
    full_join(f"(SELECT * FROM all_bands WHERE {QUARTER})", _bent_bands, ["YEAR", "MONTH", "time_band"]),
    comparison(f"(SELECT * FROM all_bands WHERE {QUARTER})", _bent_bands, ["YEAR", "MONTH", "time_band"], BAND_COUNTS,
               ["arrival_delay_rate"], True), ["kind", "measure", "mismatches"]),
    CLEAN, {"all_bands": bands("cleaned")})

# One month of the kept bands twice, and a band under a name that does not exist. Repeated keys are added up.
_kept_bands = (f"(SELECT * REPLACE (CASE WHEN time_band = 'Evening' AND MONTH = 2 THEN 'Dusk' ELSE time_band END AS time_band) FROM ("
               f"SELECT * FROM all_bands WHERE {QUARTER} UNION ALL SELECT * FROM all_bands WHERE YEAR = 1996 AND MONTH = 1))")
_added_bands = (f"(SELECT YEAR, MONTH, time_band, {', '.join(f'sum({c}) AS {c}' for c in [*BAND_COUNTS, 'arrival_delay_rate'])} "
                f"FROM {_kept_bands} GROUP BY ALL)")
_band_names = ", ".join(f"'{b}'" for b in C.BAND_ORDER)
add("summary_regression", union(
    checks(_kept_bands, {
        "reference_schema": "0",
        "reference.departure_time_band_bounded_rows": f"greatest(count(*) - {3 * len(C.BAND_ORDER)}, 0)",
        "reference_domain_and_period": bad(f"time_band IN ({_band_names}) AND {QUARTER}"),
    }),
    checks(full_join(f"(SELECT * FROM all_bands WHERE {QUARTER})", _added_bands, ["YEAR", "MONTH", "time_band"]), {
        f"{kind}.{measure}": e for kind, measure, e in comparison(
            f"(SELECT * FROM all_bands WHERE {QUARTER})", _kept_bands, ["YEAR", "MONTH", "time_band"], BAND_COUNTS, ["arrival_delay_rate"], True)}),
), CLEAN, {"all_bands": bands("cleaned")})


def except_all(left: str, right: str, columns: str) -> str:
    return f"SELECT {columns} FROM {left} EXCEPT ALL SELECT {columns} FROM {right}"


add("same_values", f"SELECT x AS only_left, y AS only_right, x = 0 AND y = 0 AS same FROM (SELECT "
    f"(SELECT count(*) FROM ({except_all('raw', 'faulty', RAW_LIST)})) AS x, (SELECT count(*) FROM ({except_all('faulty', 'raw', RAW_LIST)})) AS y)",
    FAULTY)
_signed = RAW_LIST
add("signed_rows", f"SELECT {_signed}, CAST(sum(s) AS BIGINT) AS surplus FROM (SELECT {_signed}, 1 AS s FROM raw UNION ALL "
    f"SELECT {_signed}, -1 FROM faulty) GROUP BY ALL HAVING sum(s) <> 0", FAULTY)
add("diff", union(except_all("raw", "faulty", RAW_LIST), except_all("faulty", "raw", RAW_LIST)), FAULTY)
_reject_columns = f"{RAW_LIST}, {LINEAGE}"
_kept = f"(SELECT {_reject_columns} FROM judged_faulty WHERE is_rejected)"
_reviewed = f"(SELECT {_reject_columns} FROM judged WHERE is_rejected)"
add("approved_reject_match", f"SELECT x AS only_left, y AS only_right, x = 0 AND y = 0 AS same FROM (SELECT "
    f"(SELECT count(*) FROM ({except_all(_kept, _reviewed, _reject_columns)})) AS x, "
    f"(SELECT count(*) FROM ({except_all(_reviewed, _kept, _reject_columns)})) AS y)", CLEAN, FAULTY, CLEAN_FAULTY)
_approved = f"(SELECT *, {_markers} FROM judged WHERE is_rejected)"
add("approved_reject_self_check", checks(_approved, {
    "without_missing_field": bad(" OR ".join(MARKERS)),
    "not_completed": bad(RAW_COMPLETED),
    "affected_rows_differs": "abs(count(*) - (SELECT count(*) FROM suspects_faulty))",
    **{f"{m}_differs": f"abs({count_if(m)} - (SELECT {count_if(m)} FROM suspects_faulty))" for m in MARKERS},
}), CLEAN, FAULTY, suspects("suspects_faulty"))

# --- reconciliation and checks ---------------------------------------------------------

REJECTS_FAULTY = "(SELECT * FROM judged_faulty WHERE is_rejected)"
add("reconcile_partition_counts", checks(
    f"(SELECT sum(r) AS r, sum(k) AS k FROM (SELECT year, month, _source_file, flight_status, n AS r, 0 AS k FROM ({RAW_PARTS.format('faulty')}) "
    f"UNION ALL SELECT year, month, _source_file, flight_status, 0, n FROM ({CLEAN_PARTS.format('cleaned_faulty')}) "
    f"UNION ALL SELECT year, month, _source_file, flight_status, 0, n FROM ({RAW_PARTS.format(REJECTS_FAULTY)})) "
    "GROUP BY year, month, _source_file, flight_status)", {"file_month_status_conservation": count_if("r <> k")}), FAULTY, CLEAN_FAULTY)
ROLLUP = ("(SELECT YEAR, MONTH, " + ", ".join(f"sum({c}) AS {c}" for c in [*C.COUNT_MEASURES, "arrival_delay_minutes_sum"])
          + " FROM {0} GROUP BY YEAR, MONTH)")


def month_tests(sums: str = "arrival_delay_minutes_sum") -> dict[str, str]:
    return {
        "same_months": count_if(f"{NO_A} OR {NO_B}"),
        "monthly_counts": count_if(" OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in C.COUNT_MEASURES)),
        "monthly_delay_minutes_sum": count_if(f"{NO_A} OR {NO_B} OR NOT {near(f'a.{sums}', f'b.{sums}', '1e-8')}"),
    }


YM = ["YEAR", "MONTH"]
add("reconcile_months", checks(full_join(ROLLUP.format(
    "(SELECT * FROM t_airline WHERE NOT (OP_UNIQUE_CARRIER = 'C05' AND MONTH = 4) AND NOT (YEAR = 1997 AND MONTH = 5))"),
    "t_monthly", YM), month_tests()), CLEAN, grain("airline", "monthly"))
PERIOD = {"period": PERIOD_TABLE}
_three = ("(SELECT a, b, p FROM (SELECT DISTINCT YEAR, MONTH FROM (SELECT YEAR, MONTH FROM {0} UNION ALL SELECT YEAR, MONTH FROM {1} "
          "UNION ALL SELECT YEAR, MONTH FROM {2})) AS k "
          "LEFT JOIN (SELECT *, TRUE AS here FROM {0}) AS a ON a.YEAR IS NOT DISTINCT FROM k.YEAR AND a.MONTH IS NOT DISTINCT FROM k.MONTH "
          "LEFT JOIN (SELECT *, TRUE AS here FROM {1}) AS b ON b.YEAR IS NOT DISTINCT FROM k.YEAR AND b.MONTH IS NOT DISTINCT FROM k.MONTH "
          "LEFT JOIN (SELECT *, TRUE AS here FROM {2}) AS p ON p.YEAR IS NOT DISTINCT FROM k.YEAR AND p.MONTH IS NOT DISTINCT FROM k.MONTH)")
NO_P = "p.here IS NULL"
EITHER = "(a.here OR b.here)"
add("reconcile_status_months", checks(_three.format("f_monthly", "baseline", "period"), {
    "exact_month_coverage": count_if(f"{NO_A} OR {NO_B} OR {NO_P}"),
    **{f"monthly_{m}": count_if(f"{EITHER} AND a.{m} IS DISTINCT FROM b.{m}") for m in C.STATUS_MEASURES},
}), CLEAN, FAULTY, CLEAN_FAULTY, faulty_grain("monthly"), {"baseline": BASELINE.format("cleaned")}, PERIOD)
add("reconcile_baseline", checks(_three.format("t_monthly", "baseline", "period"), {
    "configured_month_coverage": count_if(f"{NO_A} OR {NO_B} OR {NO_P}"),
    "month_counts": count_if(f"{EITHER} AND a.total_flights IS DISTINCT FROM b.total_flights"),
    "total": "abs(sum(a.total_flights) - sum(b.total_flights))",
    "no_invalid_status": "sum(b.invalid_flights)",
    **{s: f"abs(sum(a.{s}_flights) - sum(b.{s}_flights))" for s in C.STATUSES},
}), CLEAN, FAULTY, grain("monthly"), {"baseline": PROFILE_BASELINE.format("faulty")}, PERIOD)
_labels = ["delayed_arrival_flights", "on_time_arrival_flights"]
add("reconcile_source", checks(_three.format("source", "baseline", "t_monthly"), {
    "same_months": count_if(f"{NO_A} OR {NO_B} OR {NO_P}"),
    **{f"baseline_{m}": count_if(f"a.{m} IS DISTINCT FROM b.{m} OR a.{m} IS DISTINCT FROM p.{m}") for m in C.STATUS_MEASURES},
    **{f"monthly_{m}": count_if(f"a.{m} IS DISTINCT FROM p.{m}") for m in _labels},
    "status_and_label_reconciliation": count_if(
        "a.here AND NOT (a.total_flights = a.completed_flights + a.cancelled_flights + a.diverted_flights "
        "AND a.completed_flights = a.delayed_arrival_flights + a.on_time_arrival_flights)"),
}), CLEAN, FAULTY, CLEAN_FAULTY, grain("monthly"), {"baseline": BASELINE.format("cleaned"), "source": recount("cleaned_faulty")})
add("grain_unique", checks("f_route", {
    "null_grain": count_if("YEAR IS NULL OR MONTH IS NULL OR ORIGIN IS NULL"),
    "duplicate_excess": "count(*) - count(DISTINCT (YEAR, MONTH, ORIGIN))",
}), FAULTY, CLEAN_FAULTY, faulty_grain("route"))


def prefixed(prefix: str, sql: str) -> str:
    return f"SELECT * REPLACE ('{prefix}.' || \"check\" AS \"check\") FROM ({sql})"


_table_parts = []
for _level, _keys in C.GRAINS.items():
    _parts = [literal_check("schema"), checks(f"f_{_level}", aggregate_tests(_keys))]
    if _level != "monthly":
        _parts.append(checks(full_join(ROLLUP.format(f"f_{_level}"), "f_monthly", YM), month_tests()))
    _table_parts.append(prefixed(_level, union(*_parts)))
add("aggregate_checks", union(*_table_parts), FAULTY, CLEAN_FAULTY, GRAINS_FAULTY)
add("aggregate_read_back", union(
    literal_check("schema"), checks("t_origin_airport", aggregate_tests(C.GRAINS["origin_airport"])),
    checks(full_join(ROLLUP.format("t_origin_airport"), "t_monthly", YM), month_tests()), literal_check("all_values"),
), CLEAN, grain("origin_airport", "monthly"))
add("source_input_checks", checks(full_join("source", "period", YM), {
    "input_nonempty": "CASE WHEN coalesce(sum(a.total_flights), 0) = 0 THEN 1 ELSE 0 END",
    "input_configured_months": count_if(f"{NO_A} OR {NO_B}"),
    **{f"input_{c}": f"sum(a.{c})" for c in (
        "invalid_weekdays", "invalid_statuses", "invalid_labels", "invalid_cause_rows",
        "status_flag_mismatches", "missing_completed_arrival", "nonfinite_arrival_delay")},
    "finite_monthly_cause_sums": count_if(" OR ".join(f"NOT isfinite(a.minutes_{c})" for c in C.CAUSE_COLUMNS)),
}), FAULTY, CLEAN_FAULTY, {"source": recount("cleaned_faulty")}, PERIOD)


def performance(dimension: str, cells: dict, extra_columns: str = "") -> tuple[str, dict[str, str]]:
    """Monthly fold of summary rows beside the recount, and the tests on it."""
    def text(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    domain = ", ".join(map(text, cells))
    order = ("delayed_arrival_flights BETWEEN 0 AND completed_flights AND completed_flights <= total_flights AND total_flights > 0 AND "
             + quotient_fits("arrival_delay_rate", "delayed_arrival_flights", "completed_flights"))
    folded = (f"(SELECT YEAR, MONTH, {bad(f'{dimension} IN ({domain})')} AS outside, {bad(order)} AS bad_counts, "
              + ", ".join(f"sum({c}) AS {c}" for c in ("total_flights", "completed_flights", "delayed_arrival_flights")) + ", "
              + ", ".join(f"sum(total_flights) FILTER (WHERE {dimension} = {text(v)}) AS cell_{c}" for v, c in cells.items())
              + extra_columns + " FROM summary GROUP BY YEAR, MONTH)")
    tests = {
        "grain_and_domain": f"coalesce(sum(a.outside), 0) + {count_if(NO_B)}",
        "counts_and_rates": "sum(a.bad_counts)",
        "monthly_counts": count_if(" OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in (
            "total_flights", "completed_flights", "delayed_arrival_flights"))),
        "observed_grain_coverage": count_if(" OR ".join(
            f"(a.cell_{c} IS NOT NULL) <> (coalesce(b.{c}, 0) > 0)" for c in cells.values())),
    }
    return full_join(folded, "source", YM), tests


def cells_differ(columns) -> str:
    return count_if(" OR ".join(f"coalesce(a.cell_{c}, 0) <> coalesce(b.{c}, 0)" for c in columns))


SOURCE = {"source": recount("cleaned")}
_cells = {d: f"weekday_{d}" for d in range(1, 8)}
_pairs, _tests = performance("DAY_OF_WEEK", _cells)
add("weekday_checks", checks(_pairs, _tests | {"weekday_totals": cells_differ(_cells.values())}),
    CLEAN, FAULTY, CLEAN_FAULTY, {"summary": weekdays("cleaned_faulty")}, SOURCE)
_hours = {b: f"band_{b}" for b in C.BAND_LIMITS}
_left = {"Missing": "missing_times", "Invalid": "invalid_times"}
_pairs, _tests = performance("time_band", _hours | _left, ", sum(scheduled_2400_flights) AS midnight, " + count_if(
    "scheduled_2400_flights NOT BETWEEN 0 AND total_flights OR (time_band <> 'Night' AND scheduled_2400_flights <> 0)") + " AS misplaced")
add("band_checks", checks(_pairs, _tests | {
    "hour_boundaries": cells_differ(_hours.values()),
    "missing_invalid_retained": cells_differ(_left.values()),
    "2400_is_night": "coalesce(sum(a.misplaced), 0) + " + count_if("a.midnight IS DISTINCT FROM b.midnight_2400"),
}), CLEAN, FAULTY, CLEAN_FAULTY, {"summary": bands("cleaned_faulty")}, SOURCE)
_month_minutes = " + ".join(f"coalesce(minutes_{c}, 0)" for c in C.CAUSE_COLUMNS)
_expected_causes = union(*(
    f"SELECT YEAR, MONTH, '{c}' AS cause_category, delayed_arrival_flights AS eligible_delayed_flights, reported_{c} AS reported_cause_flights, "
    "any_reported AS flights_with_any_reported_cause, all_reported AS flights_with_all_reported_causes, "
    f"minutes_{c} AS attributed_minutes, CASE WHEN any_reported > 0 THEN {_month_minutes} END AS monthly_attributed_minutes "
    "FROM source WHERE delayed_arrival_flights > 0" for c in C.CAUSE_COLUMNS))
_coverage = ["eligible_delayed_flights", "reported_cause_flights", "flights_with_any_reported_cause", "flights_with_all_reported_causes"]
_cause_rule = ("a.reported_cause_flights BETWEEN 0 AND a.eligible_delayed_flights AND a.flights_with_all_reported_causes >= 0 "
               "AND a.flights_with_all_reported_causes <= a.flights_with_any_reported_cause "
               "AND a.flights_with_any_reported_cause <= a.eligible_delayed_flights AND "
               "CASE WHEN a.reported_cause_flights = 0 THEN a.attributed_minutes IS NULL ELSE coalesce(a.attributed_minutes >= 0, FALSE) END")
_share_rule = (near("a.monthly_attributed_minutes", "b.monthly_attributed_minutes") + " AND "
               + quotient_fits("a.cause_minute_share", "a.attributed_minutes", "b.monthly_attributed_minutes"))
add("cause_checks", union(
    checks(full_join("summary", "expected", ["YEAR", "MONTH", "cause_category"]), {
        "grain_and_categories": count_if(f"{NO_A} OR {NO_B}"),
        "nonnegative_counts_and_null_minutes": count_if(f"a.here AND ({_cause_rule}) IS NOT TRUE"),
        "coverage_counts": count_if("a.here AND b.here AND (" + " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in _coverage) + ")"),
        "reported_minutes": count_if(f"a.here AND b.here AND NOT {near('a.attributed_minutes', 'b.attributed_minutes')}"),
        "denominators_and_shares": count_if(f"a.here AND b.here AND ({_share_rule}) IS NOT TRUE"),
    }),
    checks("(SELECT max(monthly_attributed_minutes) AS minutes, sum(cause_minute_share) AS shares FROM summary GROUP BY YEAR, MONTH)",
           {"share_sum": bad("CASE WHEN minutes > 0 THEN abs(shares - 1) <= 1e-9 ELSE shares IS NULL END")}),
), CLEAN, FAULTY, CLEAN_FAULTY, {"summary": causes("cleaned_faulty")}, SOURCE, {"expected": _expected_causes})
add("bounded_rows", checks(f"({bands('cleaned_faulty')})", {
    "departure_time_band_bounded_rows": "CASE WHEN count(*) > 84 * 6 THEN 1 ELSE 0 END"}), FAULTY, CLEAN_FAULTY)
add("monthly_baseline_check", union(
    literal_check("schema"), checks("t_monthly", aggregate_tests(YM)),
    checks(full_join("t_monthly", "f_monthly", YM), month_tests()),
    literal_check("row_count", "abs((SELECT count(*) FROM t_monthly) - (SELECT count(*) FROM f_monthly))"),
), CLEAN, FAULTY, CLEAN_FAULTY, grain("monthly"), faulty_grain("monthly"))


def pre_write(source: str, judged: str, kept: str, all_typed: str) -> str:
    """The 24 checks, each from its own definition; the evidence comes from the view without faults."""
    rejected = f"(SELECT * FROM {judged} WHERE is_rejected)"
    status_rows = union(*(f"SELECT YEAR AS year, MONTH AS month, NULL AS _source_file, '{s}' AS flight_status, {s}_flights AS n FROM base"
                          for s in C.STATUSES_WITH_INVALID))
    sides = {"r": RAW_PARTS.format(source), "c": CLEAN_PARTS.format(kept), "x": RAW_PARTS.format(rejected), "b": status_rows}
    stacked = union(*(
        f"SELECT year, month, _source_file, flight_status, {', '.join(f'n AS {k}' if k == side else f'0 AS {k}' for k in sides)} FROM ({sql})"
        for side, sql in sides.items()))

    def groups(keys: str, condition: str) -> str:
        return (f"(SELECT {count_if(condition)} FROM (SELECT {keys}, sum(r) AS r, sum(c) AS c, sum(x) AS x, sum(b) AS b FROM parts GROUP BY {keys}))")

    def records(table: str, rules) -> str:
        return f"(SELECT {' + '.join(count_if(r) for r in rules)} FROM {table})"

    def total(expression: str, where: str = "TRUE") -> str:
        return f"(SELECT coalesce(sum({expression}), 0) FROM parts WHERE {where})"

    issues = "(SELECT " + " + ".join(e for _, kind, e in ISSUES if kind not in ("source_nulls", "target_nulls")) + f" FROM {source})"
    binary = [r for n, r in DOMAIN_RULES.items() if n.endswith("binary")]
    clocks = [r for n, r in DOMAIN_RULES.items() if n.endswith("hhmm")]
    lost = MISSING_RULES["completed_missing_essential_arrival"]
    columns = f"{RAW_LIST}, _source_file, flight_status"
    window = f"(SELECT {columns} FROM {kept} WHERE {QUARTER})"
    reference = f"(SELECT {columns} FROM cleaned WHERE {QUARTER})"
    found = f"(SELECT {_reject_columns} FROM {judged} WHERE is_rejected)"

    def differences(left: str, right: str, names: str) -> str:
        return (f"(SELECT count(*) FROM ({except_all(left, right, names)})) + (SELECT count(*) FROM ({except_all(right, left, names)}))")

    tests = {
        "raw_dataset_is_not_empty": f"CASE WHEN {total('r')} = 0 THEN 1 ELSE 0 END",
        "raw_count_equals_cleaned_plus_rejected": f"abs({total('r - c - x')})",
        "month_counts_reconcile": groups("year, month", "r <> c + x"),
        "status_counts_reconcile": groups("flight_status", "r <> c + x"),
        "file_month_status_conservation": groups("year, month, _source_file, flight_status", "r <> c + x"),
        "status_reconciles_to_cleaned_count": "0",
        "no_invalid_flight_status": total("c", "flight_status = 'invalid'"),
        "no_invalid_raw_status": total("r", "flight_status = 'invalid'"),
        "no_unexpected_cast_or_hhmm_issues": issues,
        "output_binary_domains_are_valid": records(kept, binary),
        "output_hhmm_values_are_valid_strings": records(kept, clocks),
        "source_file_lineage_is_present": records(kept, [missing("_source_file")]),
        "arr_del15_row_level_rules": records(kept, LABEL_RULES.values()),
        "raw_count_matches_baseline": f"abs({total('r - b')})",
        "raw_months_match_baseline": groups("year, month", "r <> b"),
        "raw_status_matches_baseline": groups("flight_status", "r <> b"),
        "rejected_only_completed": total("x", "flight_status <> 'completed'"),
        "missing_essential_count_matches_rejected": f"abs({records(all_typed, [lost])} - {total('x')})",
        "cleaned_has_essential_arrival": records(kept, [lost]),
        "reference_window_has_no_rejects": total("x", "year = 1996 AND month IN (1, 2, 3)"),
        "cleaned_schema_matches_contract": "0",
        "rejected_schema_contract": "0",
        "rejected_matches_approved": differences(found, _reviewed, _reject_columns),
        "reference_window_values_unchanged": differences(window, reference, columns),
    }
    inner = " UNION ALL ".join(f"SELECT '{n}' AS \"check\", CAST({e} AS BIGINT) AS violations" for n, e in tests.items())
    return f"SELECT \"check\", violations, violations = 0 AS passed FROM (WITH parts AS ({stacked}) {inner})"


_base = {"base": PROFILE_BASELINE.format("raw")}
add("pre_write_checks", pre_write("raw", "judged", "cleaned", "typed"), CLEAN, {"typed": W.cleaned_from("raw")}, _base)
add("pre_write_checks_faulty", pre_write("faulty", "judged_faulty", "cleaned_faulty", "typed_faulty"),
    CLEAN, FAULTY, CLEAN_FAULTY, TYPED_FAULTY, _base)


# --- repeated months: each side is added up per month first, so totals hold every row ------


def added(table: str, columns: list[str]) -> str:
    return f"(SELECT YEAR, MONTH, count(*) AS times, {', '.join(f'sum({c}) AS {c}' for c in columns)} FROM {table} GROUP BY ALL)"


def twice(table: str) -> str:
    return f"(SELECT * FROM {table} UNION ALL SELECT * FROM {table} WHERE YEAR = 1996 AND MONTH = 1)"


def not_once(*sides: str) -> str:
    return count_if(" OR ".join([NO_A, NO_B] + [NO_P] * (len(sides) > 2) + [f"{s}.times > 1" for s in sides]))


_status_invalid = [*C.STATUS_MEASURES, "invalid_flights"]
_once = "(SELECT *, 1 AS times FROM period)"
add("reconcile_baseline_repeated", checks(_three.format(added("t_monthly", C.STATUS_MEASURES), added(twice("baseline"), _status_invalid), _once), {
    "configured_month_coverage": not_once("a", "b", "p"),
    "month_counts": count_if(f"{EITHER} AND a.total_flights IS DISTINCT FROM b.total_flights"),
    "total": "abs(sum(a.total_flights) - sum(b.total_flights))",
    "no_invalid_status": "sum(b.invalid_flights)",
    **{s: f"abs(sum(a.{s}_flights) - sum(b.{s}_flights))" for s in C.STATUSES},
}), CLEAN, grain("monthly"), {"baseline": PROFILE_BASELINE.format("raw")}, PERIOD)
_source_counts = [*C.STATUS_MEASURES, *_labels]
add("reconcile_source_repeated", checks(_three.format(added(twice("source"), _source_counts), added("baseline", C.STATUS_MEASURES), added("t_monthly", _source_counts)), {
    "same_months": not_once("a", "b", "p"),
    **{f"baseline_{m}": count_if(f"a.{m} IS DISTINCT FROM b.{m} OR a.{m} IS DISTINCT FROM p.{m}") for m in C.STATUS_MEASURES},
    **{f"monthly_{m}": count_if(f"a.{m} IS DISTINCT FROM p.{m}") for m in _labels},
    "status_and_label_reconciliation": count_if(
        "a.here AND NOT (a.total_flights = a.completed_flights + a.cancelled_flights + a.diverted_flights "
        "AND a.completed_flights = a.delayed_arrival_flights + a.on_time_arrival_flights)"),
}), CLEAN, grain("monthly"), {"baseline": BASELINE.format("cleaned"), "source": recount("cleaned")})
INPUT_COUNTS = ("invalid_weekdays", "invalid_statuses", "invalid_labels", "invalid_cause_rows",
                "status_flag_mismatches", "missing_completed_arrival", "nonfinite_arrival_delay")
_minutes = [f"minutes_{c}" for c in C.CAUSE_COLUMNS]
add("source_input_checks_repeated", checks(full_join(added(twice("source"), ["total_flights", *INPUT_COUNTS, *_minutes]), _once, YM), {
    "input_nonempty": "CASE WHEN coalesce(sum(a.total_flights), 0) = 0 THEN 1 ELSE 0 END",
    "input_configured_months": not_once("a", "b"),
    **{f"input_{c}": f"sum(a.{c})" for c in INPUT_COUNTS},
    "finite_monthly_cause_sums": count_if(" OR ".join(f"NOT isfinite(a.{m})" for m in _minutes)),
}), CLEAN, {"source": recount("cleaned")}, PERIOD)


# --- tables and files read back: what should have been written, computed from the view -----


def csv_back(back: str) -> str:
    listed = "YEAR, MONTH, time_band, " + ", ".join([*BAND_COUNTS, "arrival_delay_rate"])
    both = [f"(SELECT count(*) FROM ({except_all(x, y, listed)}))" for x, y in (("all_bands", back), (back, "all_bands"))]
    rows = f"(SELECT count(*) FROM {back})"
    return checks("(SELECT 1)", {
        "csv_schema": f"(SELECT count(*) FROM {back} WHERE FALSE)",
        "departure_time_band_bounded_rows": f"greatest({rows} - (SELECT count(*) FROM period) * {len(C.BAND_ORDER)}, 0)",
        "csv_rows": f"abs((SELECT count(*) FROM all_bands) - {rows})",
        "csv_values": " + ".join(both),
    })


_bands = {"all_bands": bands("cleaned")}
add("csv_round_trip", csv_back("all_bands"), CLEAN, _bands, PERIOD)
add("csv_round_trip_faulty", csv_back(
    "(SELECT * REPLACE (total_flights + CASE WHEN time_band = 'Night' THEN 1 ELSE 0 END AS total_flights) FROM all_bands WHERE time_band <> 'Evening')"),
    CLEAN, _bands, PERIOD)


def read_back(back: str, reject_back: str) -> str:
    rejected = "(SELECT * FROM judged WHERE is_rejected)"
    sides = {"r": RAW_PARTS.format("raw"), "c": CLEAN_PARTS.format("cleaned"), "x": RAW_PARTS.format(rejected),
             "b": CLEAN_PARTS.format(back), "y": RAW_PARTS.format(reject_back)}
    stacked = union(*(
        f"SELECT year, month, _source_file, flight_status, {', '.join(f'n AS {k}' if k == side else f'0 AS {k}' for k in sides)} FROM ({sql})"
        for side, sql in sides.items()))
    partition = "year, month, _source_file, flight_status"

    def groups(keys: str, condition: str) -> str:
        sums = ", ".join(f"sum({k}) AS {k}" for k in sides)
        return f"(SELECT {count_if(condition)} FROM (SELECT {sums} FROM parts GROUP BY {keys}))"

    def records(rules) -> str:
        return f"(SELECT {' + '.join(count_if(r) for r in rules)} FROM {back})"

    def differences(left: str, right: str, names: str) -> str:
        return f"(SELECT count(*) FROM ({except_all(left, right, names)})) + (SELECT count(*) FROM ({except_all(right, left, names)}))"

    changed = " OR ".join(f"sum(CASE WHEN {rule} THEN s ELSE 0 END) <> 0" for rule in MISSING_RULES.values())
    columns = f"{RAW_LIST}, _source_file, flight_status"
    tests = {
        "read_back_missingness_unchanged":
            f"(SELECT count(*) FROM (SELECT YEAR, MONTH FROM (SELECT *, 1 AS s FROM cleaned UNION ALL SELECT *, -1 AS s FROM {back}) "
            f"GROUP BY YEAR, MONTH HAVING {changed}))",
        "read_back_essential_arrival_present": records([MISSING_RULES["completed_missing_essential_arrival"]]),
        "read_back_rejected_counts": groups(partition, "x <> y"),
        "read_back_partition_counts_unchanged": groups(partition, "c <> b OR x <> y"),
        "read_back_raw_equals_accepted_plus_rejected": groups(partition, "r <> b + y"),
        "read_back_count_matches_pre_write": "(SELECT abs(sum(c) - sum(b)) FROM parts)",
        "read_back_months_match_pre_write": groups("year, month", "c <> b"),
        "read_back_status_matches_pre_write": groups("flight_status", "c <> b"),
        "read_back_status_reconciles":
            f"(SELECT {count_if('flight_status IS NULL OR flight_status NOT IN (' + ', '.join(repr(s) for s in C.STATUSES_WITH_INVALID) + ')')} FROM {back})",
        "read_back_arr_del15_rules": records(LABEL_RULES.values()),
        "read_back_binary_domains_are_valid": records([r for n, r in DOMAIN_RULES.items() if n.endswith("binary")]),
        "read_back_hhmm_values_are_valid_strings": records([r for n, r in DOMAIN_RULES.items() if n.endswith("hhmm")]),
        "read_back_lineage_present": records([missing("_source_file")]),
        "read_back_schema_matches_contract": f"(SELECT count(*) FROM {back} WHERE FALSE)",
        "read_back_rejected_schema": f"(SELECT count(*) FROM {reject_back} WHERE FALSE)",
        "read_back_rejected_all_values": differences(f"(SELECT {_reject_columns} FROM judged WHERE is_rejected)", f"(SELECT {_reject_columns} FROM {reject_back})", _reject_columns),
        "read_back_reference_values_unchanged":
            differences(f"(SELECT {columns} FROM {back} WHERE {QUARTER})", f"(SELECT {columns} FROM cleaned WHERE {QUARTER})", columns),
    }
    return f"SELECT * FROM (WITH parts AS ({stacked}) {checks('(SELECT 1)', tests)})"


add("read_back_checks", read_back("cleaned", "(SELECT * FROM judged WHERE is_rejected)"), CLEAN)
add("read_back_checks_faulty", read_back(
    "(SELECT * REPLACE (DISTANCE + CASE WHEN OP_UNIQUE_CARRIER = 'C03' AND MONTH = 1 THEN 1 ELSE 0 END AS DISTANCE) FROM cleaned WHERE NOT (YEAR = 1996 AND MONTH = 2))",
    "(SELECT * FROM judged WHERE is_rejected AND _source_month IS DISTINCT FROM 3)"), CLEAN)
# Corrected months take the place of wrong ones, and a refused delivery leaves the published table: both read as the accepted flights.
BY_MONTH = "SELECT YEAR, MONTH, count(*) AS flights, sum(DISTANCE) AS distance{} FROM cleaned GROUP BY YEAR, MONTH"
add("replace_months", BY_MONTH.format(""), CLEAN)
add("publish_refused", BY_MONTH.format(", TRUE AS refused"), CLEAN)

# --- deliveries ------------------------------------------------------------------------

add("same_values_by_digest", f"SELECT x AS only_left, y AS only_right, x = 0 AND y = 0 AS same FROM (SELECT "
    f"(SELECT count(*) FROM ({except_all('raw', 'faulty', RAW_LIST)})) AS x, (SELECT count(*) FROM ({except_all('faulty', 'raw', RAW_LIST)})) AS y)",
    FAULTY)
add("same_values_equal", f"SELECT x AS only_left, x AS only_right, x = 0 AS same FROM (SELECT count(*) AS x FROM ({except_all('cleaned', 'cleaned', '*')}))", CLEAN)
add("malformed_rows", "SELECT _source_file, count(*) FILTER (WHERE NOT broken) AS read_rows, count(*) FILTER (WHERE broken) AS malformed_rows "
    "FROM (SELECT _source_file, CAST(OP_CARRIER_FL_NUM AS BIGINT) % 97 IN (5, 6) AS broken FROM raw) GROUP BY ALL")
# A month's file: its lines in the order of their text, each with a line break.
DELIVERED = ("SELECT _source_file AS file_name, string_agg(line || chr(10), '' ORDER BY line) AS content FROM (SELECT _source_file, "
             "concat_ws(',', FL_DATE, OP_UNIQUE_CARRIER, OP_CARRIER_FL_NUM, TAIL_NUM, CRS_DEP_TIME, DISTANCE) AS line FROM raw) GROUP BY ALL")
add("file_digests", f"SELECT file_name, CAST(octet_length(encode(content)) AS BIGINT) AS size_bytes, sha256(content) AS sha256 FROM ({DELIVERED})")
# The manifest of those files with its planted faults, held against them file by file.
MANIFEST = """(SELECT f.file_name, m.file_name AS listed, f.size <> m.size AS other_size, f.hash <> lower(m.hash) AS other_hash,
    NOT regexp_full_match(m.hash, '[0-9a-fA-F]{64}') AS no_hash
  FROM facts f FULL JOIN (
    SELECT CASE WHEN copied THEN 'ontime_1990_01.csv' ELSE file_name END AS file_name, size + CAST(file_name LIKE '%1996_06.csv' AS BIGINT) AS size,
      CASE WHEN file_name LIKE '%1996_07.csv' THEN sha256(hash) WHEN file_name LIKE '%1996_08.csv' THEN 'unknown' ELSE upper(hash) END AS hash
    FROM (SELECT *, FALSE AS copied FROM facts UNION ALL SELECT *, TRUE FROM facts WHERE file_name LIKE '%1996_09.csv')
    WHERE file_name NOT LIKE '%1996_05.csv') m ON f.file_name = m.file_name)"""
add("check_manifest", checks(MANIFEST, {
    "no_missing_file": count_if("file_name IS NULL"), "no_unexpected_file": count_if("listed IS NULL"),
    "no_repeated_file": "(SELECT count(*) FROM (SELECT file_name FROM facts GROUP BY ALL HAVING count(*) > 1))",
    "manifest_hash_well_formed": count_if("no_hash"), "sizes_match": count_if("other_size"), "hashes_match": count_if("other_hash"),
}), {"facts": f"SELECT file_name, octet_length(encode(content)) AS size, sha256(content) AS hash FROM ({DELIVERED})"})
_names = ", ".join(f"'{c}'" for c in RAW)
_headers = {"headers": f"SELECT _source_file AS file_name, CASE WHEN _source_file LIKE '%1996_02%' THEN [{_names}][:-2] "
            f"WHEN _source_file LIKE '%1996_03%' THEN list_prepend(lower('{RAW[0]}'), [{_names}][2:]) "
            f"WHEN _source_file LIKE '%1996_04%' THEN ['{RAW[1]}', '{RAW[0]}'] || [{_names}][3:] ELSE [{_names}] END AS names, "
            f"[{_names}] AS expected FROM (SELECT DISTINCT _source_file FROM raw)"}
_outside = "array_to_string(list_filter({0}, lambda n: NOT list_contains({1}, n)), ',')"
add("check_header", f"SELECT file_name, {_outside.format('expected', 'names')} AS missing, {_outside.format('names', 'expected')} AS unexpected, "
    "CAST(1 AS BIGINT) AS violations FROM headers WHERE names <> expected "
    "UNION ALL SELECT 'all files', '', '', count(*) FILTER (WHERE names <> expected) FROM headers", _headers)


# --- stored states and SQL users -------------------------------------------------------

STATEMENTS["kpi_by_delivery"] = STATEMENTS["kpi_summary"]
_quarter_counts = ", ".join(f"count(DISTINCT {c}) AS {c}" for c in C.CARDINALITY_COLUMNS)
add("distinct_counts_by_quarter", "SELECT * FROM (SELECT coalesce(months, 'all') AS months, * EXCLUDE (months) FROM "
    f"(SELECT 'Q' || CAST((_source_month + 2) // 3 AS VARCHAR) AS months, {_quarter_counts} FROM faulty GROUP BY GROUPING SETS ((1), ()))) "
    f"UNPIVOT (distinct_non_null FOR \"column\" IN ({', '.join(C.CARDINALITY_COLUMNS)}))", FAULTY)
for _name in ("airline_ranking", "high_delay_routes", "departure_time_band"):
    STATEMENTS[f"sql_{_name}"] = STATEMENTS[_name]
