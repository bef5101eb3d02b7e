"""DuckDB CTEs: the flight-shaped view and the tables most statements start from."""

from __future__ import annotations

from skyledger import contract as C
from skyledger.sources import flight_view as V


def _columns(expressions: dict[str, str]) -> str:
    return ", ".join(f'{e} AS {name}' for name, e in expressions.items())


def _select(expressions: dict[str, str], source: str, keep: str = "") -> str:
    return f"SELECT {keep}{_columns(expressions)} FROM {source}"


def trim_null(column: str) -> str:
    return f"nullif(trim({column}), '')"


def dbl(column: str) -> str:
    return f"try_cast({column} AS DOUBLE)"


def integer(column: str) -> str:
    return f"try_cast(regexp_replace({column}, '^\\s*([+-]?)([0-9]*)\\.[0-9]*\\s*$', '\\10\\2') AS INTEGER)"


def flag(column: str) -> str:
    return (f"CASE WHEN {dbl(trim_null(column))} = 0 THEN 0 WHEN {dbl(trim_null(column))} = 1 THEN 1 END")


def stamp(column: str) -> str:
    return f"try_strptime({column}, '%m/%d/%Y %I:%M:%S %p')"


def typed(column: str) -> str:
    if column in C.FLAG_COLUMNS:
        return f"CAST({flag(column)} AS INTEGER)"
    if column in C.INT_COLUMNS:
        return integer(trim_null(column))
    if column in C.MEASURE_COLUMNS:
        return dbl(trim_null(column))
    return f"CAST({stamp(trim_null(column))} AS DATE)" if column == "FL_DATE" else trim_null(column)


def missing(column: str) -> str:
    return f"({column} IS NULL OR trim({column}) = '')"


def present(column: str) -> str:
    return f"({column} IS NOT NULL AND trim({column}) <> '')"


CLOCK = "regexp_full_match({0}, '([01][0-9]|2[0-3])[0-5][0-9]|2400')"
CLOCK_23 = "regexp_full_match({0}, '([01][0-9]|2[0-3])[0-5][0-9]')"

STATUS = """CASE WHEN {c} = 0 AND {d} = 0 THEN 'completed' WHEN {c} = 1 AND {d} = 0 THEN 'cancelled'
    WHEN {c} = 0 AND {d} = 1 THEN 'diverted' ELSE 'invalid' END"""
RAW_STATUS = STATUS.format(c=dbl(trim_null("CANCELLED")), d=dbl(trim_null("DIVERTED")))

_record = ", ".join(C.RAW_COLUMNS + C.LINEAGE_COLUMNS)
_faulted = ", ".join(f"{V.FAULTS[c]} AS {c}" if c in V.FAULTS else c for c in C.RAW_COLUMNS + C.LINEAGE_COLUMNS)
_retailed = ", ".join("'NDUP' AS TAIL_NUM" if c == "TAIL_NUM" else c for c in C.RAW_COLUMNS + C.LINEAGE_COLUMNS)

BASE = {
    "joined": _select(V.JOINED, "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey "
                                "JOIN customer ON o_custkey = c_custkey"),
    "derived": _select(V.DERIVED, "joined", "*, "),
    "flagged": _select(V.FLAGS, "derived", "*, "),
    "numbered": _select(V.RECORD, "flagged", "h AS _h, "),
    "raw": f"SELECT {_record} FROM numbered",
}
FAULTY = {
    "faulted": f"SELECT {_faulted}, _h FROM numbered",
    "faulty": f"SELECT {_record} FROM faulted UNION ALL SELECT {_record} FROM faulted WHERE {V.COPIED} "
              f"UNION ALL SELECT {_retailed} FROM faulted WHERE {V.RETAILED}",
}


def cleaned_from(source: str) -> str:
    inner = ", ".join(f"{typed(c)} AS {c}" for c in C.RAW_COLUMNS)
    return (f"SELECT *, {STATUS.format(c='CANCELLED', d='DIVERTED')} AS flight_status "
            f"FROM (SELECT {inner}, {trim_null('_source_file')} AS _source_file FROM {source})")


def rejects(source: str) -> str:
    completed = f"({flag('CANCELLED')}) = 0 AND ({flag('DIVERTED')}) = 0"
    blank = " OR ".join(f"{trim_null(c)} IS NULL" for c in C.ESSENTIAL_ARRIVAL)
    return f"SELECT *, coalesce({completed}, FALSE) AND ({blank}) AS is_rejected FROM {source}"


CLEAN = {
    "judged": rejects("raw"),
    "cleaned": cleaned_from("(SELECT * FROM judged WHERE NOT is_rejected)"),
}
CLEAN_FAULTY = {
    "judged_faulty": rejects("faulty"),
    "cleaned_faulty": cleaned_from("(SELECT * FROM judged_faulty WHERE NOT is_rejected)"),
}

KPI_COLUMNS = """
    count(*) AS total_flights,
    count(*) FILTER (flight_status = 'completed') AS completed_flights,
    count(*) FILTER (flight_status = 'cancelled') AS cancelled_flights,
    count(*) FILTER (flight_status = 'diverted') AS diverted_flights,
    count(*) FILTER (flight_status = 'completed' AND ARR_DEL15 = 1) AS delayed_arrival_flights,
    count(*) FILTER (flight_status = 'completed' AND ARR_DEL15 = 0) AS on_time_arrival_flights,
    count(ARR_DELAY) FILTER (flight_status = 'completed') AS arrival_delay_observed_flights,
    sum(ARR_DELAY) FILTER (flight_status = 'completed') AS arrival_delay_minutes_sum"""


def rate(numerator: str, denominator: str) -> str:
    return f"CAST({numerator} AS DOUBLE) / nullif({denominator}, 0)"


def grain_table(keys: list[str], source: str = "cleaned") -> str:
    k = ", ".join(keys)
    rates = ", ".join(f"{rate(n, d)} AS {name}" for name, (n, d) in C.RATIO_PARTS.items())
    return f"SELECT *, {rates} FROM (SELECT {k}, {KPI_COLUMNS} FROM {source} GROUP BY {k})"


GRAIN_TABLES = {name: grain_table(keys) for name, keys in C.GRAINS.items()}


def statement(body: str, *groups: dict[str, str]) -> str:
    """One statement: the needed CTEs, then the body."""
    ctes: dict[str, str] = dict(BASE)
    for group in groups:
        ctes.update(group)
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items()) + "\n" + body
