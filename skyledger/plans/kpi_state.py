"""KPI tables by month delivery: additive partial measures are stored by month, and only months that changed are computed anew.

The state holds one row per month, carrier, origin and destination (`kpi.finest_grain`) under the same month folders as the
cleaned table, and the versions of the months it was made from. Versions are written last: a refresh that breaks off leaves
the old ones, so the next refresh takes the same months again. One refresh runs at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyledger import contract as C
from skyledger.operators import kpi
from skyledger.sources import month_folders as M
from skyledger.sources import tables


def _measures(state: str) -> str:
    return f"{state}/measures"


def _versions(state: str) -> str:
    return f"{state}/versions"


def changed_flights(spark: SparkSession, cleaned_path: str, months: list[tuple]) -> DataFrame:
    """The flights of some months; the scan opens only their folders."""
    return tables.read_cleaned(spark, cleaned_path).where(M.in_months(months))


def refresh(spark: SparkSession, cleaned_path: str, state: str) -> tuple[list[tuple], list[tuple]]:
    """Bring the state up to the cleaned table. Returns the months that were computed and those that were removed."""
    now = tables.stage(M.versions(spark, cleaned_path), "versions")  # the listing the refresh goes by
    changed, gone = M.changes(now, M.known_versions(spark, _versions(state)))
    if changed:
        tables.replace_months(kpi.finest_grain(changed_flights(spark, cleaned_path, changed)), _measures(state))
    for month in gone:
        tables.discard(spark, M.folder(_measures(state), month))
    if changed or gone:
        written = tables.beside(_versions(state))
        tables.write_plain(now, written)
        tables.publish(spark, written, _versions(state), replace=True)
    return changed, gone


def partial_measures(spark: SparkSession, state: str) -> DataFrame:
    stored = C.aggregate_schema(kpi.DIMENSIONS)
    names = [*kpi.DIMENSIONS, *C.COUNT_MEASURES, "arrival_delay_minutes_sum"]
    schema = type(stored)([stored[n] for n in names])
    return spark.read.schema(schema).parquet(_measures(state)).select(*names)


def summary(spark: SparkSession, state: str) -> DataFrame:
    """All four grains from the stored measures; no flight is read."""
    return kpi.summary_of_finest(partial_measures(spark, state))


def grain(spark: SparkSession, state: str, level: str) -> DataFrame:
    keys = C.GRAINS[level]
    summed = partial_measures(spark, state).groupBy(*keys).agg(*kpi.rolled_up_measures())
    return kpi.with_ratios(summed).select(*keys, *C.KPI_MEASURES)
