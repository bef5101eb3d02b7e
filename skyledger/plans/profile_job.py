"""Profile of the raw records as a set of small tables."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from skyledger import contract as C
from skyledger.operators import duplicates, profiling, rules
from skyledger.operators.checks import assert_checks
from skyledger.sources import tables


def build(raw: DataFrame, period: C.Period, files: DataFrame) -> dict[str, DataFrame]:
    """All profile tables. `raw` is read once per table, so hand in a staged frame for text files.

    What several tables share is small and computed once: one row per file, and the colliding keys.
    """
    by_file = profiling.file_profile(raw).persist(StorageLevel.MEMORY_AND_DISK)
    overall = profiling.overall_profile(by_file)
    keys = tables.stage(duplicates.key_groups(raw), "key-groups")
    return {
        "file_profile": by_file,
        "missing_by_file": profiling.missing_values(by_file),
        "missing_overall": profiling.missing_values(overall),
        "status_by_file": profiling.status_profile(by_file),
        "status_overall": profiling.status_profile(overall),
        "cast_failures": profiling.cast_failures(raw),
        "numeric_ranges": profiling.numeric_ranges(raw),
        "exact_duplicates": duplicates.exact_duplicates(raw),
        "key_collisions": duplicates.key_collisions(keys),
        "collision_samples": duplicates.collision_samples(keys),
        "distinct_counts": profiling.distinct_counts(raw),
        "value_counts": profiling.value_counts(raw),
        "anomaly_counts": rules.anomaly_counts(raw, period),
        "coverage_checks": profiling.coverage_checks(by_file, period, files),
    }


def run(raw: DataFrame, period: C.Period, files: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Stage the records, write every profile table below `folder`, then fail if the coverage checks do."""
    spark = raw.sparkSession
    with tables.temporary(spark):
        report = build(tables.stage(raw, "raw"), period, files)
        try:
            for name, frame in report.items():
                tables.write_plain(frame, f"{folder}/{name}")
        finally:
            report["file_profile"].unpersist()
    written = {name: spark.read.parquet(f"{folder}/{name}") for name in report}
    assert_checks(written["coverage_checks"], "profile coverage")
    return written
