"""Raw records to accepted and rejected tables, with checks before and after reading back, then published in one step."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import contract as C
from skyledger.functions.measures import any_of, count_when, in_period
from skyledger.operators import ledger as L
from skyledger.operators.checks import all_checks, assert_checks, check_rows, schema_check, values_check
from skyledger.operators.cleaning import classify_arrival_records, clean_flights, split_arrival_records
from skyledger.operators.compare import same_values
from skyledger.operators.diagnostics import approved_reject_match
from skyledger.sources import tables
from skyledger.operators.shape import stacked

LEVELS = {"partition": L.PARTITION_KEYS, "month": ["year", "month"], "status": ["flight_status"], "total": []}


@dataclass(frozen=True)
class Evidence:
    """What the cleaned table is held against.

    baseline: month rows of an earlier profile (total, completed, cancelled, diverted, invalid);
    approved: the reviewed rejects as raw rows with lineage;
    reference: cleaned rows of the reference window, kept from an earlier run.
    """

    baseline: DataFrame
    approved: DataFrame
    reference: DataFrame
    window: C.Period


@dataclass(frozen=True)
class Ledgers:
    """Rows by file, month and status of the raw, cleaned and rejected tables, with the counters of the checks."""

    raw: DataFrame
    clean: DataFrame
    reject: DataFrame


def scanned_ledgers(raw: DataFrame, cleaned: DataFrame, rejected: DataFrame) -> Ledgers:
    """The ledgers of tables that exist; a write that is counted (`ledger.Watch`) needs no such scan."""
    return Ledgers(L.raw_ledger(raw), L.cleaned_ledger(cleaned), L.raw_partition_counts(rejected))


def _levels(sides: dict[str, DataFrame]) -> DataFrame:
    """All ledgers stacked, summed by partition, month, status and in total, with a level label."""
    parts = None
    for name, frame in sides.items():
        counters = [c for c in frame.columns if c not in L.PARTITION_KEYS]
        part = frame.select(*L.PARTITION_KEYS, *(F.col(c).alias(f"{name}__{c}") for c in counters))
        parts = part if parts is None else parts.unionByName(part, allowMissingColumns=True)
    counters = [c for c in parts.columns if c not in L.PARTITION_KEYS]
    level = (
        F.when(F.grouping("_source_file") == 0, "partition")
        .when(F.grouping("month") == 0, "month")
        .when(F.grouping("flight_status") == 0, "status")
        .otherwise("total")
    )
    grouped = parts.groupingSets([[F.col(k) for k in keys] for keys in LEVELS.values()], *L.PARTITION_KEYS)
    return grouped.agg(level.alias("level"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counters))


def _baseline_ledger(baseline: DataFrame) -> DataFrame:
    """A month x status baseline in ledger form, without files."""
    rows = ((F.lit(None).cast("string"), s, F.col(f"{s}_flights")) for s in C.STATUSES_WITH_INVALID)
    long = stacked(baseline, ["YEAR", "MONTH"], rows, ["_source_file", "flight_status", "n"])
    return long.withColumnsRenamed({"YEAR": "year", "MONTH": "month"}).filter(F.col("n") != 0)


def _at(level: str, condition: Column) -> Column:
    """Number of groups of a level where the condition holds."""
    return count_when((F.col("level") == level) & condition)


def _total(value: Column) -> Column:
    return F.sum(F.when(F.col("level") == "total", value))


def _for_status(status: str, value: Column) -> Column:
    return F.sum(F.when((F.col("level") == "status") & (F.col("flight_status") == status), value))


def _differ(names: list[tuple[str, str]]) -> Column:
    return any_of(F.col(a) != F.col(b) for a, b in names)


def pre_write_checks(ledgers: Ledgers, cleaned: DataFrame, rejected: DataFrame, evidence: Evidence) -> DataFrame:
    """24 checks over the ledgers and two value comparisons.

    The cleaned schema counts as one check and the cast, flag and clock issues of all raw records as one.
    """
    levels = _levels({
        "raw": ledgers.raw,
        "clean": ledgers.clean,
        "reject": ledgers.reject,
        "base": _baseline_ledger(evidence.baseline),
    })
    n_raw, n_clean, n_reject, n_base = (F.col(f"{s}__n") for s in ("raw", "clean", "reject", "base"))
    kept_and_lost = n_raw != n_clean + n_reject
    off_baseline = n_raw != n_base
    in_window = in_period(evidence.window, "year", "month")
    known_status = F.coalesce(F.col("flight_status").isin(*C.STATUSES_WITH_INVALID), F.lit(False))
    issues = F.col("raw__introduced_nulls") + F.col("raw__invalid_binary") + F.col("raw__invalid_hhmm")
    ledger_checks = check_rows(levels, {
        "raw_dataset_is_not_empty": F.when(F.coalesce(_total(n_raw), F.lit(0)) == 0, 1).otherwise(0),
        "raw_count_equals_cleaned_plus_rejected": _total(F.abs(n_raw - n_clean - n_reject)),
        "month_counts_reconcile": _at("month", kept_and_lost),
        "status_counts_reconcile": _at("status", kept_and_lost),
        "file_month_status_conservation": _at("partition", kept_and_lost),
        "status_reconciles_to_cleaned_count": F.sum(F.when((F.col("level") == "status") & ~known_status, n_clean)),
        "no_invalid_flight_status": _for_status("invalid", n_clean),
        "no_invalid_raw_status": _for_status("invalid", n_raw),
        "no_unexpected_cast_or_hhmm_issues": _total(issues),
        "output_binary_domains_are_valid": _total(F.col("clean__invalid_binary")),
        "output_hhmm_values_are_valid_strings": _total(F.col("clean__invalid_hhmm")),
        "source_file_lineage_is_present": _total(F.col("clean__source_file_nulls")),
        "arr_del15_row_level_rules": _total(F.col("clean__label_violations")),
        "raw_count_matches_baseline": _total(F.abs(n_raw - n_base)),
        "raw_months_match_baseline": _at("month", off_baseline),
        "raw_status_matches_baseline": _at("status", off_baseline),
        "rejected_only_completed": F.sum(F.when(
            (F.col("level") == "status") & ~F.col("flight_status").eqNullSafe(F.lit("completed")), n_reject)),
        "missing_essential_count_matches_rejected": _total(F.abs(F.col("raw__missing_essential") - n_reject)),
        "cleaned_has_essential_arrival": _total(F.col("clean__completed_missing_essential_arrival")),
        "reference_window_has_no_rejects": F.sum(F.when((F.col("level") == "month") & in_window, n_reject)),
    })
    return all_checks([
        ledger_checks,
        schema_check(cleaned, C.cleaned_schema(), "cleaned_schema_matches_contract"),
        schema_check(rejected, C.rejected_schema(), "rejected_schema_contract"),
        values_check("rejected_matches_approved", approved_reject_match(rejected, evidence.approved)),
        values_check("reference_window_values_unchanged",
                     same_values(cleaned.filter(in_period(evidence.window)), evidence.reference)),
    ])


def read_back_checks(ledgers: Ledgers, rejected: DataFrame, cleaned_back: DataFrame, rejected_back: DataFrame,
                     evidence: Evidence) -> DataFrame:
    """17 checks of the tables read back from storage against the ledgers recorded before or while they were written."""
    levels = _levels({
        "raw": ledgers.raw,
        "clean": ledgers.clean,
        "reject": ledgers.reject,
        "back": L.cleaned_ledger(cleaned_back),
        "reject_back": L.raw_partition_counts(rejected_back),
    })
    n = {s: F.col(f"{s}__n") for s in ("raw", "clean", "reject", "back", "reject_back")}
    missing = [(f"clean__{m}", f"back__{m}") for m in L.MISSINGNESS]
    known_status = F.coalesce(F.col("flight_status").isin(*C.STATUSES_WITH_INVALID), F.lit(False))
    ledger_checks = check_rows(levels, {
        "read_back_missingness_unchanged": _at("month", _differ(missing)),
        "read_back_essential_arrival_present": _total(F.col("back__completed_missing_essential_arrival")),
        "read_back_rejected_counts": _at("partition", n["reject"] != n["reject_back"]),
        "read_back_partition_counts_unchanged":
            _at("partition", (n["clean"] != n["back"]) | (n["reject"] != n["reject_back"])),
        "read_back_raw_equals_accepted_plus_rejected":
            _at("partition", n["raw"] != n["back"] + n["reject_back"]),
        "read_back_count_matches_pre_write": _total(F.abs(n["clean"] - n["back"])),
        "read_back_months_match_pre_write": _at("month", n["clean"] != n["back"]),
        "read_back_status_matches_pre_write": _at("status", n["clean"] != n["back"]),
        "read_back_status_reconciles": F.sum(F.when((F.col("level") == "status") & ~known_status, n["back"])),
        "read_back_arr_del15_rules": _total(F.col("back__label_violations")),
        "read_back_binary_domains_are_valid": _total(F.col("back__invalid_binary")),
        "read_back_hhmm_values_are_valid_strings": _total(F.col("back__invalid_hhmm")),
        "read_back_lineage_present": _total(F.col("back__source_file_nulls")),
    })
    return all_checks([
        ledger_checks,
        schema_check(cleaned_back, C.cleaned_schema(), "read_back_schema_matches_contract"),
        schema_check(rejected_back, C.rejected_schema(), "read_back_rejected_schema"),
        values_check("read_back_rejected_all_values", same_values(rejected, rejected_back)),
        values_check("read_back_reference_values_unchanged",
                     same_values(cleaned_back.filter(in_period(evidence.window)), evidence.reference)),
    ])


def run(raw: DataFrame, evidence: Evidence, accepted_path: str, rejected_path: str, replace: bool = False) -> tuple[DataFrame, DataFrame]:
    """Stage, classify, write beside the targets, check, read back, check again, publish. Returns both check tables.

    The raw records are staged once as Parquet, because text parsing is the expensive part. The casts run once, into the
    tables that are published in the end. All three writes count their rows, so the checks before publishing scan
    nothing but the reference window and the rejects. What is published takes its name by a rename: whatever fails, a table
    that is there already stays as it was. `replace` allows such a table to be replaced.
    """
    spark: SparkSession = raw.sparkSession

    def small(checks: DataFrame) -> DataFrame:
        """A few check rows, independent of what is staged."""
        return spark.createDataFrame(checks.collect(), checks.schema)

    accepted_new, rejected_new = tables.beside(accepted_path), tables.beside(rejected_path)
    with tables.temporary(spark):
        try:
            staged, raw_seen = tables.staged_and_counted(raw, "raw", L.raw_watch().metrics())
            accepted_raw, rejected_raw = split_arrival_records(classify_arrival_records(staged))
            clean_counts, reject_counts = (tables.Observed(w.metrics()) for w in (L.cleaned_watch(), L.rejected_watch()))
            tables.write_rejected(rejected_raw, rejected_new, reject_counts)
            tables.write_partitioned(clean_flights(accepted_raw), accepted_new, clean_counts)
            cleaned, rejected = tables.read_cleaned(spark, accepted_new), spark.read.schema(rejected_raw.schema).parquet(rejected_new)
            try:
                ledgers = Ledgers(L.raw_ledger_of(spark, raw_seen), L.cleaned_ledger_of(spark, clean_counts.seen), L.rejected_ledger_of(spark, reject_counts.seen))
            except L.TooManyKeys:
                ledgers = scanned_ledgers(staged, clean_flights(accepted_raw), rejected_raw)
            before = small(pre_write_checks(ledgers, cleaned, rejected, evidence))
            assert_checks(before, "before publishing")
            after = small(read_back_checks(ledgers, rejected_raw, cleaned, rejected, evidence))
            assert_checks(after, "after reading back")
            if not replace:
                taken = [p for p in (accepted_path, rejected_path) if tables.exists(spark, p)]
                if taken:
                    raise FileExistsError(", ".join(taken))
            tables.publish(spark, rejected_new, rejected_path, replace)
            tables.publish(spark, accepted_new, accepted_path, replace)
        finally:
            for path in (accepted_new, rejected_new):
                tables.discard(spark, path)
    return before, after
