"""Tables at rest: partitioned Parquet, rejected records, aggregates and CSV summaries.

Writers refuse an existing path. `rebalance` lets adaptive execution size the output: it splits a month
that holds a third of all rows over many tasks and merges small months, where a plain repartition by
month would put each month into one task.
"""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger import contract as C

NULL_TEXT = "NULL"


#: Bytes of a method above which the JVM interprets it instead of compiling it.
HUGE_METHOD = "8000"


def compile_wide_rows(spark: SparkSession) -> None:
    """Let the session split generated code that the JVM would only interpret, unless it names a limit of its own.

    Records are 38 columns wide: with Spark's default limit one method builds a whole record and is never compiled.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(limit) == "65535":
        spark.conf.set(limit, HUGE_METHOD)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    Only a local session without the setting, as in tests, gets a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="skyledger-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staging_path(spark: SparkSession, name: str) -> str:
    """A scratch path that goes with the innermost `temporary`, if there is one."""
    path = scratch_path(spark, name)
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write inside go when it ends. Otherwise they stay until the driver happens to collect its
    garbage, on top of those of all later steps."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back: later passes scan pruned columns instead
    of repeating the work, and a lost executor costs nothing."""
    path = staging_path(frame.sparkSession, name)
    frame.write.mode("errorifexists").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


class Observed:
    """Counts taken of the rows that a write brings to their files.

    The counts are taken in the tasks that write, behind any shuffle: a result task counts once however often it runs,
    while map tasks that are run again after a lost executor would count twice.
    """

    def __init__(self, metrics: dict[str, Column]):
        self._metrics, self._seen = metrics, Observation()

    def of(self, frame: DataFrame) -> DataFrame:
        return frame.observe(self._seen, *(c.alias(name) for name, c in self._metrics.items()))

    @property
    def seen(self) -> dict:
        """The counts; waits for the write."""
        return self._seen.get


def staged_and_counted(frame: DataFrame, name: str, metrics: dict[str, Column]) -> tuple[DataFrame, dict]:
    """`stage`, with metrics of the rows from the write itself."""
    counts = Observed(metrics)
    staged = stage(counts.of(frame), name)
    return staged, counts.seen


_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is removed at the end, also after a failure. Write or collect the results inside."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a staged table with the file system its path belongs to, wherever that is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_STAGED: dict[tuple, tuple[str, T.StructType, dict]] = {}


def is_staged(spark: SparkSession, key: tuple) -> bool:
    """Whether `stage_once` has written this frame in this application."""
    return (spark.sparkContext.applicationId, *key) in _STAGED


def stage_once(spark: SparkSession, key: tuple, build: Callable[[], DataFrame], metrics: dict[str, Column] | None = None) -> tuple[DataFrame, dict]:
    """The staged form of a frame many queries start from, written at its first use in this application, and what `metrics`
    counted in that write.

    `key` must name everything the frame depends on. A staged table that has been cleared is written anew.
    """
    key = (spark.sparkContext.applicationId, *key)
    for _ in range(2):
        if key not in _STAGED:
            frame, path = build(), scratch_path(spark, "staged")
            counts = Observed(metrics) if metrics else None
            (counts.of(frame) if counts else frame).write.mode("errorifexists").parquet(path)
            _STAGED[key] = path, frame.schema, counts.seen if counts else {}
        path, schema, seen = _STAGED[key]
        try:
            return spark.read.schema(schema).parquet(path), seen
        except AnalysisException:
            del _STAGED[key]
    raise FileNotFoundError(f"staged table {key} cannot be read back")


def inputs_version(spark: SparkSession, paths: list[str]) -> tuple:
    """Number, size and age of input files, from the listing alone."""
    listing = spark.read.format("binaryFile").load(paths)
    return tuple(listing.agg(F.count("*"), F.sum("length"), F.max("modificationTime").cast("string")).first())


def write_partitioned(cleaned: DataFrame, path: str, counts: Observed | None = None) -> None:
    """Accepted records as Snappy Parquet under YEAR= / MONTH= folders, counted on their way into the files if asked for."""
    dealt = cleaned.hint("rebalance", "YEAR", "MONTH")
    (
        (counts.of(dealt) if counts else dealt)
        .write.mode("errorifexists").option("compression", "snappy").partitionBy("YEAR", "MONTH").parquet(path)
    )


def replace_months(cleaned: DataFrame, path: str) -> None:
    """The months that `cleaned` holds take the place of the same months of a published table; other months stay. The new
    files are written beside and moved in when all are complete."""
    (
        cleaned.hint("rebalance", "YEAR", "MONTH")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy("YEAR", "MONTH").parquet(path)
    )


def beside(target: str) -> str:
    """A new path in the target's own folder, so that a rename brings it there; readers of the folder pass over it."""
    folder, _, name = target.rstrip("/").rpartition("/")
    return f"{folder}/_{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (old, new))
    if not old.getFileSystem(spark._jsc.hadoopConfiguration()).rename(old, new):
        raise OSError(f"{old} cannot be moved to {new}")


def publish(spark: SparkSession, written: str, target: str, replace: bool = False) -> None:
    """Give a table that was written beside its target, and checked there, the target's name. An earlier table is moved
    aside first, only if `replace` says so, comes back if the rename fails, and is removed at the end."""
    if not exists(spark, target):
        _rename(spark, written, target)
        return
    if not replace:
        raise FileExistsError(target)
    old = beside(target)
    _rename(spark, target, old)
    try:
        _rename(spark, written, target)
    except Exception:
        _rename(spark, old, target)
        raise
    discard(spark, old)


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    """The cleaned table with its columns in contract order; filters on YEAR and MONTH prune folders."""
    return spark.read.schema(C.cleaned_schema()).parquet(path).select(*C.cleaned_schema().names)


def read_summary_input(spark: SparkSession, path: str) -> DataFrame:
    """Only the columns the weekday, band and cause summaries use."""
    return read_cleaned(spark, path).select(*C.SUMMARY_INPUT_COLUMNS)


def write_plain(frame: DataFrame, path: str, counts: Observed | None = None) -> None:
    """Rejected records or an aggregate: Snappy Parquet, one file when small, as many as needed when not."""
    dealt = frame.hint("rebalance")
    (counts.of(dealt) if counts else dealt).write.mode("errorifexists").option("compression", "snappy").parquet(path)


write_rejected = write_plain
write_aggregate = write_plain


def write_summary_csv(summary: DataFrame, path: str, order: Callable[[DataFrame], DataFrame] = lambda frame: frame) -> None:
    """A weekday, band or cause table as one CSV file with its rows in `order`. It has a few rows per month, and unlike
    coalesce(1) the repartition leaves the aggregation before it parallel; one partition is sorted without a shuffle."""
    (
        order(summary.repartition(1))
        .write.mode("errorifexists").option("header", True).option("nullValue", NULL_TEXT).csv(path)
    )


def read_summary_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV holds no types, so it is read with the schema of the query that wrote it."""
    return (
        spark.read.schema(schema)
        .option("header", True).option("enforceSchema", False)
        .option("mode", "FAILFAST").option("nullValue", NULL_TEXT).csv(path)
    )


def from_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A typed frame of literal rows, such as a reviewed reject list."""
    return spark.createDataFrame(rows, schema)


def roundtrip_parquet(frame: DataFrame, path: str, partition_columns: list[str]) -> DataFrame:
    """Write by partition and read back without a schema, in the column order of the frame."""
    frame.hint("rebalance", *partition_columns).write.mode("errorifexists").partitionBy(*partition_columns).parquet(path)
    # Partition values come back last and with an inferred type, so the caller can check both.
    return frame.sparkSession.read.parquet(path).select(*frame.columns)


def csv_header(spark: SparkSession, path: str) -> DataFrame:
    """The header line of a CSV summary as one row: its names in order."""
    line = spark.read.text(path).select(F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("at"), "value")
    return line.agg(F.split(F.min_by("value", "at"), ",").alias("names"))
