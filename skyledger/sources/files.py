"""Raw monthly CSV files: reading, lineage, and identity against a manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger import contract as C
from skyledger.functions.measures import count_when
from skyledger.operators.compare import side_by_side
from skyledger.operators.checks import check_rows
from skyledger.sources import digests, tables

BYTE_ORDER_MARK = "\ufeff"


def source_period(file_name: Column) -> tuple[Column, Column]:
    """(year, month) from names like `..._2025_01.csv`; NULL when the name has another form."""
    def part(group: int) -> Column:
        return F.nullif(F.regexp_extract(file_name, C.SOURCE_FILE_PATTERN, group), F.lit("")).try_cast("int")

    return part(1), part(2)


def with_lineage(frame: DataFrame, file_name: Column | None = None) -> DataFrame:
    """Add the source file and its year and month. By default the file is the one Spark read the row from."""
    name = F.col("_metadata.file_name") if file_name is None else file_name
    year, month = source_period(name)
    return frame.select(
        *(c for c in frame.columns if c not in C.LINEAGE_COLUMNS),
        name.alias("_source_file"), year.alias("_source_year"), month.alias("_source_month"),
    )


def lineage_check(frame: DataFrame) -> DataFrame:
    """Records whose file name gave no period."""
    unknown = F.col("_source_year").isNull() | F.col("_source_month").isNull()
    return check_rows(frame, {"source_period_known": count_when(unknown)})


def read_raw_csv(spark: SparkSession, paths: str | list[str], file_name: Column | None = None) -> DataFrame:
    """All files in one scan, every field as text, malformed rows fail the job.

    `file_name` says how to derive the source file of a row when it is not the name of the file itself.

    Every column is parsed even when few are used, because a pruned parse can overlook a bad row. The
    reader compares header names without regard to case; `check_header` compares them exactly.
    """
    reader = (
        spark.read.schema(C.raw_schema())
        .option("header", True).option("enforceSchema", False)
        .option("mode", "FAILFAST").option("encoding", "UTF-8").option("columnPruning", False)
    )
    return with_lineage(reader.csv(paths), file_name)


CORRUPT = "_corrupt_record"


def read_with_quarantine(spark: SparkSession, paths: str | list[str], file_name: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The records that can be read, as `read_raw_csv` gives them, and a quarantine table of those that cannot: the text of
    each malformed row with its source file, year and month.

    A row is malformed if it has more or fewer fields than the header. Both tables read one staged parse, because a second,
    pruned parse could judge rows in another way.
    """
    schema = T.StructType([*C.raw_schema().fields, T.StructField(CORRUPT, T.StringType())])
    reader = (
        spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
    )
    parsed = tables.stage(with_lineage(reader.csv(paths), file_name), "parsed")
    good = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, parsed.where(F.col(CORRUPT).isNotNull()).select(*C.LINEAGE_COLUMNS, F.col(CORRUPT).alias("record"))


def malformed_rows(quarantine: DataFrame) -> DataFrame:
    """Number of malformed rows of each file that has any."""
    return quarantine.groupBy("_source_file").agg(F.count("*").alias("malformed_rows"))


def union_files(frames: list[DataFrame]) -> DataFrame:
    """Append frames by column name. For files, one multi-path `read_raw_csv` does the same in one scan."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def file_sizes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """File name and size from the listing alone; no content is read."""
    listing = spark.read.format("binaryFile").load(paths)
    return listing.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("size_bytes"))


def _file_name() -> Column:
    return F.element_at(F.split(F.input_file_name(), "/"), -1)


def file_headers(spark: SparkSession, paths: str | list[str], file_name: Column | None = None) -> DataFrame:
    """Name and header names of each file: its first line, however long, found by the place of the line in the file.

    The text source splits a file, and a partial minimum brings one line of each split to the shuffle."""
    lines = spark.read.text(paths).select(
        (_file_name() if file_name is None else file_name).alias("file_name"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), "value")
    first = lines.groupBy("file_name").agg(F.min_by("value", F.struct("block", "line")).alias("value"))
    names = F.split(F.regexp_replace("value", f"^{BYTE_ORDER_MARK}|\r$", ""), ",")
    return first.select("file_name", F.transform(names, lambda name: F.regexp_replace(name, '^"|"$', "")).alias("header"))


def file_contents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Name, number of lines and an order-free digest of the lines of each file, in one pass that splits large files.

    The digest adds up two hashes of every line: files with the same lines in another order have the same one."""
    lines = spark.read.text(paths).select(_file_name().alias("file_name"), "value")
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), "value").cast("decimal(38,0)")).cast("string")
    return lines.groupBy("file_name").agg(F.count("*").alias("lines"), F.concat_ws("/", total(1), total(2)).alias("digest"))


def file_facts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Name, size, SHA-256 and header names of each file of any size, files spread over the cluster."""
    hashed = digests.file_digests(spark, paths).select("file_name", "size_bytes", "sha256")
    return hashed.join(file_headers(spark, paths), "file_name", "left")


def header_problems(facts: DataFrame) -> DataFrame:
    """Per file: expected names that are missing, unexpected names, and whether names and order are exact."""
    expected = F.array(*map(F.lit, C.RAW_COLUMNS))
    return facts.select(
        "file_name",
        F.array_except(expected, "header").alias("missing_names"),
        F.array_except("header", expected).alias("unexpected_names"),
        F.coalesce(F.col("header") == expected, F.lit(False)).alias("header_matches"),  # an empty file has no header
    )


def check_header(facts: DataFrame) -> DataFrame:
    return check_rows(header_problems(facts), {"header_matches": count_when(~F.col("header_matches"))})


def check_manifest(facts: DataFrame, manifest: DataFrame) -> DataFrame:
    """The file set equals the manifest, and so do sizes and hashes; a manifest hash is 64 hex digits."""
    sides = side_by_side({
        "file": facts.select("file_name", "size_bytes", F.lower("sha256").alias("sha256")),
        "manifest": manifest.select("file_name", "size_bytes", F.lower("sha256").alias("sha256")),
    }, ["file_name"])
    both = (F.col("file__rows") > 0) & (F.col("manifest__rows") > 0)

    def differs(name: str) -> Column:
        return count_when(both & ~F.col(f"file__{name}").eqNullSafe(F.col(f"manifest__{name}")))

    listed = F.col("manifest__rows") > 0
    well_formed = F.coalesce(F.col("manifest__sha256").rlike(C.SHA256_PATTERN), F.lit(False))
    return check_rows(sides, {
        "no_missing_file": count_when(F.col("file__rows") == 0),
        "no_unexpected_file": count_when(F.col("manifest__rows") == 0),
        "no_repeated_file": count_when((F.col("file__rows") > 1) | (F.col("manifest__rows") > 1)),
        "manifest_hash_well_formed": count_when(listed & ~well_formed),
        "sizes_match": differs("size_bytes"),
        "hashes_match": differs("sha256"),
    })
