"""A data source that reads the SHA-256 of whole files: one partition a file, streamed in blocks.

A SHA-256 runs over a file from its first to its last byte, so a file is one task's work whatever its size; a task
holds one block. Local paths are opened by Python, any other store by the file system that pyarrow knows for its scheme.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Executors need pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "path string, file_name string, size_bytes long, sha256 string"
BLOCK = 4 << 20


class WholeFile(InputPartition):
    """One file, read by one task."""


def open_stream(path: str):
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return open(unquote(parts.path) if parts.scheme else path, "rb", buffering=0)
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_stream(inner)


def sha256_of(path: str, block: int = BLOCK) -> tuple[int, str]:
    """Bytes and hash of a file."""
    size, digest = 0, hashlib.sha256()
    with open_stream(path) as stream:
        while data := stream.read(block):
            digest.update(data)
            size += len(data)
    return size, digest.hexdigest()


class FileDigests(DataSource):
    """Options: `paths`, the files one behind the other with line breaks between, and `block`, bytes read at once."""

    @classmethod
    def name(cls) -> str:
        return "file_digests"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return DigestReader(self.options["paths"].split("\n"), int(self.options.get("block", BLOCK)))


class DigestReader(DataSourceReader):
    def __init__(self, paths: list[str], block: int):
        self.paths, self.block = [p for p in paths if p], block

    def partitions(self) -> list[InputPartition]:
        return [WholeFile(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path = partition.value
        size, digest = sha256_of(path, self.block)
        row = {"path": path, "file_name": unquote(path.rsplit("/", 1)[-1]), "size_bytes": size, "sha256": digest}
        yield pa.RecordBatch.from_pylist([row], pa.schema([("path", pa.string()), ("file_name", pa.string()), ("size_bytes", pa.int64()), ("sha256", pa.string())]))


def file_digests(spark: SparkSession, paths: str | list[str], block: int = BLOCK) -> DataFrame:
    """(path, file_name, size_bytes, sha256) of all files under `paths`, empty ones too. Spark lists them; the driver holds
    their names, as escaped URIs."""
    spark.dataSource.register(FileDigests)
    found = spark.read.format("binaryFile").load(paths).inputFiles()
    if not found:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.format("file_digests").option("paths", "\n".join(found)).option("block", str(block)).load()
