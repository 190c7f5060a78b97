"""Digests of files of any size as a Spark data source: every task streams its files through the hash, chunk by chunk."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .npz import TASK_BYTES, listed, store_of

NAME = "file_digest"
CHUNK = 4 << 20
OPENING = 256 << 10  # opening a file takes about as long as reading so much
BATCH = 1024  # files
SCHEMA = "path string, size bigint, sha string"


@dataclass
class FileGroup(InputPartition):
    """Files of one task: many small ones, or one large one."""

    paths: list[tuple[str, int]]

    def __post_init__(self):
        super().__init__(tuple(self.paths))


def sha256_of(path: str, chunk: int = CHUNK) -> str:
    store, inside = store_of(path)
    digest, buffer = hashlib.sha256(), bytearray(chunk)
    with store.open_input_file(inside) as f:
        while n := f.readinto(buffer):
            digest.update(memoryview(buffer)[:n])
    return digest.hexdigest()


class DigestReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.task_bytes = options["path"], int(options.get("task_bytes", TASK_BYTES))

    def partitions(self) -> list[FileGroup]:
        groups: list[list] = []
        room = 0
        for path, size in listed(self.path, ""):
            if not groups or room < size:
                groups.append([])
                room = self.task_bytes
            groups[-1].append((path, size))
            room -= size + OPENING
        return [FileGroup(g) for g in groups]

    def read(self, partition: FileGroup) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(partition.paths), BATCH):
            paths, sizes = zip(*partition.paths[i:i + BATCH], strict=True)
            yield pa.RecordBatch.from_pydict({"path": paths, "size": sizes, "sha": [sha256_of(p) for p in paths]})


class DigestSource(DataSource):
    """``spark.read.format("file_digest").load(folder, file or pattern)`` gives path, size and SHA-256 of every file."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DigestReader:
        return DigestReader(dict(self.options))


def read(spark: SparkSession, pattern: str) -> DataFrame:
    spark.dataSource.register(DigestSource)
    return spark.read.format(NAME).load(pattern)
