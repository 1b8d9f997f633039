"""A source whose tasks each make their own rows: task i of n gives the numbers v with v % n == i."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BATCH = 65_536


class _Share(InputPartition):
    def __init__(self, index: int):
        super().__init__(index)


class _ModuloReader(DataSourceReader):
    def __init__(self, upper: int, shares: int):
        self.upper, self.shares = upper, shares

    def partitions(self) -> list[InputPartition]:
        return [_Share(i) for i in range(self.shares)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        step = BATCH * self.shares
        for low in range(partition.value, self.upper, step):
            v = np.arange(low, min(low + step, self.upper), self.shares, dtype=np.int64)
            share = np.full(len(v), partition.value, dtype=np.int32)
            yield pa.record_batch([pa.array(v), pa.array(share)], names=["v", "subtask"])


class ModuloSource(DataSource):
    """Options ``upper`` (exclusive, default 10) and ``shares`` (default 3)."""

    @classmethod
    def name(cls) -> str:
        return "modulo"

    def schema(self) -> str:
        return "v bigint, subtask int"

    def reader(self, schema) -> DataSourceReader:
        return _ModuloReader(int(self.options.get("upper", 10)), int(self.options.get("shares", 3)))


def modulo(spark: SparkSession, upper: int = 10, shares: int = 3):
    spark.dataSource.register(ModuloSource)
    return spark.read.format("modulo").option("upper", upper).option("shares", shares).load()
