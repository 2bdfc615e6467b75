"""Iterators that run in tasks.

``from_iterator`` takes rows that the driver already has.  ``from_iterators``
takes a function instead and sends it to the tasks of a Python data source:
partition ``i`` of ``n`` is whatever ``make(i, n)`` iterates over, so the driver
never sees a row and the partitions run, and run again after a failure, apart.
``make`` has to give the same rows each time it is called for a partition.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from streamkit.session import ship_package
from streamkit.sources.collection import _value_type

#: Rows of an Arrow batch handed to Spark.
ROWS = 8_192


class IteratorReader(DataSourceReader):
    def __init__(self, make: Callable[[int, int], Iterator], n: int, schema: T.StructType, scalar: bool):
        self.make, self.n, self.schema, self.scalar = make, n, schema, scalar

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(self.n)]

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow as pa  # noqa: PLC0415
        from pyspark.sql.pandas.types import to_arrow_schema  # noqa: PLC0415

        arrow = to_arrow_schema(self.schema)
        rows = iter(self.make(partition.value, self.n))
        while block := list(itertools.islice(rows, ROWS)):
            columns = [block] if self.scalar else zip(*block, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


def from_iterators(spark: SparkSession, make: Callable[[int, int], Iterator], partitions: int, schema=None, element_type=None) -> DataFrame:
    """The rows of ``make(i, partitions)`` for each ``i`` below ``partitions``:
    tuples under ``schema``, or with ``element_type`` scalars in column ``value``."""
    ship_package(spark)
    scalar = element_type is not None
    kind = T.StructType([T.StructField("value", _value_type(element_type))]) if scalar else schema
    kind = T.StructType.fromDDL(kind) if isinstance(kind, str) else kind
    own = f"iterators_{uuid.uuid4().hex[:12]}"

    class IteratorSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return own

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return IteratorReader(make, partitions, kind, scalar)

    spark.dataSource.register(IteratorSource)
    return spark.read.format(own).schema(kind).load()
