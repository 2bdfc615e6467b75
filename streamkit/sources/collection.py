"""Inline typed rows and number sequences."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_PY_TYPES = {
    str: T.StringType(),
    int: T.LongType(),
    float: T.DoubleType(),
    bool: T.BooleanType(),
}


def _value_type(element_type) -> T.DataType:
    if isinstance(element_type, T.DataType):
        return element_type
    try:
        return _PY_TYPES[element_type]
    except KeyError:
        raise TypeError(f"unsupported element type {element_type!r}") from None


def from_collection(spark: SparkSession, rows: Iterable, schema=None, element_type=None) -> DataFrame:
    """A bounded DataFrame from driver-side rows.

    ``rows`` of scalars need ``element_type`` (column ``value``); rows of
    tuples/dicts need ``schema``.  Meant for small inline inputs: the rows
    travel through the driver once, then Spark distributes them.
    """
    rows = list(rows)
    scalar = bool(rows) and not isinstance(rows[0], (tuple, list, dict)) and not hasattr(rows[0], "asDict")
    if schema is not None and scalar:
        rows = [(r,) for r in rows]
    if schema is None:
        vtype = _value_type(element_type if element_type is not None else type(rows[0]) if rows else str)
        schema = T.StructType([T.StructField("value", vtype, True)])
        rows = [(r,) for r in rows]
    return spark.createDataFrame(rows, schema)


def from_iterator(spark: SparkSession, iterator: Iterator, element_type) -> DataFrame:
    """The iterator form: element type given explicitly, as the element class is."""
    return from_collection(spark, iterator, element_type=element_type)


def from_elements(spark: SparkSession, element_type, *values) -> DataFrame:
    """Varargs form: all values share ``element_type``."""
    return from_collection(spark, values, element_type=element_type)


def generate_sequence(spark: SparkSession, start: int, end: int, num_partitions: int | None = None) -> DataFrame:
    """Numbers ``start..end`` with **both ends inclusive**, column ``value`` (bigint).

    ``spark.range`` generates each slice inside its own task, so the
    sequence is parallel and never materialised on the driver.
    """
    if end < start:
        return spark.range(0).withColumnRenamed("id", "value")
    return spark.range(start, end + 1, 1, num_partitions).withColumnRenamed("id", "value")
