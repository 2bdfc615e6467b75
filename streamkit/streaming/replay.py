"""Replaying records as a stream.

``replay_lines`` writes one file per record so that a file stream with
``maxFilesPerTrigger=1`` delivers exactly one record per micro-batch, in
order: the deterministic stand-in for a socket fed by hand.
``table_stream`` streams a parquet table of a scale-factor directory in the
order that the file source gives; ``sources.ordered`` does in order of time.
"""

from __future__ import annotations

import os
import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from streamkit.functions.time import ntz_to_instant


def replay_lines(lines: Iterable[str], directory: str) -> str:
    os.makedirs(directory, exist_ok=True)
    base = time.time() - 1_000_000
    for i, line in enumerate(lines):
        path = os.path.join(directory, f"{i:08d}.txt")
        with open(path, "w", encoding="utf-8") as fh:
            fh.write(line)
        # The file source picks files by modification time: make it strictly
        # increasing so records arrive in list order.
        os.utime(path, (base + i, base + i))
    return directory


def line_stream(spark: SparkSession, directory: str, per_batch: int = 1) -> DataFrame:
    """Lines of the files in ``directory``, ``per_batch`` files per micro-batch."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", str(per_batch)).load(directory)


#: Bytes of a table in one micro-batch, unless a number of files is given.
BATCH_BYTES = str(1 << 30)


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A table, one file or a folder of part files, as a stream with a rate
    limit; ``ts`` columns become TIMESTAMP (watermarks need it)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    table = spark.read.parquet(path)
    reader = spark.readStream.schema(table.schema)
    reader = reader.option("maxFilesPerTrigger", str(max_files)) if max_files else reader.option("maxBytesPerTrigger", BATCH_BYTES)
    if any(f.rstrip("/").endswith(f"/{name}.parquet") for f in table.inputFiles()[:1]):
        df = reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    else:
        df = reader.parquet(path)
    return with_instants(df)


def with_instants(df: DataFrame) -> DataFrame:
    if "ts" in df.columns and isinstance(df.schema["ts"].dataType, T.TimestampNTZType):
        df = df.withColumn("ts", ntz_to_instant("ts"))
    return df
