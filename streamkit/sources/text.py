"""Line-oriented text files (S3, S4) in batch and streaming form.

Lines carry an explicit order: ``(file_path, file_block_start, line_id)``.
``line_id`` alone is not an order, since Spark may pack file splits into a
partition out of file order; the triple is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER_COLS = ["file_path", "file_block_start", "line_id"]


def read_text_file(spark: SparkSession, path: str, with_order: bool = True, line_sep: str | None = None) -> DataFrame:
    """One row per line, column ``value``; ``path`` may be a file, directory or glob."""
    reader = spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    df = reader.text(path)
    if not with_order:
        return df
    return df.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_block_start"),
        F.monotonically_increasing_id().alias("line_id"),
    )


def read_file(spark: SparkSession, path: str, input_format: str = "text", **options) -> DataFrame:
    """Read through an explicit input format (the long form of ``read_text_file``)."""
    if input_format == "text":
        return read_text_file(spark, path, line_sep=options.pop("line_sep", None))
    return spark.read.format(input_format).options(**options).load(path)


def read_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming twin: new files under ``path`` become new lines."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
