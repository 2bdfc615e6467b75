"""Text and delimited file sinks.

Each task writes its own part file; ``single_file=True`` narrows only the
sink to one task (``coalesce(1)``), the rest of the plan stays parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _joined(cols: Sequence[Column], sep: str) -> Column:
    """Fields as text; a null field is empty, so that the others keep their place."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]).alias("value")


def _one_string(df: DataFrame) -> DataFrame:
    """Each element as a string; a null string is an empty line."""
    if len(df.columns) == 1 and df.schema.fields[0].dataType.simpleString() == "string":
        return df.select(_joined([F.col(f"`{df.columns[0]}`")], ""))
    return df.select(_joined([F.col(f"`{c}`") for c in df.columns], ","))


def write_text(df: DataFrame, path: str, mode: str = "error", single_file: bool = False, line_sep: str = "\n"):
    """One element per line.  Default mode refuses an existing target."""
    out = _one_string(df)
    if single_file:
        out = out.coalesce(1)
    if out.isStreaming:
        return out.writeStream.format("text").option("path", path).option("lineSep", line_sep)
    out.write.mode(mode).option("lineSep", line_sep).text(path)
    return None


def delimited_lines(df: DataFrame, cols: Sequence[str | Column] | None = None, field_delim: str = ",") -> DataFrame:
    """Fields joined by ``field_delim`` as written (no quoting), column ``value``."""
    cols = cols if cols is not None else df.columns
    return df.select(_joined([F.col(c) if isinstance(c, str) else c for c in cols], field_delim))


def write_delimited(df: DataFrame, path: str, cols: Sequence[str | Column] | None = None, mode: str = "overwrite",
                    row_delim: str = "\n", field_delim: str = ",", single_file: bool = False):
    """Tuple fields as text with custom row and field delimiters.

    Written with the text writer, not the CSV writer: the CSV writer quotes
    fields containing any part of a multi-character delimiter.
    """
    return write_text(delimited_lines(df, cols, field_delim), path, mode=mode, single_file=single_file,
                      line_sep=row_delim)
