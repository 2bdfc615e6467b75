"""One-in/one-out and one-in/many-out transforms.

Functions take Columns (or Column-returning callables), so every step stays
inside whole-stage codegen.  ``flat_map_python`` is for bodies that no array
expression gives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from streamkit.functions.text import WHITESPACE, tokens
from streamkit.session import ship_package


def map_values(df: DataFrame, fn: Callable[[Column], Column], col: str = "value", name: str | None = None) -> DataFrame:
    """Map one column through a Column function (``name`` defaults to in place)."""
    return df.withColumn(name or col, fn(F.col(col)))


def flat_map(df: DataFrame, array_expr: Column, name: str = "value", keep: tuple[str, ...] = (),
             with_pos: bool = True) -> DataFrame:
    """Zero or more output rows per input row from an array expression.
    ``pos`` records each element's position inside its input row."""
    if with_pos:
        return df.select(*keep, F.posexplode(array_expr).alias("pos", name))
    return df.select(*keep, F.explode(array_expr).alias(name))


def flat_map_python(df: DataFrame, make: Callable[[], Callable[[Row], Iterator[tuple]]], schema: str | Callable[[T.StructType], T.StructType],
                    keep: tuple[str, ...] = (), reads: tuple[str, ...] | None = None) -> DataFrame:
    """Zero or more rows per input row from a Python generator, by a table
    function joined laterally, without a shuffle.

    ``make`` is called once per task and gives the body, which may hold what is
    costly to set up; the body gets a row of the columns ``reads`` (default: all)
    and yields tuples.  ``schema`` is their DDL, or a function from the row's type
    to theirs, asked when the query is analysed.  The result has the columns
    ``keep`` and those of the schema; a row whose body yields nothing has none.
    The body may not rely on the order of rows or on their number in a task.
    """
    ship_package(df.sparkSession)
    fixed = T.StructType.fromDDL(schema) if isinstance(schema, str) else None

    class Body:
        @staticmethod
        def analyze(row: AnalyzeArgument) -> AnalyzeResult:
            return AnalyzeResult(schema=fixed if fixed is not None else schema(row.dataType))

        def __init__(self):
            self.body = make()

        def eval(self, row: Row) -> Iterator[tuple]:
            yield from self.body(row)

    kept = [F.col(c).alias(f"_fm_{i}") for i, c in enumerate(keep)]
    rows = df.select(*kept, F.struct(*[F.col(c) for c in reads or df.columns]).alias("_fm_row"))
    names = (fixed if fixed is not None else schema(rows.schema["_fm_row"].dataType)).names
    out = rows.lateralJoin(F.udtf(Body)(F.col("_fm_row").outer()))
    return out.select(*[F.col(f"_fm_{i}").alias(c) for i, c in enumerate(keep)], *names)


def filter_rows(df: DataFrame, predicate: Column) -> DataFrame:
    return df.where(predicate)


def word_tokens(df: DataFrame, text_col: str = "value", keep: tuple[str, ...] = (), drop_empty: bool = False,
                pattern: str = WHITESPACE) -> DataFrame:
    """P5: one ``(word, count=1)`` row per piece of the text split on each
    single whitespace character."""
    out = df.select(*keep, F.posexplode(tokens(F.col(text_col), pattern, drop_empty)).alias("pos", "word"))
    return out.withColumn("count", F.lit(1).cast("long"))


def word_count(df: DataFrame, text_col: str = "value", drop_empty: bool = False) -> DataFrame:
    """Words and their counts over all texts (partial aggregation absorbs hot words)."""
    words = df.select(F.explode(tokens(F.col(text_col), WHITESPACE, drop_empty)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
