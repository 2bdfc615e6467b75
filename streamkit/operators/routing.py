"""Multi-stream operators: union, split/select, connect, co-map, co-flatMap (M1-M6).

* ``split`` tags every row with the list of output names it goes to;
  ``select_outputs`` keeps the rows tagged with any of the given names.
* ``connect`` keeps two differently-typed inputs side by side; ``co_map`` /
  ``co_flat_map`` give each side its own function and union the results
  into one tagged frame: ``side`` (1 or 2) plus one value column per side,
  the other side's column null.  That is the typed form of a stream of
  mixed element types.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUTPUTS = "_outputs"


def union(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept (a self-union doubles each row)."""
    return reduce(lambda a, b: a.unionByName(b), others, first)


def split(df: DataFrame, selector: Column) -> DataFrame:
    """Tag rows with ``selector``: an ``array<string>`` of output names per row."""
    return df.withColumn(OUTPUTS, selector)


def first_match_selector(rules: list[tuple[Column, str]], default: str) -> Column:
    """If/else-if routing: the name of the first rule whose condition holds."""
    expr = None
    for cond, name in rules:
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    return F.array(expr)


def select_outputs(split_df: DataFrame, *names: str) -> DataFrame:
    """Rows routed to any of ``names`` (tag column dropped)."""
    wanted = F.array(*[F.lit(n) for n in names])
    return split_df.where(F.arrays_overlap(F.col(OUTPUTS), wanted)).drop(OUTPUTS)


@dataclass
class Connected:
    """Two inputs carried together; neither changes the other."""

    first: DataFrame
    second: DataFrame

    def co_map(self, f1: Callable[[DataFrame], Column], f2: Callable[[DataFrame], Column],
               names: tuple[str, str] = ("v1", "v2")) -> DataFrame:
        """One output row per input row of either side."""
        return self._tagged(self.first.select(f1(self.first).alias(names[0])),
                            self.second.select(f2(self.second).alias(names[1])), names)

    def co_flat_map(self, f1: Callable[[DataFrame], Column], f2: Callable[[DataFrame], Column],
                    names: tuple[str, str] = ("v1", "v2")) -> DataFrame:
        """``f1``/``f2`` return an array per row; each element becomes a row.
        ``pos`` keeps the element's position within its input row."""
        a = self.first.select(F.posexplode(f1(self.first)).alias("pos", names[0]))
        b = self.second.select(F.posexplode(f2(self.second)).alias("pos", names[1]))
        return self._tagged(a, b, names)

    @staticmethod
    def _tagged(a: DataFrame, b: DataFrame, names: tuple[str, str]) -> DataFrame:
        n1, n2 = names
        t1 = a.select(F.lit(1).alias("side"), *[c for c in a.columns if c != n1], F.col(n1),
                      F.lit(None).cast(b.schema[n2].dataType).alias(n2))
        t2 = b.select(F.lit(2).alias("side"), *[c for c in b.columns if c != n2],
                      F.lit(None).cast(a.schema[n1].dataType).alias(n1), F.col(n2))
        return t1.unionByName(t2)


def connect(first: DataFrame, second: DataFrame) -> Connected:
    return Connected(first, second)


def write_split(split_df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append"):
    """Write every routed output in one pass: one partition per output name
    (a row tagged with several names is written to each).  Batch frames are
    written at once; streaming frames get a ``foreachBatch`` writer to start,
    writing each micro-batch to its own ``batch=<id>`` folder with overwrite,
    so a retried micro-batch replaces its output instead of duplicating it."""
    tagged = split_df.withColumn("output", F.explode(F.col(OUTPUTS))).drop(OUTPUTS)
    if tagged.isStreaming:
        def each_batch(batch: DataFrame, batch_id: int):
            batch.write.mode("overwrite").partitionBy("output").format(fmt).save(f"{path}/batch={batch_id}")

        return tagged.writeStream.foreachBatch(each_batch)
    tagged.write.mode(mode).partitionBy("output").format(fmt).save(path)
    return None


def read_output(spark, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """One routed output back (partition pruning reads only its files)."""
    df = spark.read.format(fmt).load(path)
    return df.where(F.col("output") == name).drop("output", *(["batch"] if "batch" in df.columns else []))
