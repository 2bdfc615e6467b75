"""Helpers shared by the operators: tables, stage tables, Arrow columns."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from streamkit.session import ship_package


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors
    share.  Only a local master, where one machine runs everything, may leave
    it unset; then a temporary folder serves."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = getattr(shared_dir, "own", None)
    if own is None:
        own = shared_dir.own = tempfile.mkdtemp(prefix="streamkit-llm-")
    return own


#: Bytes of rows that go to a Python worker, and are worked on there, together.
BATCH = 4 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Let this session's Arrow batches end at ``BATCH`` bytes, not at 10,000
    rows, unless it has a bound of its own: an executor holds each one several
    times, outside the heap and in Python."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(BATCH))


#: Whether a query's shuffle files are removed at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and reread it: cuts the
    lineage, survives lost executors and computes ``df`` once.  The files live
    in a folder of their own per application and call.  The shuffle files behind
    it go when it is written, not when the driver's memory is next collected."""
    spark = df.sparkSession
    ship_package(spark)
    path = f"{shared_dir(spark)}/streamkit-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    if _passing():
        _passing()[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


_LOCAL = threading.local()


def _passing() -> list[list[str]]:
    """The stage tables of the ``staged_result`` calls that this thread is in."""
    if not hasattr(_LOCAL, "passing"):
        _LOCAL.passing = []
    return _LOCAL.passing


def staged_result(name: str) -> Callable:
    """Decorates a function whose DataFrame becomes a stage table; the stage
    tables made on the way to it are deleted when it is written."""
    def wrap(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(f)
        def run(*args, **kwargs) -> DataFrame:
            _passing().append([])
            try:
                out = f(*args, **kwargs)
            finally:
                paths = _passing().pop()
            held, spark = stage_table(out, name), out.sparkSession
            for path in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            return held

        return run

    return wrap


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, named ``doc_id`` and ``text``; a null text is
    empty.  Other columns, whatever their names, play no part."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def fingerprint(*cols: str | Column) -> tuple[Column, Column]:
    """``fa, fb``: 128 bits of a stored row's values.  Null ids, and ids that
    carry several texts, keep rows of their own; a row stored twice has one."""
    return F.xxhash64(*cols).alias("fa"), F.xxhash64(F.lit(1), *cols).alias("fb")


#: Bits of ``may_hold``'s table: 2**25 bits are 4 MB, whatever the data's size.
FILTER_BITS = 1 << 25


def mark_held(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``df`` with ``maybe``: whether its hashed long ``key`` may be among the
    keys of ``wanted``.  False is certain, so rows that are not marked need
    not move to a join.  The broadcast table is a bitmap of fixed size; when
    the wanted keys fill it, all rows are marked and only the saving is lost."""
    chunk = 32768
    at = F.pmod(F.col(key), F.lit(FILTER_BITS))
    bits = (wanted.select(at.alias("at")).groupBy((F.col("at") / chunk).cast("int").alias("_chunk"))
            .agg(F.bitmap_construct_agg(F.col("at") % chunk).alias("_bits")))
    here = df.withColumn("_at", at).withColumn("_chunk", (F.col("_at") / chunk).cast("int"))
    byte = F.conv(F.hex(F.expr(f"substring(_bits, cast(_at % {chunk} div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.pow(F.lit(2), F.col("_at") % 8).cast("int")) != 0
    return here.join(F.broadcast(bits), "_chunk", "left").select(*df.columns, F.coalesce(hit, F.lit(False)).alias("maybe"))


def may_hold(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``df`` that ``mark_held`` marks."""
    return mark_held(df, key, wanted).where("maybe").select(*df.columns)


def left_join_held(df: DataFrame, found: DataFrame, keys: list[str], by: str) -> DataFrame:
    """``df`` left joined with ``found`` on ``keys``; only rows whose hashed
    long key ``by`` may be found move.  ``found`` should be a stage table."""
    marked = mark_held(df, by, found)
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in found.schema if f.name not in keys]
    names = [*df.columns, *(c for c in found.columns if c not in keys)]
    moved = marked.where("maybe").join(found, keys, "left").select(*names)
    return moved.unionByName(marked.where("not maybe").select(*df.columns, *rest))


#: The column that carries a whole row, or all of it but its text, past helper columns.
ROW = "_doc"


def nested(docs: DataFrame, *helpers: Column, apart: str | None = None) -> DataFrame:
    """Each row as one struct ``ROW`` beside ``helpers``, so that no column of
    the table clashes with a helper's name; column ``apart`` stays beside it."""
    own = [F.col(f"`{c}`") for c in docs.columns if c != apart]
    return docs.select(F.struct(*own).alias(ROW), *([F.col(f"`{apart}`")] if apart else []), *helpers)


def unnested(df: DataFrame, columns: list[str], apart: str | None = None) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") if c == apart else F.col(ROW)[c].alias(c) for c in columns])


#: The models that this worker keeps between tasks, and whether its task uses them.
_MODELS: dict[Callable, bool] = {}


def task_model(load: Callable) -> Callable:
    """Decorates a function that loads a model: a worker keeps it for further
    tasks, until ``map_texts`` runs one that doesn't load it."""
    held = functools.lru_cache(maxsize=2)(load)

    @functools.wraps(load)
    def get(*args):
        _MODELS[held] = True
        return held(*args)

    return get


def _made(make: Callable) -> Callable:
    _MODELS.update(dict.fromkeys(_MODELS, False))
    f = make()
    for held in [x for x, used in _MODELS.items() if not used]:
        held.cache_clear()
    return f


def map_texts(df: DataFrame, make: Callable[[], Callable[[list], dict]], schema: str | StructType, most: int = BATCH) -> DataFrame:
    """``mapInArrow`` over all columns of ``df``: ``make()`` runs once per
    task and gives a function from a dict of Python lists, of about ``most``
    bytes, to a dict of lists (or arrays), one entry per result row."""
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = _made(make)
        for batch in batches:
            for lo, hi in _spans(batch, most):
                out = f({n: c.to_pylist() for n, c in zip(batch.schema.names, batch.slice(lo, hi - lo).columns)})
                yield pa.RecordBatch.from_arrays([pa.array(out[x.name], type=x.type) for x in arrow], schema=arrow)
        del f
        release_memory()

    return df.mapInArrow(run, schema)


def release_memory() -> None:
    """Give a finished task's memory back to the machine: workers live on and
    serve other stages, next to the executor's JVM."""
    gc.collect()
    trim_memory()


def trim_memory() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def release_heap(spark: SparkSession) -> None:
    """Give the executors' unused heap back to the machine: a heap that grew
    in one stage of a pipeline stays that large, next to the Python workers of
    the stages after it, until a full collection; one task per core asks for it."""
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).select(F.java_method(F.lit("java.lang.System"), F.lit("gc"))).collect()


def _spans(batch: pa.RecordBatch, most: int) -> list[tuple[int, int]]:
    """Row ranges of a batch of about ``most`` bytes each, so that very long
    texts are not all turned into Python strings at once."""
    if batch.num_rows == 0:
        return []
    rows = max(1, int(batch.num_rows * most // max(batch.nbytes, 1)))
    return [(i, min(i + rows, batch.num_rows)) for i in range(0, batch.num_rows, rows)]


def tokenizer_path(name: str) -> str:
    """A public vocabulary file by name; an absolute path passes unchanged."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def id_type(df: DataFrame, name: str = "doc_id") -> str:
    return df.schema[name].dataType.simpleString()
