"""Keying and rolling (per-record) keyed aggregates: K1-K3, R1-R6.

A rolling aggregate emits one row per input row: the aggregate of the key's
rows up to and including it, in an explicit order.  On bounded frames they
run on ``keyed_scan`` and so split hot keys across tasks; on streaming
frames they run the stateful twins in ``streamkit.streaming.stateful``.
``state`` lets one run on the micro-batches of a stream, one after the other,
with hot keys split (see ``streamkit.streaming.tables``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamkit.functions.time import ntz_micros
from streamkit.operators.scan import Scan, keyed_scan

KeySpec = str | int | Column | Callable[[DataFrame], Column]


def resolve_key(df: DataFrame, key: KeySpec) -> Column:
    """A key given as a field name, a field position, a Column or a selector."""
    if isinstance(key, str):
        return F.col(key)
    if isinstance(key, int):
        return F.col(df.columns[key])
    if isinstance(key, Column):
        return key
    if callable(key):
        return key(df)
    raise TypeError(f"unsupported key {key!r}")


def key_by(df: DataFrame, key: KeySpec, name: str = "key") -> DataFrame:
    """Attach the key as column ``name``.

    No repartition is forced: the operator that consumes the key shuffles
    on it (with partial aggregation where it can), and a low-cardinality
    key would otherwise funnel all rows into a few tasks.
    """
    if isinstance(key, str) and key == name:
        return df
    return df.withColumn(name, resolve_key(df, key))


def resolve_keys(df: DataFrame, key, name: str = "key") -> tuple[DataFrame, list[str], list[str]]:
    """(frame, key column names, those of them that were added): every key
    form, alone or in a list.  Names and positions stand for their columns; a
    Column or selector is attached as ``name`` (``name_2`` and so on)."""
    forms = list(key) if isinstance(key, (list, tuple)) else [] if key is None else [key]
    names, added = [], []
    for form in forms:
        if isinstance(form, (str, int)) and not isinstance(form, bool):
            names.append(form if isinstance(form, str) else df.columns[form])
            continue
        new = name if not added else f"{name}_{len(added) + 1}"
        df = df.withColumn(new, resolve_key(df, form))
        names.append(new)
        added.append(new)
    return df, names, added


def _names(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _single(x: str | Sequence[str], what: str) -> str:
    names = _names(x)
    if len(names) != 1:
        raise ValueError(f"on a stream the {what} is one column")
    return names[0]


def _stream():
    # imported lazily: the streaming twins live in streamkit.streaming
    from streamkit.streaming import stateful

    return stateful


def _carry_first(scans: list[Scan], carry: Sequence[str]) -> list[Scan]:
    return scans + [Scan("first", F.col(c), f"_first_{c}") for c in carry]


def _apply_carry(out: DataFrame, carry: Sequence[str]) -> DataFrame:
    for c in carry:
        out = out.withColumn(c, F.col(f"_first_{c}")).drop(f"_first_{c}")
    return out


def rolling_sum(
    df: DataFrame,
    key: KeySpec | Sequence[KeySpec],
    order: str | Sequence[str],
    value: str,
    name: str | None = None,
    carry: Sequence[str] = (),
    blocks: int | None = None,
    state=None,
) -> DataFrame:
    """Running sum of ``value``.  ``carry`` fields take the key's first
    record's value (the non-aggregated fields of the running record)."""
    name = name or value
    df, key, added = resolve_keys(df, key, "_key")
    if df.isStreaming:
        out = _stream().rolling_stream(df, _single(key, "key"), _single(order, "order"), value, "sum", "_run", carry)
        out = out.drop(*added)
        return out.drop(value).withColumnRenamed("_run", name) if name == value else out.withColumnRenamed("_run", name)
    scans = _carry_first([Scan("sum", F.col(value), "_run")], carry)
    out = keyed_scan(df, key, _names(order), scans, blocks=blocks, state=state).drop(*added)
    out = out.drop(value).withColumnRenamed("_run", name) if name == value else out.withColumnRenamed("_run", name)
    return _apply_carry(out, carry)


def rolling_fold(
    df: DataFrame,
    key: KeySpec | Sequence[KeySpec],
    order: str | Sequence[str],
    value: Column | str,
    initial,
    name: str = "fold",
    blocks: int | None = None,
    state=None,
) -> DataFrame:
    """``initial + v1 + ... + vi`` per row (a fold whose step adds)."""
    v = F.col(value) if isinstance(value, str) else value
    df, key, added = resolve_keys(df, key, "_key")
    if df.isStreaming:
        out = _stream().rolling_stream(df.withColumn("_fold_v", v), _single(key, "key"), _single(order, "order"),
                                       "_fold_v", "fold", name, initial=initial)
        return out.drop("_fold_v", *added)
    out = keyed_scan(df.withColumn("_fold_v", v), key, _names(order), [Scan("sum", F.col("_fold_v"), "_run")], blocks=blocks, state=state)
    total = F.coalesce(F.col("_run"), F.lit(0).cast(out.schema["_run"].dataType))
    return out.withColumn(name, F.lit(initial) + total).drop("_run", "_fold_v", *added)


def rolling_reduce(
    df: DataFrame,
    key: KeySpec | Sequence[KeySpec],
    order: str | Sequence[str],
    value: str,
    field: str,
    label: Column,
    blocks: int | None = None,
    state=None,
) -> DataFrame:
    """R2: a summing reduce whose output record replaces ``field`` with
    ``label``; the key's first record passes through unchanged."""
    df, key, added = resolve_keys(df, key, "_key")
    if df.isStreaming:
        out = _stream().rolling_reduce_stream(df.withColumn("_label", label), _single(key, "key"),
                                              _single(order, "order"), value, field, None, label_col="_label")
        return out.drop("_label", *added)
    scans = [Scan("sum", F.col(value), "_run"), Scan("count", None, "_rn")]
    out = keyed_scan(df, key, _names(order), scans, blocks=blocks, state=state)
    first = F.col("_rn") == 1
    return (
        out.withColumn(field, F.when(first, F.col(field)).otherwise(label))
        .withColumn(value, F.col("_run"))
        .drop("_run", "_rn", *added)
    )


def rolling_extreme(
    df: DataFrame,
    key: KeySpec | Sequence[KeySpec],
    order: str | Sequence[str],
    field: str,
    kind: str = "max",
    name: str | None = None,
    carry: Sequence[str] = (),
    blocks: int | None = None,
    state=None,
) -> DataFrame:
    """Running max/min of ``field``; ``carry`` fields stay the first record's."""
    if kind not in ("max", "min"):
        raise ValueError("kind is 'max' or 'min'")
    name = name or field
    df, key, added = resolve_keys(df, key, "_key")
    if df.isStreaming:
        out = _stream().rolling_stream(df, _single(key, "key"), _single(order, "order"), field, kind, "_ext", carry).drop(*added)
        return (out.drop(field) if name == field else out).withColumnRenamed("_ext", name)
    scans = _carry_first([Scan(kind, F.col(field), "_ext")], carry)
    out = keyed_scan(df, key, _names(order), scans, blocks=blocks, state=state).drop(*added)
    out = (out.drop(field) if name == field else out).withColumnRenamed("_ext", name)
    return _apply_carry(out, carry)


def _negate(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return -ntz_micros(name)
    if isinstance(dtype, T.TimestampType):
        return -F.unix_micros(F.col(name))
    if isinstance(dtype, T.NumericType):
        return -F.col(name)
    raise TypeError(f"order column {name!r} must be numeric or a timestamp for max_by")


def rolling_extreme_by(
    df: DataFrame,
    key: KeySpec | Sequence[KeySpec],
    order: str | Sequence[str],
    field: str,
    record: Sequence[str],
    kind: str = "max",
    prefix: str = "",
    blocks: int | None = None,
    state=None,
) -> DataFrame:
    """The whole record (``record`` columns) holding the running max/min of
    ``field``; on ties the earliest record wins.  Records whose ``field`` is
    null are never the extreme."""
    columns = df.columns
    df, key, added = resolve_keys(df, key, "_key")
    if df.isStreaming:
        return _stream().rolling_extreme_by_stream(df, _single(key, "key"), _single(order, "order"), field,
                                                   list(record), kind, prefix).drop(*added)
    order = _names(order)
    if kind == "max":
        tie = [_negate(df, o) for o in order]
    elif kind == "min":
        tie = [F.col(o) for o in order]
    else:
        raise ValueError("kind is 'max' or 'min'")
    rec = F.when(F.col(field).isNotNull(), F.struct(F.col(field).alias("_v"), *[t.alias(f"_o{i}") for i, t in enumerate(tie)],
                                                    *[F.col(c) for c in record]))
    out = keyed_scan(df, key, order, [Scan(kind, rec, "_best")], blocks=blocks, state=state)
    return out.select(*columns, *[F.col(f"_best.{c}").alias(f"{prefix}{c}") for c in record])


def fold_groups(df: DataFrame, groups: Sequence[str], order: Sequence[str], step: Callable, schema: str,
                initial=None, every: bool = True) -> DataFrame:
    """An arbitrary Python step over each group's records in order.

    ``acc = step(acc, record)`` with records as dicts of exact Python values;
    ``acc`` starts as a copy of ``initial``, or as the group's first record
    where ``initial`` is None (a reduce).  The result rows are the groups'
    columns and the fields of ``acc`` named in ``schema``: after every record
    (``every``), or once per group.

    Only for steps that no built-in aggregate expresses.  Spark partitions
    and sorts by group and marks each group's first and last row (null groups
    are a group); the tasks walk their rows in Arrow batches and hold one
    accumulator, so a group of any size passes, but one task passes it.
    """
    import copy

    import pyarrow as pa
    from pyspark.sql import Window
    from pyspark.sql.pandas.types import to_arrow_schema

    from streamkit.session import ship_package

    ship_package(df.sparkSession)
    groups, order = list(groups), list(order)
    by = Window.partitionBy(*groups).orderBy(*[F.col(o) for o in order])
    marked = df.select("*", (F.row_number().over(by) == 1).alias("_first"), F.lead(F.lit(1)).over(by).isNull().alias("_last"))
    fields = T.StructType([df.schema[g] for g in groups] + T.StructType.fromDDL(schema).fields)
    arrow = to_arrow_schema(fields)

    def walk(batches):
        acc = None
        for batch in batches:
            out = []
            for record in batch.to_pylist():
                first, last = record.pop("_first"), record.pop("_last")
                if first:
                    acc = copy.deepcopy(initial)
                acc = dict(record) if first and initial is None else step(acc, record)
                if every or last:
                    out.append({**{g: record[g] for g in groups}, **copy.deepcopy({n: acc[n] for n in arrow.names if n not in groups})})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return marked.mapInArrow(walk, fields)


def rolling_map_in_pandas(
    df: DataFrame,
    key: KeySpec,
    order: str | Sequence[str],
    step: Callable,
    initial,
    value: str,
    name: str,
    result_type: str,
) -> DataFrame:
    """A rolling fold with an arbitrary Python step ``acc = step(acc, v)``
    over one column; every row keeps its columns and gains ``name``."""
    columns = df.columns
    df, key, added = resolve_keys(df, key, "_key")
    kept = [c for c in df.columns if c not in key]
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept] + [f"`{name}` {result_type}"])

    def one(acc, record):
        return {**{c: record[c] for c in kept}, name: step(acc[name], record[value])}

    return fold_groups(df, key, _names(order), one, schema, initial={name: initial}).select(*columns, name)
