"""Per-record stateful stream operators: rolling aggregates (R1-R6) and count
windows (W6, W7) via ``applyInPandasWithState``.

State per key is a small accumulator (plus, for sliding count windows, the
last ``size`` values).  Rows travel as structs (integers as decimals), so Python sees the exact values
(64-bit integers next to nulls, decimals, times), and the results follow the
batch operators: the same types, nulls skipped by sums and extrema, null
orders first.  Within a micro-batch a key's rows reach the state function in
shuffle order and a stream cannot be sorted before a stateful operator; so a
key's rows of one micro-batch are gathered and sorted before folding.  Memory
therefore holds one key's rows of one micro-batch, which the source's rate
limit bounds (``table_stream`` sets one).  Across micro-batches the order is
arrival order: a row arriving in a later batch cannot be moved before rows
already folded.  One key is one task per micro-batch; a bounded table is
better served by the batch operators, which split hot keys.
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from streamkit.session import ship_package

_KINDS = ("sum", "count", "max", "min", "fold")


def result_type(df: DataFrame, value: Column) -> T.DataType:
    """The type that the batch operator gives ``value`` (an aggregate)."""
    empty = df.sparkSession.createDataFrame([], df.schema)
    return empty.agg(value.alias("x")).schema["x"].dataType


def _add(acc, v):
    return v if acc is None else acc if v is None else acc + v


def _larger(acc, v):
    return v if acc is None else acc if v is None or not v > acc else v


def _smaller(acc, v):
    return v if acc is None else acc if v is None or not v < acc else v


def _stepper(kind: str) -> tuple[Callable, object]:
    if kind == "count":
        return lambda acc, v: acc + (v is not None), 0
    return {"sum": _add, "fold": _add, "max": _larger, "min": _smaller}[kind], None


def _folded(acc, initial):
    """``initial + sum``; the sum's type decides."""
    return initial if acc is None else type(acc)(str(initial)) + acc if type(acc).__name__ == "Decimal" else initial + acc


def _stateful(df: DataFrame, key: str, order: str, out: T.StructType, state: T.StructType, fold: Callable) -> DataFrame:
    """``fold(key value, rows, state tuple or None)`` gives (result rows,
    new state tuple); rows are dicts in order, result rows tuples of ``out``."""
    ship_package(df.sparkSession)
    # integers travel as decimals: pandas has no exact integers next to nulls
    whole = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)]
    packed = df.select(F.col(key).alias("_key"), F.struct(*[(F.col(c).cast("decimal(20,0)") if c in whole else F.col(c)).alias(c) for c in df.columns]).alias("_row"))
    types = {f.name: f.dataType for f in out.fields}

    def frame(rows: list) -> pd.DataFrame:
        columns = {}
        for i, (name, kind) in enumerate(types.items()):
            values = [r[i] for r in rows]
            columns[name] = pd.Series(values, dtype=object) if not isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else pd.Series(pd.to_datetime(values))
        return pd.DataFrame(columns)

    def step(key_tuple, pdfs, held):
        rows = [r.asDict() if hasattr(r, "asDict") else dict(r) for pdf in pdfs for r in pdf["_row"]]
        if not rows:
            return
        for r in rows:
            for c in whole:
                r[c] = None if r[c] is None else int(r[c])
        rows.sort(key=lambda r: (r[order] is not None, r[order] if r[order] is not None else 0))
        results, after = fold(key_tuple[0], rows, tuple(held.get) if held.exists else None)
        held.update(after)
        if results:
            yield frame(results)

    return packed.groupBy("_key").applyInPandasWithState(step, out, state, "append", GroupStateTimeout.NoTimeout)


def rolling_stream(
    df: DataFrame,
    key: str,
    order: str,
    value: str | None,
    kind: str = "sum",
    name: str = "running",
    carry: Sequence[str] = (),
    initial: float | int = 0,
) -> DataFrame:
    """One output row per input row: the running ``kind`` of ``value`` within
    ``key``; ``carry`` fields take the key's first record's values."""
    if kind not in _KINDS:
        raise ValueError(f"kind must be one of {sorted(_KINDS)}")
    fields = {f.name: f for f in df.schema.fields}
    v = F.col(value) if value is not None else F.lit(1)
    kinds = {"sum": F.sum, "fold": F.sum, "count": F.count, "max": F.max, "min": F.min}
    acc_type = result_type(df, kinds[kind](v))
    out_type = result_type(df, F.lit(initial) + F.sum(v)) if kind == "fold" else acc_type
    cols = [c for c in df.columns if c not in carry] + list(carry)
    out = T.StructType([fields[c] for c in cols] + [T.StructField(name, out_type, True)])
    state = T.StructType([T.StructField("acc", acc_type, True)] + [T.StructField(f"first_{c}", fields[c].dataType, True) for c in carry])
    step, start = _stepper(kind)

    def fold(_key, rows, held):
        acc, firsts = (held[0], held[1:]) if held else (start, tuple(rows[0][c] for c in carry))
        results = []
        for r in rows:
            acc = step(acc, r[value] if value is not None else 1)
            shown = _folded(acc, initial) if kind == "fold" else acc
            results.append((*(r[c] for c in cols[:len(cols) - len(firsts)]), *firsts, shown))
        return results, (acc, *firsts)

    return _stateful(df, key, order, out, state, fold)


def count_window_stream(
    df: DataFrame,
    key: str,
    order: str,
    value: str,
    size: int,
    slide: int | None = None,
    name: str = "sum",
    kind: str = "sum",
    initial: float | int = 0,
) -> DataFrame:
    """Count windows per key on a stream: tumbling (``slide`` None) emits the
    aggregate of every ``size`` consecutive values; sliding emits, after every
    ``slide``-th value, the aggregate of the last ``<= size`` values.
    ``kind``: ``sum`` | ``count`` | ``fold`` (``initial + sum``) | ``max`` | ``min``."""
    if kind not in _KINDS:
        raise ValueError("kind is one of sum, count, fold, max, min")
    kinds = {"sum": F.sum(value), "fold": F.lit(initial) + F.sum(value), "count": F.count(value), "max": F.max(value), "min": F.min(value)}
    out = T.StructType([T.StructField(key, df.schema[key].dataType, True), T.StructField("window_end_count", T.LongType(), False),
                        T.StructField(name, result_type(df, kinds[kind]), True)])
    state = T.StructType([T.StructField("n", T.LongType(), False), T.StructField("recent", T.ArrayType(df.schema[value].dataType, True), False)])
    every = slide or size
    step, start = _stepper(kind)

    def fold(key_value, rows, held):
        n, recent = (held[0], list(held[1])) if held else (0, [])
        results = []
        for r in rows:
            n += 1
            recent = [*recent[-(size - 1):], r[value]] if size > 1 else [r[value]]
            if n % every == 0:
                acc = start
                for v in recent:  # each window's own values, so no error is carried on
                    acc = step(acc, v)
                results.append((key_value, n, _folded(acc, initial) if kind == "fold" else acc))
                if slide is None:
                    recent = []
        return results, (n, recent)

    return _stateful(df, key, order, out, state, fold)


def rolling_extreme_by_stream(
    df: DataFrame,
    key: str,
    order: str,
    field: str,
    record: Sequence[str],
    kind: str = "max",
    prefix: str = "best_",
) -> DataFrame:
    """R5 on a stream: per input row, the record (``record`` columns) holding
    the key's running max/min of ``field``; the earliest record wins ties, and
    records whose ``field`` is null are never the extreme."""
    if kind not in ("max", "min"):
        raise ValueError("kind is 'max' or 'min'")
    fields = {f.name: f for f in df.schema.fields}
    out = T.StructType(list(df.schema.fields) + [T.StructField(f"{prefix}{c}", fields[c].dataType, True) for c in record])
    state = T.StructType([T.StructField("v", fields[field].dataType, True)] + [T.StructField(f"r_{c}", fields[c].dataType, True) for c in record])
    cols = df.columns

    def fold(_key, rows, held):
        best = held or (None,) * (1 + len(record))
        results = []
        for r in rows:
            v = r[field]
            if v is not None and (best[0] is None or (v > best[0] if kind == "max" else v < best[0])):
                best = (v, *(r[c] for c in record))
            results.append((*(r[c] for c in cols), *best[1:]))
        return results, best

    return _stateful(df, key, order, out, state, fold)


def rolling_reduce_stream(
    df: DataFrame,
    key: str,
    order: str,
    value: str,
    field: str,
    label,
    step=None,
    initial=None,
    label_col: str | None = None,
) -> DataFrame:
    """R2 / R6 on a stream: one output row per input row.

    Without ``step``: a summing reduce; the key's first record passes through
    unchanged, later ones carry ``label(key)`` (or the row's ``label_col``) in
    ``field`` and the running sum in ``value``.  With ``step``: ``value``
    becomes ``acc = step(acc, v)`` from a copy of ``initial`` (an arbitrary
    Python fold, row by row)."""
    acc_type = df.schema[value].dataType if step is not None else result_type(df, F.sum(value))
    out = T.StructType([T.StructField(value, acc_type, True) if f.name == value else f for f in df.schema.fields])
    state = T.StructType([T.StructField("acc", acc_type, True), T.StructField("n", T.LongType(), False)])
    cols = df.columns

    def fold(key_value, rows, held):
        acc, n = held or (copy.deepcopy(initial), 0)
        results = []
        for r in rows:
            n += 1
            acc = _add(acc, r[value]) if step is None else step(acc, r[value])
            change = {value: acc}
            if step is None and n > 1:
                change[field] = r[label_col] if label_col else label(key_value)
            results.append(tuple((r | change)[c] for c in cols))
        return results, (acc, n)

    return _stateful(df, key, order, out, state, fold)
