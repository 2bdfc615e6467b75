"""Mergeable user aggregates: an arbitrary Python reduce or fold that scales
(R6, U3, W4-W6 in general).

``fold_groups`` walks a group's records with one accumulator, in one task.  A
``Monoid`` also says how two accumulators over neighbouring stretches merge, so
a group may be cut: its order is cut into blocks as in ``streamkit.operators.scan``,
each (group, block) is folded from ``zero`` by a task of its own, and only one
state per (group, block) is merged along the group, in order.  ``merge`` has to be
associative, and ``add(merge(a, b), r)`` the same as ``merge(a, add(b, r))``; it need
not be commutative.

* ``reduce_monoid``: one result per group;
* ``time_window_monoid``: one per tumbling or sliding window, over panes;
* ``count_window_monoid``: one per ``size`` consecutive records of a key;
* ``rolling_monoid``: one per record, the running value: states of blocks are
  merged to the exclusive prefix of each block, which its walk starts from.

The rows of a group move once, to their (group, block) task, which holds one
accumulator and an Arrow batch.  States travel as Arrow structs of the type
that the monoid names (``binary`` holds whatever Python can serialise).
"""

from __future__ import annotations

import copy
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from streamkit.functions.time import interval_micros
from streamkit.operators.keyed import KeySpec, resolve_keys
from streamkit.operators.scan import BLK, KEY, Scan, keyed_scan, plan_blocks, with_blocks
from streamkit.operators.windows import _floor, _micros, _times
from streamkit.session import ship_package

_ROW, _STATE, _FIRST, _LAST = "_mo_row", "_mo_state", "_mo_first", "_mo_last"


@dataclass
class Monoid:
    """A mergeable aggregate over records (dicts of exact Python values).

    ``state`` and ``result`` are DDL schemas of the dicts that ``add`` / ``merge``
    and ``finish`` give.  ``zero`` is the state of no records; every walk starts
    from a copy of it.  Without ``finish`` the result's fields are the state's.
    """

    zero: dict
    add: Callable[[dict, dict], dict]
    merge: Callable[[dict, dict], dict]
    state: str
    result: str | None = None
    finish: Callable[[dict], dict] | None = None

    def __post_init__(self):
        self.result = self.result or self.state

    def start(self) -> dict:
        return copy.deepcopy(self.zero)

    def done(self, state: dict) -> dict:
        return copy.deepcopy(state) if self.finish is None else self.finish(copy.deepcopy(state))

    @property
    def fields(self) -> T.StructType:
        return T.StructType.fromDDL(self.state)


def _walk(df: DataFrame, groups: Sequence[str], order: Sequence[Column], schema: T.StructType, make: Callable[[], Callable[[dict], dict | None]]) -> DataFrame:
    """Rows of ``df`` by group and order, each with whether it is the group's
    first and last, through the function that ``make`` gives to a task."""
    ship_package(df.sparkSession)
    by = Window.partitionBy(*groups).orderBy(*order)
    marked = df.withColumn(_FIRST, F.row_number().over(by) == 1).withColumn(_LAST, F.lead(F.lit(1)).over(by).isNull())
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            out = [r for record in batch.to_pylist() if (r := step(record)) is not None]
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return marked.mapInArrow(run, schema)


def _block_states(rows: DataFrame, order: Sequence[str], monoid: Monoid) -> DataFrame:
    """(KEY, BLK, state): each block of each group folded from zero.  ``rows``
    are (KEY, BLK, row struct)."""
    schema = T.StructType([rows.schema[KEY], T.StructField(BLK, T.LongType()), T.StructField(_STATE, monoid.fields)])

    def make():
        acc = None

        def step(record: dict) -> dict | None:
            nonlocal acc
            acc = monoid.add(monoid.start() if record[_FIRST] else acc, record[_ROW])
            return {KEY: record[KEY], BLK: record[BLK], _STATE: copy.deepcopy(acc)} if record[_LAST] else None

        return step

    return _walk(rows, [KEY, BLK], [F.col(_ROW)[o] for o in order], schema, make)


def _merged(states: DataFrame, monoid: Monoid, along: str = BLK) -> DataFrame:
    """(KEY, result): the states of each group merged in the order of ``along``."""
    schema = T.StructType([states.schema[KEY], T.StructField(_STATE, T.StructType.fromDDL(monoid.result))])

    def make():
        acc = None

        def step(record: dict) -> dict | None:
            nonlocal acc
            acc = record[_STATE] if record[_FIRST] else monoid.merge(acc, record[_STATE])
            return {KEY: record[KEY], _STATE: monoid.done(acc)} if record[_LAST] else None

        return step

    return _walk(states.select(KEY, along, _STATE), [KEY], [F.col(along)], schema, make)


def _prefixes(states: DataFrame, monoid: Monoid) -> DataFrame:
    """(KEY, BLK, state): what the group's earlier blocks amount to."""
    schema = states.schema

    def make():
        acc = None

        def step(record: dict) -> dict:
            nonlocal acc
            before = monoid.start() if record[_FIRST] else acc
            acc = monoid.merge(copy.deepcopy(before), record[_STATE])
            return {KEY: record[KEY], BLK: record[BLK], _STATE: before}

        return step

    return _walk(states, [KEY], [F.col(BLK)], schema, make)


def _blocked(df: DataFrame, groups: Sequence[str], order: Sequence[str], blocks: int | None) -> DataFrame:
    """(KEY, BLK, row), dealt by (KEY, BLK)."""
    columns = df.columns
    rows = with_blocks(df, plan_blocks(df, groups, order, blocks))
    return rows.select(KEY, F.col(BLK).cast("long").alias(BLK), F.struct(*[F.col(f"`{c}`") for c in columns]).alias(_ROW))


def _unpacked(out: DataFrame, groups: Sequence[str]) -> DataFrame:
    fields = out.schema[_STATE].dataType.names
    return out.select(*[F.col(KEY)[g].alias(g) for g in groups], *[F.col(_STATE)[f].alias(f) for f in fields])


def reduce_monoid(df: DataFrame, groups: Sequence[str], order: Sequence[str], monoid: Monoid, blocks: int | None = None) -> DataFrame:
    """The groups' columns and the monoid's result over each group's records
    in ``order`` (a total order within the group; null groups are a group)."""
    groups, order = list(groups), list(order)
    return _unpacked(_merged(_block_states(_blocked(df, groups, order, blocks), order, monoid), monoid), groups)


def rolling_monoid(df: DataFrame, key: KeySpec | Sequence[KeySpec] | None, order: str | Sequence[str], monoid: Monoid, blocks: int | None = None) -> DataFrame:
    """``df`` and the monoid's result over the key's records up to and
    including each."""
    columns, order = df.columns, [order] if isinstance(order, str) else list(order)
    df, keys, _ = resolve_keys(df, key, "_key")
    rows = _blocked(df, keys, order, blocks)
    before = _prefixes(_block_states(rows, order, monoid), monoid)
    by = Window.partitionBy(KEY, BLK).orderBy(*[F.col(_ROW)[o] for o in order])
    # the state goes with the first row of its block only
    started = rows.join(before, [KEY, BLK]).withColumn(_STATE, F.when(F.row_number().over(by) == 1, F.col(_STATE)))
    result = T.StructType.fromDDL(monoid.result)
    schema = T.StructType([rows.schema[_ROW], T.StructField(_STATE, result)])

    def make():
        acc = None

        def step(record: dict) -> dict:
            nonlocal acc
            acc = monoid.add(record[_STATE] if record[_FIRST] else acc, record[_ROW])
            return {_ROW: record[_ROW], _STATE: monoid.done(acc)}

        return step

    out = _walk(started, [KEY, BLK], [F.col(_ROW)[o] for o in order], schema, make)
    return out.select(*[F.col(_ROW)[c].alias(c) for c in columns if c not in result.names], *[F.col(_STATE)[f].alias(f) for f in result.names])


def time_window_monoid(df: DataFrame, key: KeySpec | Sequence[KeySpec] | None, time_col: str, size, order: Sequence[str], monoid: Monoid, slide=None, blocks: int | None = None) -> DataFrame:
    """W2, W4, W5 in general: the monoid over the records of each tumbling or
    sliding window, in ``order`` (which begins with the time on sliding ones).
    Records are folded once, into panes; sliding windows merge pane states."""
    df, keys, _ = resolve_keys(df, key)
    size_us = interval_micros(size)
    slide_us = interval_micros(slide) if slide is not None else size_us
    if slide_us != size_us and order[0] != time_col:
        raise ValueError("sliding windows merge panes, so their order begins with the time")
    ntz = isinstance(df.schema[time_col].dataType, T.TimestampNTZType)
    pane_us = math.gcd(size_us, slide_us)
    at = df.where(F.col(time_col).isNotNull()).withColumn("_mo_at", _floor(_micros(df, time_col), pane_us) * pane_us)
    states = _block_states(_blocked(at, [*keys, "_mo_at"], order, blocks), order, monoid)
    pane = F.col(KEY)["_mo_at"]
    first, last = _floor(pane - size_us, slide_us) + 1, _floor(pane, slide_us)
    windows = states.where(first <= last).withColumn("_mo_k", F.explode(F.sequence(first, last)))
    whole = F.struct(*[F.col(KEY)[k].alias(k) for k in keys], F.col("_mo_k").alias("_mo_k"))
    merged = _merged(windows.select(whole.alias("_mo_w"), F.struct(pane.alias("at"), F.col(BLK).alias("block")).alias("_mo_along"), _STATE).withColumnRenamed("_mo_w", KEY), monoid, "_mo_along")
    out = _unpacked(merged, [*keys, "_mo_k"])
    out = _times(out, ntz, window_start=F.col("_mo_k") * slide_us, window_end=F.col("_mo_k") * slide_us + size_us)
    return out.select(*keys, "window_start", "window_end", *T.StructType.fromDDL(monoid.result).names)


def count_window_monoid(df: DataFrame, key: KeySpec | Sequence[KeySpec], order: str | Sequence[str], size: int, monoid: Monoid, blocks: int | None = None) -> DataFrame:
    """W6 in general: the monoid over every ``size`` consecutive records of a
    key; an incomplete last group is never emitted."""
    df, keys, _ = resolve_keys(df, key)
    order = [order] if isinstance(order, str) else list(order)
    ranked = keyed_scan(df, keys, order, [Scan("count", None, "_mo_rn")], blocks=blocks)
    grouped = ranked.withColumn("window_end_count", (F.floor((F.col("_mo_rn") - 1) / size) + 1).cast("long") * size)
    counted = Monoid({"n": 0, "s": monoid.start()}, lambda a, r: {"n": a["n"] + 1, "s": monoid.add(a["s"], r)},
                     lambda a, b: {"n": a["n"] + b["n"], "s": monoid.merge(a["s"], b["s"])},
                     f"n long, s struct<{_nested(monoid.state)}>", f"n long, s struct<{_nested(monoid.result)}>", lambda a: {"n": a["n"], "s": monoid.done(a["s"])})
    out = reduce_monoid(grouped, [*keys, "window_end_count"], ["_mo_rn"], counted, blocks).where(F.col("n") == size)
    return out.select(*keys, "window_end_count", *[F.col("s")[f].alias(f) for f in T.StructType.fromDDL(monoid.result).names])


def _nested(ddl: str) -> str:
    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in T.StructType.fromDDL(ddl))
