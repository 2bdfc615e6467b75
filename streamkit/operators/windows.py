"""Keyed windows: W1-W11.

Bounded frames get the plans below; streaming frames get Spark's native
watermarked window / session aggregation, and count windows the stateful
twin in ``streamkit.streaming.stateful``.

Time windows are epoch-aligned ``[start, end)`` like ``F.window``.

* Tumbling: ``groupBy(key, window(t, size))`` with partial aggregation.
* Sliding: consecutive windows are taken ``BUCKET`` at a time, and one
  aggregation by (key, bucket) holds a partial for each window of the bucket, so
  partials are made before the only shuffle and a row is copied only where its
  windows cross into the next bucket.  Where a window has more than ``2 BUCKET``
  slides, or partials of no fixed width, rows are aggregated into *panes* of
  ``gcd(size, slide)`` and the pane partials expanded into the windows covering
  each pane and merged, by a second shuffle.  Spark's own sliding window expands
  every raw row instead.
* Count windows and sessions need the row's rank / predecessor within its
  key, which come from the skew-safe ``keyed_scan``.  Sliding count windows of
  ``LONG`` rows or more merge a suffix and a prefix aggregate of neighbouring
  stretches per row, whatever the size; shorter ones are frames.

Aggregates are given as ``Agg`` objects so each knows its pane partial and
its merge.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamkit.functions.time import instant_to_ntz, interval_micros, micros_between, ntz_micros
from streamkit.operators.keyed import KeySpec, fold_groups, resolve_keys
from streamkit.operators.scan import BLK, KEY, Scan, keyed_scan, plan_blocks, with_blocks


@dataclass
class Agg:
    """A window aggregate.

    kind: ``sum`` | ``count`` | ``max`` | ``min`` | ``max_by`` | ``min_by`` |
    ``concat`` | ``fold``.  ``max_by`` / ``min_by`` give ``col`` (a struct is a
    whole record) of the row with the extreme ``by``; the first in ``order``
    (numbers) wins ties, and rows whose ``by`` is null are never the extreme.
    ``concat`` joins ``col`` strings in ``order`` (list of column names)
    with ``sep``.  ``fold`` is ``initial + sum(col)``.
    """

    kind: str
    col: Column | None
    name: str
    order: Sequence[str] = ()
    sep: str = ""
    initial: object = 0
    by: Column | None = None

    def raw(self, c: Column | None, order: list[Column]) -> Column:
        """The plain aggregate of ``c`` (also a window function)."""
        if self.kind in ("sum", "fold"):
            return F.sum(c)
        if self.kind == "count":
            return F.count(c if c is not None else F.lit(1))
        if self.kind in ("max", "max_by"):
            return F.max(c)
        if self.kind in ("min", "min_by"):
            return F.min(c)
        if self.kind == "concat":
            return F.collect_list(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], c.alias("_v")))
        raise ValueError(f"unknown aggregate kind {self.kind!r}")

    @property
    def input(self) -> Column | None:
        """What is aggregated: for ``max_by`` / ``min_by`` the record behind
        its measure and the order that breaks ties, null where the measure is."""
        if self.kind not in ("max_by", "min_by"):
            return self.col
        ties = [(-F.col(o) if self.kind == "max_by" else F.col(o)).alias(f"_o{i}") for i, o in enumerate(self.order)]
        return F.when(self.by.isNotNull(), F.struct(self.by.alias("_by"), *ties, self.col.alias("_r")))

    def finish(self, x: Column) -> Column:
        if self.kind == "fold":
            return F.lit(self.initial) + F.coalesce(x, F.lit(0))
        if self.kind == "concat":
            return F.array_join(F.transform(F.array_sort(x), lambda v: v["_v"]), self.sep)
        return x["_r"] if self.kind in ("max_by", "min_by") else x

    def direct(self) -> Column:
        return self.finish(self.raw(self.input, [F.col(o) for o in self.order])).alias(self.name)

    def over(self, window: Window) -> Column:
        return self.finish(self.raw(self.input, [F.col(o) for o in self.order]).over(window)).alias(self.name)

    def join(self, before: Column, after: Column) -> Column:
        """Plain aggregates of two neighbouring runs of rows, either null if it
        has no rows, as that of both."""
        if self.kind == "count":
            return F.coalesce(before, F.lit(0)) + F.coalesce(after, F.lit(0))
        if self.kind in ("sum", "fold"):
            return F.when(before.isNull(), after).when(after.isNull(), before).otherwise(before + after)
        return (F.greatest if self.kind in ("max", "max_by") else F.least)(before, after)

    def partial(self) -> Column:
        """What panes and local sessions hand on."""
        x = self.raw(self.input, [F.col(o) for o in self.order])
        return (self.finish(x) if self.kind == "concat" else x).alias(f"_pp_{self.name}")

    def merge(self, part_order: Column) -> Column:
        p = F.col(f"_pp_{self.name}")
        if self.kind == "count":
            return F.sum(p).alias(self.name)
        return self.finish(self.raw(p, [part_order])).alias(self.name)


def _micros(df: DataFrame, name: str) -> Column:
    return ntz_micros(name) if isinstance(df.schema[name].dataType, T.TimestampNTZType) else F.unix_micros(F.col(name))


def _times(df: DataFrame, ntz: bool, **micros: Column) -> DataFrame:
    """Time columns from microseconds, of the input's timestamp type."""
    for name, m in micros.items():
        df = df.withColumn(name, F.timestamp_micros(m))
        if ntz:
            df = df.withColumn(name, instant_to_ntz(name))
    return df


def time_window(
    df: DataFrame,
    key: KeySpec | Sequence[KeySpec] | None,
    time_col: str,
    size,
    aggs: Sequence[Agg],
    slide=None,
    panes: bool = True,
) -> DataFrame:
    """Tumbling (``slide`` None or equal to ``size``) or sliding time windows.

    Output: key columns, ``window_start``, ``window_end``, one column per agg.
    ``key=None`` is the global window (one group per window; partial
    aggregation keeps it parallel up to the final merge).
    """
    df, keys, _ = resolve_keys(df, key)
    size_us = interval_micros(size)
    slide_us = interval_micros(slide) if slide is not None else size_us
    if df.isStreaming:
        # One native window aggregation: a single stateful operator, so
        # watermark lateness applies once (see streamkit.streaming).
        if slide_us > size_us:
            raise ValueError("on a stream the slide may not exceed the size")
        w = F.window(time_col, f"{size_us} microseconds", f"{slide_us} microseconds")
        out = df.groupBy(*keys, w.alias("_w")).agg(*[a.direct() for a in aggs])
        return out.select(*keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                          *[a.name for a in aggs])
    # Windows are numbered: window k covers [k slide, k slide + size).  A row,
    # or a pane, is in windows ceil((t + 1 - size) / slide) .. floor(t / slide).
    ntz = isinstance(df.schema[time_col].dataType, T.TimestampNTZType)
    at = df.where(F.col(time_col).isNotNull()).withColumn("_at", _micros(df, time_col))
    by_pane = panes and slide_us < size_us
    if by_pane and _bucketed(df, size_us, slide_us, aggs):
        out = _bucket_windows(at, keys, size_us, slide_us, aggs)
        out = _times(out, ntz, window_start=F.col("_k") * slide_us, window_end=F.col("_k") * slide_us + size_us)
        return out.select(*keys, "window_start", "window_end", *[a.name for a in aggs])
    if by_pane:
        pane_us = math.gcd(size_us, slide_us)
        at = at.withColumn("_at", _floor(F.col("_at"), pane_us) * pane_us)
        at = at.groupBy(*keys, "_at").agg(*[a.partial() for a in aggs])
    last = _floor(F.col("_at"), slide_us)
    first = _floor(F.col("_at") - size_us, slide_us) + 1
    if slide_us == size_us:
        at = at.withColumn("_k", last)
    else:
        at = at.where(first <= last).withColumn("_k", F.explode(F.sequence(first, last)))
    out = at.groupBy(*keys, "_k").agg(*[a.merge(F.col("_at")) if by_pane else a.direct() for a in aggs])
    out = _times(out, ntz, window_start=F.col("_k") * slide_us, window_end=F.col("_k") * slide_us + size_us)
    return out.select(*keys, "window_start", "window_end", *[a.name for a in aggs])


#: Consecutive sliding windows that one aggregation row holds.
BUCKET = 8
#: The most aggregates of sliding windows held that way.
HELD = 4


def _bucketed(df: DataFrame, size_us: int, slide_us: int, aggs: Sequence[Agg]) -> bool:
    """Whether partials are few and of fixed width, so that Spark hashes them."""
    if size_us > 2 * BUCKET * slide_us or len(aggs) > HELD:
        return False
    if any(a.kind not in ("sum", "count", "fold", "max", "min") for a in aggs):
        return False
    extremes = [a.col for a in aggs if a.kind in ("max", "min")]
    kinds = [f.dataType for f in df.select(*extremes).schema.fields] if extremes else []
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return all(isinstance(k, fixed) for k in kinds)


def _bucket_windows(at: DataFrame, keys: list[str], size_us: int, slide_us: int, aggs: Sequence[Agg]) -> DataFrame:
    """(keys, _k, aggregates) of sliding windows, by one aggregation of (keys,
    bucket)."""
    return _held_windows(_in_windows(at, size_us, slide_us), keys, aggs)


def _in_windows(at: DataFrame, size_us: int, slide_us: int) -> DataFrame:
    """The rows that are in windows, with the first and the last."""
    first, last = _floor(F.col("_at") - size_us, slide_us) + 1, _floor(F.col("_at"), slide_us)
    return at.withColumn("_first", first).withColumn("_last", last).where("_first <= _last")


def _held_windows(rows: DataFrame, keys: list[str], aggs: Sequence[Agg]) -> DataFrame:
    """(keys, _k, aggregates) of the windows ``_first`` to ``_last`` of rows: column
    i of an aggregate is that of the bucket's window i, and ``_in`` has the bits of
    the windows that hold a row."""
    lo, hi = _floor(F.col("_first"), BUCKET), _floor(F.col("_last"), BUCKET)
    rows = rows.withColumn("_b", F.explode(F.sequence(lo, hi)))
    own = F.col("_b") * BUCKET
    rows = rows.withColumn("_lo", F.greatest(F.col("_first") - own, F.lit(0))).withColumn("_hi", F.least(F.col("_last") - own, F.lit(BUCKET - 1)))
    inside = [F.col("_lo").__le__(i) & F.col("_hi").__ge__(i) for i in range(BUCKET)]

    def held(a: Agg, i: int) -> Column:
        value = a.col if a.col is not None else F.lit(1)
        return a.raw(F.when(inside[i], value), []).alias(f"_h_{i}_{a.name}")

    bits = F.bit_or(F.expr(f"shiftleft(1L, cast(_hi as int) + 1) - shiftleft(1L, cast(_lo as int))")).alias("_in")
    buckets = rows.groupBy(*keys, "_b").agg(bits, *[held(a, i) for a in aggs for i in range(BUCKET)])
    window = lambda i: F.struct((F.col("_b") * BUCKET + i).alias("_k"), F.expr(f"(_in & {1 << i}) != 0").alias("_has"),
                                *[F.col(f"_h_{i}_{a.name}").alias(a.name) for a in aggs])
    each = buckets.select(*keys, F.explode(F.array(*[window(i) for i in range(BUCKET)])).alias("_w")).where("_w._has")
    return each.select(*keys, F.col("_w._k").alias("_k"), *[a.finish(F.col("_w")[a.name]).alias(a.name) for a in aggs])


#: Consecutive sliding windows whose rows ``element_windows`` keeps together, a multiple of BUCKET.
SPAN = 64
#: Bytes of values in one of its tasks on average, and in a span at most.
TASK, HOT = 4 << 20, 8 << 20


def element_windows(df: DataFrame, values: str, elements: Column, name: str, time_col: str, size, slide, aggs: Sequence[Agg]) -> DataFrame:
    """Sliding windows keyed by the ``elements`` (an array made of the string
    column ``values``), named ``name``, of a batch table: as ``time_window`` of the
    exploded rows, but what moves are the values, before they are taken apart.

    The rows of ``SPAN`` consecutive windows meet in one task, as many tasks as the
    values' bytes ask for, so that its aggregation fits memory whatever the table's
    size.  Spans of more than ``HOT`` bytes are aggregated by element instead."""
    size_us, slide_us = interval_micros(size), interval_micros(slide)
    exploded = lambda rows: rows.withColumn(name, F.explode(elements))
    if df.isStreaming or slide_us >= size_us or not _bucketed(df, size_us, slide_us, aggs):
        return time_window(exploded(df), name, time_col, size, aggs, slide=slide)
    ntz = isinstance(df.schema[time_col].dataType, T.TimestampNTZType)
    at = df.where(F.col(time_col).isNotNull()).withColumn("_at", _micros(df, time_col))
    rows = _in_windows(at, size_us, slide_us)
    rows = rows.withColumn("_c", F.explode(F.sequence(_floor(F.col("_first"), SPAN), _floor(F.col("_last"), SPAN))))
    own = F.col("_c") * SPAN
    rows = rows.withColumn("_first", F.greatest("_first", own)).withColumn("_last", F.least(F.col("_last"), own + (SPAN - 1)))
    bytes_of = rows.groupBy("_c").agg(F.sum(F.octet_length(values)).alias("n"))
    total, hot = bytes_of.agg(F.sum("n"), F.collect_list(F.when(F.col("n") > HOT, F.col("_c")))).first()
    calm = rows.where(~F.col("_c").isin(hot)) if hot else rows
    calm = calm.repartition(-(-(total or 1) // TASK), "_c").sortWithinPartitions("_c", "_first")
    out = _held_windows(exploded(calm), ["_c", name], aggs).drop("_c")
    if hot:
        out = out.unionByName(_held_windows(exploded(rows.where(F.col("_c").isin(hot))), [name], aggs))
    out = _times(out, ntz, window_start=F.col("_k") * slide_us, window_end=F.col("_k") * slide_us + size_us)
    return out.select(name, "window_start", "window_end", *[a.name for a in aggs])


def _floor(micros: Column, unit: int) -> Column:
    """Floor division of a long, exact also for negative values."""
    return ((micros - F.pmod(micros, F.lit(unit).cast("long"))) / unit).cast("long")


def time_window_fold(df: DataFrame, key, time_col: str, size, order: Sequence[str], step: Callable, schema: str, initial=None) -> DataFrame:
    """W4 in general: an arbitrary Python reduce (``initial`` None: the first
    record starts it) or fold over the records of each tumbling window, in
    ``order``.  See ``fold_groups``."""
    columns = df.columns
    df, keys, _ = resolve_keys(df, key)
    size_us, ntz = interval_micros(size), isinstance(df.schema[time_col].dataType, T.TimestampNTZType)
    at = df.where(F.col(time_col).isNotNull()).withColumn("_k", _floor(_micros(df, time_col), size_us))
    out = fold_groups(at.select(*dict.fromkeys([*keys, *columns]), "_k"), [*keys, "_k"], order, step, schema, initial, every=False)
    out = _times(out, ntz, window_start=F.col("_k") * size_us, window_end=(F.col("_k") + 1) * size_us)
    return out.drop("_k")


def count_window_fold(df: DataFrame, key, order: Sequence[str], size: int, step: Callable, schema: str, initial=None) -> DataFrame:
    """W6 in general: the same over every ``size`` consecutive records of a
    key; an incomplete last group is never emitted."""
    df, keys, _ = resolve_keys(df, key)
    ranked = keyed_scan(df, keys, list(order), [Scan("count", None, "_rn")])
    grouped = ranked.withColumn("window_end_count", (F.floor((F.col("_rn") - 1) / size) + 1) * size)
    whole = Window.partitionBy(*keys, "window_end_count")
    full = grouped.withColumn("_n", F.count(F.lit(1)).over(whole)).where(F.col("_n") == size).drop("_n", "_rn")
    return fold_groups(full, [*keys, "window_end_count"], order, step, schema, initial, every=False)


def count_window(
    df: DataFrame,
    key: KeySpec | Sequence[KeySpec],
    order: str | Sequence[str],
    size: int,
    aggs: Sequence[Agg],
    slide: int | None = None,
    blocks: int | None = None,
    state=None,
) -> DataFrame:
    """Count windows per key.

    Tumbling (``slide`` None): consecutive groups of ``size`` rows; an
    incomplete last group is never emitted.  Sliding: fires after every
    ``slide``-th row of the key, over its last ``<= size`` rows.

    Output: key columns, ``window_end_count`` (rank of the firing row within
    the key), one column per agg.

    ``state`` goes on from earlier micro-batches of a stream: a key's rank, and
    the rows, fewer than ``size``, that later windows still need.
    """
    df, keys, _ = resolve_keys(df, key)
    orders = [order] if isinstance(order, str) else list(order)
    if df.isStreaming:
        if len(keys) != 1 or len(orders) != 1 or len(aggs) != 1 or aggs[0].kind not in (
                "sum", "count", "fold", "max", "min"):
            raise ValueError("count windows on a stream take one key, one order column and one "
                             "sum / count / fold / max / min")
        from streamkit.streaming.stateful import count_window_stream

        agg = aggs[0]
        staged = df.withColumn("_cw_v", agg.col if agg.col is not None else F.lit(1))
        return count_window_stream(staged, keys[0], orders[0], "_cw_v", size, slide, name=agg.name, kind=agg.kind,
                                   initial=agg.initial)
    ranked = keyed_scan(df, keys, orders, [Scan("count", None, "_rn")], blocks=blocks, state=state)
    fires = F.col("_rn") % (slide or size) == 0
    if state is not None:
        ranked, fires = _with_tails(ranked, keys, size, slide, state.table("tails")), fires & F.col("_new")
    if slide is None:
        grp = F.floor((F.col("_rn") - 1) / size).cast("long")
        out = (
            ranked.groupBy(*keys, grp.alias("_g"))
            .agg(F.count(F.lit(1)).alias("_n"), *[a.direct() for a in aggs])
            .where(F.col("_n") == size)
        )
        return out.select(*keys, ((F.col("_g") + 1) * size).alias("window_end_count"), *[a.name for a in aggs])
    # Stretches of the key's rows, each with the size - 1 rows before it: the
    # windows are frames over a stretch, whatever the aggregate, and a row is
    # copied once at most.
    stretch = max(8 * size, STRETCH)
    own = F.floor((F.col("_rn") - 1) / stretch).cast("long")
    after = F.when(F.pmod(F.col("_rn") - 1, F.lit(stretch).cast("long")) >= stretch - (size - 1), F.array(own, own + 1)).otherwise(F.array(own))
    copied = ranked.withColumn("_own", own).withColumn("_stretch", F.explode(after))
    if size >= LONG and all(a.kind != "concat" for a in aggs):
        return _long_windows(copied, keys, size, fires, aggs)
    frame = Window.partitionBy(*keys, "_stretch").orderBy("_rn").rowsBetween(-(size - 1), Window.currentRow)
    out = copied.select(*keys, "_rn", "_own", "_stretch", fires.alias("_fires"), *[a.over(frame) for a in aggs])
    return (out.where((F.col("_own") == F.col("_stretch")) & F.col("_fires"))
            .select(*keys, F.col("_rn").alias("window_end_count"), *[a.name for a in aggs]))


def _long_windows(copied: DataFrame, keys: list[str], size: int, fires: Column, aggs: Sequence[Agg]) -> DataFrame:
    """Sliding count windows without a frame per row.  A key's rows are cut
    after every ``size``-th: the window that ends at a row is the end of the cut
    before, from ``size - 1`` rows back, and the own cut up to the row.  Both
    are running aggregates, one towards each side; a row merges two values."""
    cut = F.floor((F.col("_rn") - 1) / size).cast("long")
    values = [(a.input if a.input is not None else F.lit(1)).alias(f"_v{i}") for i, a in enumerate(aggs)]
    rows = copied.select(*keys, "_rn", "_own", "_stretch", cut.alias("_cut"), fires.alias("_fires"), *values).repartition(*keys, "_stretch")
    within = Window.partitionBy(*keys, "_stretch", "_cut")
    upto = Window.unboundedPreceding, Window.currentRow
    back, ahead = within.orderBy(F.desc("_rn")).rowsBetween(*upto), within.orderBy("_rn").rowsBetween(*upto)
    along = Window.partitionBy(*keys, "_stretch").orderBy("_cut", "_rn")
    rows = rows.select("*", *[a.raw(F.col(f"_v{i}"), []).over(back).alias(f"_s{i}") for i, a in enumerate(aggs)])
    rows = rows.select("*", *[a.raw(F.col(f"_v{i}"), []).over(ahead).alias(f"_p{i}") for i, a in enumerate(aggs)])
    rows = rows.select("*", *[F.lag(f"_s{i}", size - 1).over(along).alias(f"_b{i}") for i in range(len(aggs))])
    whole = F.pmod(F.col("_rn"), F.lit(size).cast("long")) == 0  # the own cut alone
    out = rows.where((F.col("_own") == F.col("_stretch")) & F.col("_fires"))
    joined = lambda i, a: F.when(whole, F.col(f"_p{i}")).otherwise(a.join(F.col(f"_b{i}"), F.col(f"_p{i}")))
    return out.select(*keys, F.col("_rn").alias("window_end_count"), *[a.finish(joined(i, a)).alias(a.name) for i, a in enumerate(aggs)])


def _with_tails(ranked: DataFrame, keys: list[str], size: int, slide: int | None, table) -> DataFrame:
    """``ranked`` and the rows that earlier micro-batches left of its keys
    (``_new`` is false), and what this one leaves put in their place."""
    columns = ranked.columns
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("all"))
    rows = ranked.select(key.alias(KEY), *columns, F.lit(True).alias("_new"))
    held = table.newest()
    if held is not None:
        old = held.join(rows.select(KEY).distinct(), KEY, "left_semi").select(KEY, F.explode("tail").alias("_t"))
        rows = rows.unionByName(old.select(KEY, *[F.col("_t")[c].alias(c) for c in columns], F.lit(False).alias("_new")))
    upto = rows.groupBy(KEY).agg(F.max("_rn").alias("_upto"))
    after = F.col("_upto") - (size - 1) if slide is not None else F.col("_upto") - F.pmod("_upto", F.lit(size).cast("long"))
    # a key whose rows are all used up keeps an empty tail
    tail = F.when(F.col("_rn") > after, F.struct(F.col("_rn"), *[F.col(c) for c in columns if c != "_rn"]))
    table.put(rows.join(upto, KEY).groupBy(KEY).agg(F.array_sort(F.collect_list(tail)).alias("tail")))
    return rows.drop(KEY)


#: The least rows of a key that sliding count windows keep together.
STRETCH = 4096
#: The least size of sliding count windows made from suffixes and prefixes.
LONG = 256


def session_window(
    df: DataFrame,
    key: KeySpec | Sequence[KeySpec],
    time_col: str,
    gap,
    aggs: Sequence[Agg],
    tiebreak: Sequence[str] = (),
    blocks: int | None = None,
) -> DataFrame:
    """Sessions per key (W10): a row starts a new session when it follows the
    key's previous row by more than ``gap`` (a gap of exactly ``gap`` merges).

    Output: key columns, ``session_start``, ``session_end`` (last row + gap),
    one column per agg.  Rows without a time are in no session.

    A key's rows are cut into blocks (see ``streamkit.operators.scan``) and
    shuffled once.  Each block is aggregated to its local sessions; only the
    first and last of a block can go on in a neighbour, so only those, two per
    key and block at most, are merged along the key.
    """
    df, keys, _ = resolve_keys(df, key)
    gap_us = interval_micros(gap)
    order = [time_col, *tiebreak]
    if df.isStreaming:
        sw = F.session_window(time_col, f"{gap_us} microseconds")
        out = df.groupBy(*keys, sw.alias("_s")).agg(*[a.direct() for a in aggs])
        return out.select(*keys, F.col("_s.start").alias("session_start"), F.col("_s.end").alias("session_end"),
                          *[a.name for a in aggs])
    ntz = isinstance(df.schema[time_col].dataType, T.TimestampNTZType)
    df = df.where(F.col(time_col).isNotNull())
    rows = with_blocks(df, plan_blocks(df, keys, order, blocks)).withColumn("_at", _micros(df, time_col))
    inside = Window.partitionBy(KEY, BLK).orderBy(*[F.col(o) for o in order])
    before = F.lag("_at").over(inside)
    rows = rows.withColumn("_new", F.when(before.isNull() | (F.col("_at") - before > gap_us), F.col("_at")))
    rows = rows.withColumn("_from", F.max("_new").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    local = rows.groupBy(KEY, BLK, "_from").agg(F.max("_at").alias("_to"), *[a.partial() for a in aggs])
    block = Window.partitionBy(KEY, BLK)
    local = local.withColumn("_edge", (F.col("_from") == F.min("_from").over(block)) | (F.col("_from") == F.max("_from").over(block)))
    along = Window.partitionBy(KEY).orderBy("_from", BLK)
    edges = local.where("_edge").withColumn("_before", F.max("_to").over(along.rowsBetween(Window.unboundedPreceding, -1)))
    edges = edges.withColumn("_new", F.when(F.col("_before").isNull() | (F.col("_from") - F.col("_before") > gap_us), F.col("_from")))
    edges = edges.withColumn("_session", F.max("_new").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = local.where("not _edge").withColumn("_session", F.col("_from")).select(KEY, BLK, "_session", "_from", "_to", *[f"_pp_{a.name}" for a in aggs])
    every = whole.unionByName(edges.select(*whole.columns))
    out = every.groupBy(KEY, "_session").agg(F.max("_to").alias("_to"), *[a.merge(F.struct("_from", BLK)) for a in aggs])
    out = _times(out, ntz, session_start=F.col("_session"), session_end=F.col("_to") + gap_us)
    return out.select(*[F.col(KEY)[k].alias(k) for k in keys], "session_start", "session_end", *[a.name for a in aggs])
