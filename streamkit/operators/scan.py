"""Skew-safe keyed prefix scan.

A per-key running value (running sum, count, extremum, first value, previous
row) is a window function ``partitionBy(key).orderBy(order)``.  That puts every
row of a key into one task: with a key holding a third of all rows, one task
sorts a third of the data.  The scan instead cuts the *order* into blocks, the
same for every key:

1. ``plan_blocks`` takes the cut points, one per shuffle partition.  Where the
   first order column that is not constant is a number or time and no value of
   it holds a whole block, they are its approximate quantiles over all rows, a
   list of doubles.  Any other order (strings, a value or nulls that fill
   blocks, ties of several columns) is cut at whole order tuples, as a range
   partitioner does: a sample of ``SAMPLE`` rows a block is sorted by Spark and
   every ``SAMPLE``-th tuple is a cut.
2. ``with_blocks`` finds each row's block by binary search.  The block is a
   monotone function of the order, so the rows of a key in one block are a
   contiguous run of the key, and a key with all rows fills all partitions.
   The sample decides the balance of the blocks only, never a result.
3. ``blocked_scan`` computes the running value inside (key, block), and adds
   the exclusive prefix over the key's earlier blocks, a window over a table of
   one row per key and block.

There is one path for all keys and sizes, so an answer does not depend on how
many rows a key has.  The rows are shuffled once, on (key, block); the totals
are aggregated per task before they move; nothing is broadcast by hint.  Nulls
are what they are for Spark's window functions: sums and extrema skip them,
null orders come first, null keys are a key.  Sums of doubles may differ from
a plain window in the last digits, as the blocks are added up separately.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamkit.functions.time import ntz_micros

KEY = "_sk_key"
BLK = "_sk_blk"
ROW = "_sk_row"
#: Sampled rows a block for cut points that are order tuples (all of them come to the driver).
SAMPLE = 30
#: Characters or bytes kept of a string in a cut point (a shorter one is a cut as well).
STRING = 1_024


@dataclass
class Scan:
    """One running value.

    kind: ``sum`` | ``count`` | ``max`` | ``min`` | ``first`` | ``prev``.
    ``col`` is a column name or Column (None for ``count`` = count rows).
    ``max``/``min`` accept struct columns (whole-record extremum).
    ``prev`` is the previous row's value within the key (``lag 1``).
    """

    kind: str
    col: Column | str | None
    name: str
    _t: str = field(init=False)
    _p: str = field(init=False)
    _l: str = field(init=False)

    def __post_init__(self):
        if self.kind not in {"sum", "count", "max", "min", "first", "prev"}:
            raise ValueError(f"unknown scan kind {self.kind!r}")
        self._t, self._p, self._l = (f"_sk_{x}_{self.name}" for x in "tpl")

    @property
    def c(self) -> Column:
        if self.col is None:
            return F.lit(1)
        return F.col(self.col) if isinstance(self.col, str) else self.col

    def local(self, w_frame: Window, w_order: Window) -> Column:
        """The running value inside a block."""
        if self.kind == "prev":
            return F.lag(self.c, 1).over(w_order)
        if self.kind == "first":
            return F.first(self.c, ignorenulls=False).over(w_frame)
        return getattr(F, self.kind)(self.c).over(w_frame)

    def total(self, order: Column) -> Column:
        """What a block hands to the later ones."""
        if self.kind == "first":
            return F.min_by(F.struct(self.c.alias("v")), order)["v"].alias(self._t)
        if self.kind == "prev":
            return F.max_by(F.struct(self.c.alias("v")), order)["v"].alias(self._t)
        return getattr(F, self.kind)(self.c).alias(self._t)

    def merged(self) -> Column:
        """The totals of all of a key's blocks, as one."""
        t = F.col(self._t)
        if self.kind in ("first", "prev"):
            return (F.min_by if self.kind == "first" else F.max_by)(F.struct(t.alias("v")), F.col(BLK))["v"].alias(self._t)
        return {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}[self.kind](t).alias(self._t)

    def prefix(self, earlier: Window) -> Column:
        t = F.col(self._t)
        agg = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min, "first": F.first, "prev": F.last}[self.kind]
        return agg(t).over(earlier).alias(self._p)

    def combine(self, first_block: Column, first_row: Column) -> Column:
        p, local = F.col(self._p), F.col(self._l)
        if self.kind == "count":
            return F.coalesce(p, F.lit(0)) + local
        if self.kind == "sum":
            return F.when(p.isNull(), local).when(local.isNull(), p).otherwise(p + local)
        if self.kind in ("max", "min"):
            return (F.greatest if self.kind == "max" else F.least)(p, local)
        if self.kind == "first":
            return F.when(first_block, local).otherwise(p)
        return F.when(first_row, p).otherwise(local)


def _number(df: DataFrame, name: str) -> Column | None:
    """A monotone double image of a number or time column, else None."""
    dtype, c = df.schema[name].dataType, F.col(name)
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_micros(name).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("double")
    return None


def _comparable(df: DataFrame, name: str) -> Column | None:
    """An order column as a value that compares alike and that a literal can
    hold in every session time zone, else None."""
    dtype, c = df.schema[name].dataType, F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_micros(name)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    known = (T.NumericType, T.BooleanType, T.DateType, T.BinaryType)
    return c if isinstance(dtype, known) or dtype == T.StringType() else None


@dataclass
class Blocking:
    """Cut points: ``splits`` of ``image``, or ``cuts``, order tuples in their
    order, of the columns in ``row``."""

    keys: list[str]
    order: list[str]
    image: Column | None = None
    splits: list[float] = field(default_factory=list)
    row: Column | None = None
    cuts: list[Column] = field(default_factory=list)

    @property
    def blocked(self) -> bool:
        return len(self.splits) > 2 or bool(self.cuts)

    @property
    def n_blocks(self) -> int:
        return max(1, len(self.splits) - 1, len(self.cuts) + 1)


def _finite(values) -> list[float]:
    return [v for v in values or [] if v is not None and math.isfinite(v)]


def plan_blocks(df: DataFrame, keys, order, blocks: int | None = None) -> Blocking:
    """Cut points for about ``blocks`` blocks (default: one per shuffle
    partition; 1 gives the plain window)."""
    out = Blocking(list(keys), list(order))
    blocks = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if blocks < 2 or df.isStreaming:
        return out
    probs, accuracy = [i / blocks for i in range(1, blocks)], max(10_000, 20 * blocks)
    for at, name in enumerate(out.order):
        image = _number(df, name)
        if image is None:
            break
        found = df.select(image.alias("x")).agg(F.percentile_approx("x", probs, accuracy).alias("q"), F.count("x").alias("n"), F.count(F.lit(1)).alias("rows")).first()
        cuts, gone = _finite(found["q"]), (found["rows"] - found["n"]) * blocks > found["rows"]
        full = any(a == b for a, b in zip(cuts, cuts[1:]))
        if at + 1 < len(out.order):
            if cuts and cuts[0] == cuts[-1] and not gone:
                lo, hi = df.agg(F.min(name), F.max(name)).first()
                if lo == hi and found["n"] == found["rows"]:  # constant: the next column decides
                    continue
            if full or gone or not cuts:
                break
        edges = sorted({*cuts, *(math.nextafter(v, math.inf) for v, w in zip(cuts, cuts[1:]) if v == w)})
        out.image, out.splits = image, [-math.inf, *edges, math.inf]
        return out
    _cut_tuples(df, out, blocks)
    return out


def _cut_tuples(df: DataFrame, out: Blocking, blocks: int) -> None:
    """Cuts at order tuples, up to the first column that has no literal."""
    images = []
    for name in out.order:
        c = _comparable(df, name)
        if c is None:
            break
        images.append(c.alias(f"c{len(images)}"))
    if not images:
        return
    rows = df.select(*images)
    n = rows.count()
    if n > SAMPLE * blocks:
        rows = rows.sample(SAMPLE * blocks / n, seed=SAMPLE)
    kinds = [f.dataType for f in rows.schema.fields]
    short = [F.substring(f.name, 1, STRING).alias(f.name) if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.col(f.name) for f in rows.schema.fields]
    taken = [tuple(r) for r in rows.orderBy(*rows.columns).select(*short).collect()]
    places = sorted({len(taken) * i // blocks for i in range(1, blocks)} - {0})
    cuts = list(dict.fromkeys(tuple(bytes(v) if isinstance(v, bytearray) else v for v in taken[p]) for p in places))
    literal = lambda cut: F.struct(*[F.lit(v).cast(k).alias(f"c{i}") for i, (v, k) in enumerate(zip(cut, kinds))])
    out.row, out.cuts = F.struct(*images), [literal(cut) for cut in cuts]


def _tuple_block(cuts: list[Column]) -> Column:
    """1 and the number of cuts that are not after ``ROW``, by binary search."""
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    table = F.array(*cuts)

    def step(at: Column, width: Column) -> Column:
        probe = at + width
        return F.when((probe <= len(cuts)) & (F.get(table, probe - 1) <= F.col(ROW)), probe).otherwise(at)

    return (F.aggregate(F.array(*[F.lit(w) for w in steps]), F.lit(0), step) + 1).cast("long")


def _bucket(df: DataFrame, x: Column, splits: list[float], name: str) -> DataFrame:
    """Column ``name``: the number of the splits' interval that holds ``x``
    from 1 on; null is 0, NaN the last."""
    from pyspark.ml.feature import Bucketizer  # noqa: PLC0415  (a compiled binary search)

    df = df.withColumn("_sk_x", F.coalesce(x, F.lit(float("nan"))))
    df = Bucketizer(splits=splits, inputCol="_sk_x", outputCol="_sk_raw", handleInvalid="keep").transform(df)
    return df.withColumn(name, F.when(x.isNull(), F.lit(0)).otherwise(F.col("_sk_raw") + 1).cast("long")).drop("_sk_x", "_sk_raw")


def with_blocks(df: DataFrame, blocking: Blocking) -> DataFrame:
    """``df`` with the key as one struct (so null keys compare equal) and the
    block."""
    key = F.struct(*[F.col(k) for k in blocking.keys]) if blocking.keys else F.struct(F.lit(0).alias("all"))
    out = df.withColumn(KEY, key)
    if not blocking.blocked:
        return out.withColumn(BLK, F.lit(0).cast("long"))
    if blocking.cuts:
        return out.withColumn(ROW, blocking.row).withColumn(BLK, _tuple_block(blocking.cuts)).drop(ROW)
    return _bucket(out, blocking.image, blocking.splits, BLK)


def blocked_scan(df: DataFrame, blocking: Blocking, scans: list[Scan], state=None) -> DataFrame:
    """Scans over a frame prepared by ``with_blocks`` (keeps the helper columns).

    ``state`` (a ``streamkit.streaming.tables.StreamState``) goes on from
    earlier micro-batches: what they left of a key is a block before all others,
    and what this one leaves is put in its place."""
    order = [F.col(o) for o in blocking.order]
    w_order = Window.partitionBy(KEY, BLK).orderBy(*order)
    w_frame = w_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.select("*", *[s.local(w_frame, w_order).alias(s._l) for s in scans], (F.row_number().over(w_order) == 1).alias("_sk_first_row"))
    names = [c for c in df.columns]
    if not blocking.blocked and state is None:
        return local.select(*names, *[F.col(s._l).alias(s.name) for s in scans])
    totals = df.groupBy(KEY, BLK).agg(F.count(F.lit(1)).alias("_sk_n"), *[s.total(F.struct(*order)) for s in scans])
    if state is not None:
        totals = _with_earlier(totals, scans, state.table("scan"))
    by_key = Window.partitionBy(KEY).orderBy(BLK)
    earlier = by_key.rowsBetween(Window.unboundedPreceding, -1)
    prefix = totals.select(KEY, BLK, (F.row_number().over(by_key) == 1).alias("_sk_first_blk"), *[s.prefix(earlier) for s in scans])
    both = local.join(prefix, [KEY, BLK])
    return both.select(*names, *[s.combine(F.col("_sk_first_blk"), F.col("_sk_first_row")).alias(s.name) for s in scans])


def _with_earlier(totals: DataFrame, scans: list[Scan], table) -> DataFrame:
    """The block totals and, as block -1, what ``table`` holds of their keys;
    the merged totals go back into the table."""
    columns = [s._t for s in scans]
    before = table.newest()
    here = totals.select(KEY, F.col(BLK).cast("long").alias(BLK), *columns)
    if before is not None:
        here = here.unionByName(before.join(totals.select(KEY).distinct(), KEY, "left_semi").select(KEY, F.lit(-1).cast("long").alias(BLK), *columns))
    merged = here.groupBy(KEY).agg(*[s.merged() for s in scans])
    table.put(merged.select(KEY, *[F.col(c).cast(totals.schema[c].dataType).alias(c) for c in columns]))
    return here


def drop_blocks(df: DataFrame) -> DataFrame:
    return df.drop(KEY, BLK)


def keyed_scan(df: DataFrame, keys: list[str], order: list[str], scans: list[Scan], *, blocks: int | None = None, state=None) -> DataFrame:
    """``df`` plus one column per scan: the running value up to and including
    each row, within its key, in ``order`` (a total order within the key).
    ``blocks=1`` is the plain window; ``state`` goes on from earlier
    micro-batches (see ``blocked_scan``)."""
    blocking = plan_blocks(df, keys, order, blocks)
    return drop_blocks(blocked_scan(with_blocks(df, blocking), blocking, scans, state))
