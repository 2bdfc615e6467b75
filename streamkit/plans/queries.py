"""Registered queries: every operator run over whole driver tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame whose
columns match the DuckDB oracle in ``streamkit.plans.oracle``.

Adaptations of the original programs' inputs to the tables:
* two-token lines → ``part.p_name`` (e.g. ``small ring``);
* the word-count socket → ``documents.text``, arriving one document per
  second (``ts = doc_id`` seconds) for the windowed variant;
* keyed numeric streams → ``events`` ordered by ``event_id``, with money as
  integer cents so sums are exact;
* the contains-letter key → ``contains(event_type, 'c')`` (two keys, each
  holding ~half the rows: the hot-key case).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamkit.functions.growth import compound_growth
from streamkit.functions.text import cased_tokens, java_split, parse_key_int, text_lines
from streamkit.operators.keyed import (
    key_by,
    rolling_extreme,
    rolling_extreme_by,
    rolling_fold,
    rolling_reduce,
    rolling_sum,
)
from streamkit.operators.routing import connect, first_match_selector, select_outputs, split, union
from streamkit.operators.transform import flat_map, flat_map_python, word_count
from streamkit.operators.windows import Agg, count_window, count_window_fold, session_window, time_window, time_window_fold
from streamkit.plans.programs import windowed_word_count as word_count_windows
from streamkit.session import checkpoint_dir
from streamkit.sinks.files import write_delimited, write_text
from streamkit.sources.collection import generate_sequence
from streamkit.sources.text import read_file, read_text_file
from streamkit.sources.tables import ensure_parallelism, load_table

def _events(spark, sf_dir) -> DataFrame:
    ev = load_table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.round(F.col("value") * 100).cast("long").alias("cents"),
        F.col("event_type").contains("c").alias("has_c"),
    )


def _part_tokens(spark, sf_dir, spec) -> DataFrame:
    part = load_table(spark, sf_dir, "part")
    return flat_map(part, cased_tokens(F.col("p_name"), spec), name="token", keep=("p_partkey",))


UPPER_UPPER = ((0, "upper"), (1, "upper"))
UPPER_LOWER = ((0, "upper"), (1, "lower"))
SECOND_LOWER_FIRST_UPPER = ((1, "lower"), (0, "upper"))


# -- sources and projections ------------------------------------------------

def _order_key_range(spark, sf_dir) -> DataFrame:
    bounds = load_table(spark, sf_dir, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return generate_sequence(spark, bounds[0], bounds[1])


def sequence_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + P1: inclusive sequence over the order-key range, mapped to 2x."""
    return _order_key_range(spark, sf_dir).select("value", (F.lit(2) * F.col("value")).alias("doubled"))


def sequence_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + P2: map each number to the predicate ``x != 1``."""
    return _order_key_range(spark, sf_dir).select("value", (F.col("value") != 1).alias("keep"))


def token_case_flatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tokens per line, first UPPER, second lower."""
    return _part_tokens(spark, sf_dir, UPPER_LOWER)


def iterator_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + P1: the order-key range from Python iterators, a stretch of at most a
    million numbers in a task of its own, mapped to 2x."""
    from streamkit.sources import from_iterators

    lo, hi = load_table(spark, sf_dir, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    rows = 0 if lo is None else hi + 1 - lo
    parts = max(spark.sparkContext.defaultParallelism, -(-rows // 1_000_000))
    out = from_iterators(spark, lambda i, n: range((lo or 0) + rows * i // n, (lo or 0) + rows * (i + 1) // n), parts, element_type=int)
    return out.select("value", (F.lit(2) * F.col("value")).alias("doubled"))


def flat_map_in_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two tokens of a line, first UPPER, second lower, from a Python
    generator behind a table function."""
    def make():
        cases = (str.upper, str.lower)

        def body(row):
            for pos, (case, token) in enumerate(zip(cases, (row.p_name or "").split(" "))):
                yield pos, case(token)

        return body

    part = load_table(spark, sf_dir, "part")
    return flat_map_python(part, make, "pos int, token string", keep=("p_partkey",), reads=("p_name",))


def token_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 + P3: second token lower then first UPPER; keep tokens containing 'r'."""
    toks = _part_tokens(spark, sf_dir, SECOND_LOWER_FIRST_UPPER)
    return toks.where(F.col("token").contains("r"))


def word_count_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: split every whole text on single whitespace characters; count words."""
    docs = ensure_parallelism(load_table(spark, sf_dir, "documents").select("text"))
    return word_count(docs, "text")


def parse_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``"<type> <cents>"`` lines parsed to (key string, n int)."""
    ev = _events(spark, sf_dir)
    line = F.concat_ws(" ", "event_type", F.col("cents").cast("string"))
    key, n = parse_key_int(line)
    return ev.select("event_id", key.alias("key"), n.alias("n"))


def pair_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pair each text with its length."""
    docs = load_table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.length("text").alias("len"))


def csv_sink_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 + O4 record format: ``lower----UPPER`` per line."""
    part = load_table(spark, sf_dir, "part")
    line = F.concat_ws("----", F.lower("p_name"), F.upper("p_name"))
    return part.select("p_partkey", line.alias("line"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3/S4 line semantics on whole texts: each document split into its lines."""
    docs = load_table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(text_lines(F.col("text"))).alias("line_no", "line"))


def _sink_dir(spark, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "sink-results", f"{name}-{uuid.uuid4().hex[:12]}")


def text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3 + S4: part names written by the text sink (one element per line,
    refusing an existing target), then read back line by line."""
    path = _sink_dir(spark, "text")
    write_text(load_table(spark, sf_dir, "part").select(F.col("p_name").alias("value")), path)
    return read_text_file(spark, path, with_order=False)


def delimited_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O4 + S3: ``lower----size----UPPER`` records, the size null in every third,
    each followed by a blank line, read back through the explicit text input
    format with the same separator."""
    path = _sink_dir(spark, "delimited")
    part = load_table(spark, sf_dir, "part")
    write_delimited(part, path, [F.lower("p_name"), F.when(F.col("p_size") % 3 > 0, F.col("p_size")), F.upper("p_name")], row_delim="\n\n", field_delim="----")
    return read_file(spark, path, line_sep="\n\n").select("value")


def output_format_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names through an output format that commits all tasks at once,
    read back from the committed parts."""
    from streamkit.sinks import read_committed, write_transactional

    path = _sink_dir(spark, "format")
    write_transactional(load_table(spark, sf_dir, "part").select("p_name"), path)
    return read_committed(spark, path).select("value")


# -- keying and rolling aggregates -------------------------------------------

def key_by_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: UPPER tokens keyed by ``contains('L')``; printed unaggregated."""
    toks = _part_tokens(spark, sf_dir, UPPER_UPPER)
    return key_by(toks, F.col("token").contains("L"), "key")


def rolling_sum_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running sum of cents per key; event_type stays the first record's."""
    ev = _events(spark, sf_dir).select("event_id", "has_c", "event_type", "cents")
    return rolling_sum(ev, "has_c", "event_id", "cents", carry=["event_type"])


def rolling_sum_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 + R1: a constant key (one global group holding every row, the
    extreme hot key) with a running sum of cents in event order.  A constant
    key is no key: the scan runs over one group, split into blocks."""
    ev = _events(spark, sf_dir).select("event_id", "cents")
    out = rolling_sum(ev, [], "event_id", "cents", name="running_cents")
    return key_by(out, F.lit(1), "key")


def rolling_reduce_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: summing reduce; later records are labelled 'c' / 'n' by key."""
    ev = _events(spark, sf_dir).select("event_id", "has_c", "event_type", "cents")
    label = F.when(F.col("has_c"), F.lit("c")).otherwise(F.lit("n"))
    return rolling_reduce(ev, "has_c", "event_id", "cents", "event_type", label)


def rolling_fold_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold from 100 adding 1 per record: 101, 102, ... per key."""
    ev = _events(spark, sf_dir).select("event_id", "has_c")
    return rolling_fold(ev, "has_c", "event_id", F.lit(1), 100, name="fold")


def rolling_max_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running max of value; event_type stays the first record's."""
    ev = _events(spark, sf_dir).select("event_id", "has_c", "event_type", "value")
    return rolling_extreme(ev, "has_c", "event_id", "value", "max", carry=["event_type"])


def rolling_min_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 mirror: running min of value."""
    ev = _events(spark, sf_dir).select("event_id", "has_c", "event_type", "value")
    return rolling_extreme(ev, "has_c", "event_id", "value", "min", carry=["event_type"])


def rolling_maxby_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole record of the running max value; earliest wins ties."""
    ev = _events(spark, sf_dir).select("event_id", "has_c", "event_type", "value")
    out = rolling_extreme_by(ev, "has_c", "event_id", "value", ["event_id", "event_type", "value"], "max",
                             prefix="best_")
    return out.select("event_id", "has_c", "best_event_id", "best_event_type", "best_value")


def rolling_minby_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 mirror: whole record of the running min value."""
    ev = _events(spark, sf_dir).select("event_id", "has_c", "event_type", "value")
    out = rolling_extreme_by(ev, "has_c", "event_id", "value", ["event_id", "event_type", "value"], "min",
                             prefix="best_")
    return out.select("event_id", "has_c", "best_event_id", "best_event_type", "best_value")


def _nullable(spark, sf_dir) -> DataFrame:
    """Events whose value is null in every 7th row."""
    ev = _events(spark, sf_dir).select("event_id", "has_c", "event_type", "value", "cents")
    gone = F.col("event_id") % 7 == 0
    return ev.withColumns({c: F.when(~gone, F.col(c)) for c in ("value", "cents")})


def rolling_minby_nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 with nulls: records without a value are never the extreme."""
    out = rolling_extreme_by(_nullable(spark, sf_dir), "has_c", "event_id", "value", ["event_id", "value"], "min", prefix="best_")
    return out.select("event_id", "has_c", F.coalesce("best_event_id", F.lit(-1)).alias("best_event_id"), F.coalesce("best_value", F.lit(-1.0)).alias("best_value"))


def rolling_sum_null_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 over an order with nulls (first) and ties (the next column decides)."""
    ev = _nullable(spark, sf_dir).withColumn("slot", F.when(F.col("event_id") % 3 > 0, F.floor(F.col("event_id") / 50)))
    out = rolling_sum(ev.select("event_id", "has_c", "slot", "cents"), "has_c", ["slot", "event_id"], "cents", name="running_cents")
    return out.select("event_id", "has_c", F.coalesce("running_cents", F.lit(-1)).alias("running_cents"))


def rolling_sum_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original's own case: lines in the order of a string and a line
    number, keyed by a contained letter, running sum of their lengths."""
    lines = document_lines(spark, sf_dir).select(F.concat(F.lit("file:///texts/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), "line_no", "line")
    out = rolling_sum(lines.withColumn("n", F.length("line").cast("long")), lambda d: d["line"].contains("q"), ["path", "line_no"], "n", name="running")
    return out.select("path", "line_no", "running")


def rolling_sum_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the key given by its position."""
    ev = _events(spark, sf_dir).select("event_type", "event_id", "cents")
    return rolling_sum(ev, 0, "event_id", "cents", name="running_cents")


def _weigh(acc: dict, record: dict) -> dict:
    """A step whose order matters."""
    return {**acc, "weight": (acc["weight"] * 3 + (record["cents"] or 0)) % 1_000_003, "last_type": record["event_type"]}


def rolling_python_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Python step over whole records from a start value, keyed by
    a nullable long (null users are a key)."""
    from streamkit.operators.keyed import fold_groups

    ev = _nullable(spark, sf_dir).join(_events(spark, sf_dir).select("event_id", "user_id"), "event_id")
    ev = ev.withColumn("user", F.when(F.col("user_id") % 5 > 0, F.col("user_id").cast("long")))

    def step(acc, record):
        return {**_weigh(acc, record), "event_id": record["event_id"]}

    out = fold_groups(ev.select("user", "event_id", "event_type", "cents"), ["user"], ["event_id"], step,
                      "event_id long, weight long, last_type string", initial={"weight": 7})
    return out.select(F.coalesce("user", F.lit(-1)).alias("user_id"), "event_id", "weight", "last_type")


def tumbling_python_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Python reduce over the records of each 6 h window and type,
    the first record as accumulator."""
    ev = _events(spark, sf_dir).select("event_type", "ts", "event_id", "cents", F.col("cents").alias("weight"))
    step = lambda acc, r: {**acc, "weight": (acc["weight"] * 3 + r["cents"]) % 1_000_003}
    return time_window_fold(ev, "event_type", "ts", "6 hours", ["ts", "event_id"], step, "event_id long, weight long")


def _weigher(initial: int):
    """The steps of ``_weigh`` as a monoid: each record is a map
    ``w -> (3 w + cents) mod P``, states are compositions of such maps (whose
    order matters), and the id of the first record."""
    from streamkit.operators.monoid import Monoid

    p = 1_000_003

    def add(acc, record):
        times, plus = acc["times"] * 3 % p, (acc["plus"] * 3 + (record["cents"] or 0)) % p
        return {"times": times, "plus": plus, "event_id": record["event_id"] if acc["event_id"] is None else acc["event_id"]}

    def merge(a, b):
        return {"times": a["times"] * b["times"] % p, "plus": (a["plus"] * b["times"] + b["plus"]) % p,
                "event_id": b["event_id"] if a["event_id"] is None else a["event_id"]}

    return Monoid({"times": 1, "plus": 0, "event_id": None}, add, merge, "times long, plus long, event_id long", "first_id long, weight long",
                  lambda a: {"first_id": a["event_id"], "weight": (initial * a["times"] + a["plus"]) % p})


def rolling_python_monoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mergeable Python aggregate per record, over two keys (one of
    them holds about half of all rows), cut into blocks."""
    from streamkit.operators.monoid import rolling_monoid

    ev = _nullable(spark, sf_dir).select("event_id", "has_c", "cents")
    return rolling_monoid(ev, "has_c", "event_id", _weigher(7)).select("event_id", "has_c", "first_id", "weight")


def tumbling_python_monoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over the records of each 6 h window and type."""
    from streamkit.operators.monoid import time_window_monoid

    ev = _events(spark, sf_dir).select("event_type", "ts", "event_id", "cents")
    out = time_window_monoid(ev, "event_type", "ts", "6 hours", ["ts", "event_id"], _weigher(0))
    return out.withColumnRenamed("first_id", "event_id")


def sliding_python_monoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over 12 h windows every 5 h (one-hour panes), of all events."""
    from streamkit.operators.monoid import time_window_monoid

    ev = _events(spark, sf_dir).select("ts", "event_id", "cents")
    return time_window_monoid(ev, None, "ts", "12 hours", ["ts", "event_id"], _weigher(0), slide="5 hours")


def count_python_monoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over every 50 events of a type."""
    from streamkit.operators.monoid import count_window_monoid

    ev = _events(spark, sf_dir).select("event_type", "event_id", "cents")
    return count_window_monoid(ev, "event_type", "event_id", 50, _weigher(0))


# -- multi-stream ---------------------------------------------------------------

def union_self(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: a stream united with itself: every token twice."""
    toks = _part_tokens(spark, sf_dir, UPPER_UPPER)
    return union(toks, toks)


def _routed(spark, sf_dir) -> DataFrame:
    toks = _part_tokens(spark, sf_dir, UPPER_UPPER)
    selector = first_match_selector([(F.col("token").contains("L"), "LLLL"), (F.col("token").contains("R"), "RRRR")],
                                    "****")
    return split(toks, selector)


def split_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: every token with the output it is routed to."""
    return _routed(spark, sf_dir).select("p_partkey", "pos", "token", F.col("_outputs")[0].alias("output"))


def split_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: the 'RRRR' output."""
    return select_outputs(_routed(spark, sf_dir), "RRRR")


def select_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 + P8: the 'LLLL' output mapped to lower case."""
    return select_outputs(_routed(spark, sf_dir), "LLLL").withColumn("token", F.lower("token"))


def _rendered():
    """The printed form of a mixed-type element: whichever side's value, as text."""
    return F.coalesce(F.col("str_value"), F.col("int_value").cast("string")).alias("value")


def co_map_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 + M5: filtered tokens (string) connected with part sizes (int)."""
    toks = token_filter(spark, sf_dir)
    sizes = load_table(spark, sf_dir, "part").select("p_partkey", "p_size")
    conn = connect(toks, sizes)
    tagged = conn.co_map(lambda d: d["token"], lambda d: d["p_size"], names=("str_value", "int_value"))
    return tagged.select("side", _rendered())


def co_flat_map_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: side 1 emits the first token UPPER, side 2 the token count."""
    part = load_table(spark, sf_dir, "part")
    conn = connect(part, part)
    tagged = conn.co_flat_map(
        lambda d: F.array(F.upper(java_split(d["p_name"], " ").getItem(0))),
        lambda d: F.array(F.size(java_split(d["p_name"], " "))),
        names=("str_value", "int_value"),
    )
    return tagged.select("side", "pos", _rendered())


# -- time windows -----------------------------------------------------------------

def tumbling_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user 1 h tumbling sum of cents."""
    return time_window(_events(spark, sf_dir), "user_id", "ts", "1 hour", [Agg("sum", F.col("cents"), "cents")])


def tumbling_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user 1 h tumbling max value."""
    return time_window(_events(spark, sf_dir), "user_id", "ts", "1 hour", [Agg("max", F.col("value"), "max_value")])


def tumbling_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user 1 h fold from 100 adding 1 per record."""
    return time_window(_events(spark, sf_dir), "user_id", "ts", "1 hour", [Agg("fold", F.lit(1), "fold", initial=100)])


def _best(kind: str) -> Agg:
    record = F.struct(F.col("event_id").alias("id"), F.col("value").alias("v"))
    return Agg(kind, record, "_best", order=("event_id",), by=F.col("value"))


def tumbling_maxby(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 by-form: per event type, 6 h tumbling, the record with the max value."""
    out = time_window(_events(spark, sf_dir), "event_type", "ts", "6 hours", [_best("max_by")])
    return out.select("event_type", "window_start", "window_end",
                      F.col("_best.id").alias("best_event_id"), F.col("_best.v").alias("best_value"))


def tumbling_minby(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 by-form: per event type, 6 h tumbling, the record with the min value."""
    out = time_window(_events(spark, sf_dir), "event_type", "ts", "6 hours", [_best("min_by")])
    return out.select("event_type", "window_start", "window_end",
                      F.col("_best.id").alias("best_event_id"), F.col("_best.v").alias("best_value"))


def sliding_minute_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 with many windows per row: per event type, 2 days every 30 min."""
    return time_window(_events(spark, sf_dir), "event_type", "ts", "2 days", [Agg("count", None, "n"), Agg("max", F.col("value"), "max_value")], slide="30 minutes")


def sliding_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user 1 h windows every 20 min, sum of cents and count."""
    return time_window(_events(spark, sf_dir), "user_id", "ts", "1 hour",
                       [Agg("sum", F.col("cents"), "cents"), Agg("count", None, "n")], slide="20 minutes")


def sliding_nondividing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 with a slide that does not divide the size: 50 min every 20 min."""
    return time_window(_events(spark, sf_dir), "user_id", "ts", "50 minutes",
                       [Agg("sum", F.col("cents"), "cents"), Agg("count", None, "n")], slide="20 minutes")


def sliding_max_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W9 shape: per event type (hot keys) 2 h windows every 1 h, max and min value."""
    return time_window(_events(spark, sf_dir), "event_type", "ts", "2 hours",
                       [Agg("max", F.col("value"), "max_value"), Agg("min", F.col("value"), "min_value")],
                       slide="1 hour")


def global_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One global group per 6 h window every 3 h: the event types
    concatenated in arrival order and the sum of their lengths."""
    ev = _events(spark, sf_dir).select("event_id", "ts", "event_type", F.length("event_type").alias("len"))
    return time_window(ev, None, "ts", "6 hours",
                       [Agg("concat", F.col("event_type"), "concat", order=("ts", "event_id")),
                        Agg("sum", F.col("len"), "total_len")], slide="3 hours")


def windowed_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: documents arriving one per second; words counted in 5 s windows every 1 s."""
    docs = ensure_parallelism(load_table(spark, sf_dir, "documents").select("doc_id", "text"))
    ts = F.expr("timestampadd(SECOND, doc_id, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    return word_count_windows(docs.select(ts.alias("ts"), "text"), text_col="text", time_col="ts")


# -- count windows and sessions ----------------------------------------------------

def count_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, every 5 consecutive events: sum of cents (incomplete tail dropped)."""
    return count_window(_events(spark, sf_dir), "user_id", "event_id", 5, [Agg("sum", F.col("cents"), "cents")])


def count_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, after every 2nd event, the sum over its last <= 5 events."""
    return count_window(_events(spark, sf_dir), "user_id", "event_id", 5, [Agg("sum", F.col("cents"), "cents")],
                        slide=2)


def count_sliding_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 on hot keys: per event type, every 2 events, sum over the last <= 5."""
    return count_window(_events(spark, sf_dir), "event_type", "event_id", 5, [Agg("sum", F.col("cents"), "cents")],
                        slide=2)


def count_sliding_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 with long windows: per event type, after every event the last <= 100:
    sum of a double (exact quarters), and max."""
    quarters = F.round(F.col("value") * 4) / 4
    return count_window(_events(spark, sf_dir), "event_type", "event_id", 100, [Agg("sum", quarters, "sum_value"), Agg("max", F.col("value"), "max_value")], slide=1)


def count_sliding_thousand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 with windows of 1,000 rows: per event type, after every event the sum,
    maximum and number over the last <= 1,000."""
    return count_window(_events(spark, sf_dir), "event_type", "event_id", 1_000,
                        [Agg("sum", F.col("cents"), "cents"), Agg("max", F.col("value"), "max_value"), Agg("count", None, "n")], slide=1)


def session_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user sessions with a 6 h gap: count and cents."""
    return session_window(_events(spark, sf_dir), "user_id", "ts", "6 hours",
                          [Agg("count", None, "n"), Agg("sum", F.col("cents"), "cents")],
                          tiebreak=("event_id",))


def session_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W10 on hot keys: per event type, sessions with a 10 min gap."""
    return session_window(_events(spark, sf_dir), "event_type", "ts", "10 minutes",
                          [Agg("count", None, "n"), Agg("sum", F.col("cents"), "cents")],
                          tiebreak=("event_id",))


# -- whole programs ---------------------------------------------------------------

def compound_growth_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: every account balance grown 36 periods at 0.4 %; total and per period."""
    cust = load_table(spark, sf_dir, "customer")
    total = compound_growth("c_acctbal", 0.004, 36)
    return cust.select("c_custkey", total.alias("total")).withColumn("per_period", F.col("total") / F.lit(36))


QUERIES = {
    "sequence_map": sequence_map,
    "sequence_predicate": sequence_predicate,
    "token_case_flatmap": token_case_flatmap,
    "iterator_sequence": iterator_sequence,
    "flat_map_python": flat_map_in_python,
    "output_format_roundtrip": output_format_roundtrip,
    "token_filter": token_filter,
    "word_count": word_count_docs,
    "parse_pairs": parse_pairs,
    "pair_length": pair_length,
    "csv_sink_format": csv_sink_format,
    "document_lines": document_lines,
    "text_roundtrip": text_roundtrip,
    "delimited_roundtrip": delimited_roundtrip,
    "key_by_letter": key_by_letter,
    "rolling_sum": rolling_sum_q,
    "rolling_sum_global": rolling_sum_global,
    "rolling_reduce": rolling_reduce_q,
    "rolling_fold": rolling_fold_q,
    "rolling_max": rolling_max_q,
    "rolling_min": rolling_min_q,
    "rolling_maxby": rolling_maxby_q,
    "rolling_minby": rolling_minby_q,
    "rolling_minby_nullable": rolling_minby_nullable,
    "rolling_sum_null_order": rolling_sum_null_order,
    "rolling_sum_lines": rolling_sum_lines,
    "rolling_sum_by_position": rolling_sum_by_position,
    "rolling_python_fold": rolling_python_fold,
    "tumbling_python_reduce": tumbling_python_reduce,
    "rolling_python_monoid": rolling_python_monoid,
    "tumbling_python_monoid": tumbling_python_monoid,
    "sliding_python_monoid": sliding_python_monoid,
    "count_python_monoid": count_python_monoid,
    "union_self": union_self,
    "split_tags": split_tags,
    "split_select": split_select,
    "select_lower": select_lower,
    "co_map": co_map_q,
    "co_flat_map": co_flat_map_q,
    "tumbling_sum": tumbling_sum,
    "tumbling_max": tumbling_max,
    "tumbling_fold": tumbling_fold,
    "tumbling_maxby": tumbling_maxby,
    "tumbling_minby": tumbling_minby,
    "sliding_sum": sliding_sum,
    "sliding_minute_steps": sliding_minute_steps,
    "sliding_nondividing": sliding_nondividing,
    "sliding_max_by_type": sliding_max_by_type,
    "global_concat": global_concat,
    "windowed_word_count": windowed_word_count,
    "count_tumbling": count_tumbling,
    "count_sliding": count_sliding,
    "count_sliding_by_type": count_sliding_by_type,
    "count_sliding_long": count_sliding_long,
    "count_sliding_thousand": count_sliding_thousand,
    "session_by_user": session_by_user,
    "session_by_type": session_by_type,
    "compound_growth": compound_growth_q,
}

from streamkit.plans.streams import STREAM_QUERIES  # noqa: E402

QUERIES.update(STREAM_QUERIES)
