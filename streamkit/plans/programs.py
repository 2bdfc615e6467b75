"""Whole programs (L1-L3) as functions over any line source.

Each takes a DataFrame of lines (a batch table, a file or socket stream, a
Kafka stream) and returns the result DataFrame; the caller picks the sink.
``time_col=None`` means processing time (the micro-batch clock).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamkit.functions.growth import compound_growth
from streamkit.functions.text import tokens
from streamkit.functions.time import interval_micros
from streamkit.operators.windows import Agg, element_windows, time_window
from streamkit.session import ship_package
from streamkit.streaming.event_time import processing_time


def _with_time(lines: DataFrame, time_col: str | None) -> tuple[DataFrame, str]:
    if time_col is not None:
        return lines, time_col
    return lines.withColumn("_proc_time", processing_time()), "_proc_time"


def windowed_word_count(lines: DataFrame, text_col: str = "value", time_col: str | None = None,
                        size="5 seconds", slide="1 second", word_parts: int | None = None, span: int = 1) -> DataFrame:
    """L1: split lines on single whitespace characters, count each word per
    sliding window.  Output ``word, window_start, window_end, count``.

    On a stream the state has a row for each word of each open window.  Where
    windows have few lines of many words, ``word_parts`` (streams in append mode)
    holds the words of an open window in so many rows instead, a word in one of
    them, and counts them when the window closes.  ``span`` consecutive windows
    share these rows, so that a line is held about once and not in each of its
    windows; they close with the last of them, which is when a line is late."""
    timed, t = _with_time(lines, time_col)
    if lines.isStreaming and word_parts:
        return _counted_when_closed(timed.select(F.col(t).alias("ts"), F.col(text_col).alias("_text")), size, slide, word_parts, span)
    lines = timed.select(F.col(t).alias("ts"), F.col(text_col).alias("_text"))
    return element_windows(lines, "_text", tokens(F.col("_text")), "word", "ts", size, slide, [Agg("count", None, "count")])


#: What ends a word where words are held as one string: no word has white space.
_END = "\n"
#: Counted words handed to Spark at a time.
_ROWS = 1 << 16


def _counted_when_closed(timed: DataFrame, size, slide, parts: int, span: int) -> DataFrame:
    """The lines of ``span`` windows meet in a state row for each part; when it is
    closed, its words are counted by window."""
    size_us, slide_us = interval_micros(size), interval_micros(slide)
    ship_package(timed.sparkSession)

    def part(words: Column, i: Column) -> Column:
        own = F.filter(words, lambda w: F.pmod(F.hash(w), F.lit(parts)) == i)
        return F.struct(i.alias("part"), F.when(F.size(own) > 0, F.array_join(own, _END)).alias("words"))

    dealt = _let(tokens(F.col("_text")), lambda words: F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: part(words, i)))
    dealt = timed.select("ts", F.explode(dealt).alias("_p")).where(F.col("_p.words").isNotNull())
    whole = F.window("ts", f"{size_us + (span - 1) * slide_us} microseconds", f"{span * slide_us} microseconds")
    line = F.struct(F.unix_micros("ts").alias("at"), F.col("_p.words").alias("words"))
    held = dealt.groupBy(whole.alias("_w"), F.col("_p.part").alias("_part")).agg(F.collect_list(line).alias("_lines"))
    first = F.expr(f"unix_micros(_w.start) div {slide_us}")
    each = held.select(first.alias("_k"), "_part", F.explode("_lines").alias("_l")).select("_k", "_part", "_l.at", "_l.words")

    def counted(batches: Iterator) -> Iterator:
        return count_words(batches, size_us, slide_us, span)

    out = each.mapInArrow(counted, "word string, _k long, count long")
    start = F.col("_k") * slide_us
    return out.select("word", F.timestamp_micros(start).alias("window_start"), F.timestamp_micros(start + size_us).alias("window_end"), "count")


def count_words(batches: Iterator, size_us: int, slide_us: int, span: int) -> Iterator:
    """(word, window, count) of lines (first window of their span, part, time, words);
    the lines of a span and part follow one another."""
    import numpy as np  # noqa: PLC0415

    held, own = [], None
    for batch in batches:
        keys = [batch.column(i).to_numpy() for i in (0, 1)]
        changes = np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1
        cuts = [0, *changes.tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if own != (key := (int(keys[0][a]), int(keys[1][a]))):
                yield from _of_span(held, own, size_us, slide_us, span)
                held, own = [], key
            held.append(batch.slice(a, b - a))
    yield from _of_span(held, own, size_us, slide_us, span)


def _of_span(lines: list, own: tuple[int, int] | None, size_us: int, slide_us: int, span: int) -> Iterator:
    import numpy as np  # noqa: PLC0415
    import pyarrow as pa  # noqa: PLC0415
    import pyarrow.compute as pc  # noqa: PLC0415

    if own is None:
        return
    at = np.concatenate([x.column(2).to_numpy() for x in lines])
    order = np.argsort(at, kind="stable")
    words = pc.split_pattern(pa.concat_arrays([x.column(3) for x in lines]).take(pa.array(order)), _END)
    offsets, coded = words.offsets.to_numpy(), words.values.dictionary_encode()
    codes = coded.indices.to_numpy()
    at = at[order]
    first, last = (at - size_us) // slide_us + 1, at // slide_us

    def rows(found: list) -> pa.RecordBatch:
        k, code, n = (np.concatenate(x) for x in zip(*found))
        return pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(code)), pa.array(k), pa.array(n)], names=["word", "_k", "count"])

    found, size = [], 0
    for k in range(own[0], own[0] + span):
        a, b = np.searchsorted(last, k, "left"), np.searchsorted(first, k, "right")  # the lines that the window holds
        n = np.bincount(codes[offsets[a]:offsets[max(a, b)]])
        code = np.flatnonzero(n)
        for i in range(0, len(code), _ROWS):
            some = code[i:i + _ROWS]
            found.append((np.full(len(some), k, dtype=np.int64), some, n[some].astype(np.int64)))
            size += len(some)
            if size >= _ROWS:
                yield rows(found)
                found, size = [], 0
    if found:
        yield rows(found)


def _let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def concat_windows(lines: DataFrame, text_col: str = "value", time_col: str | None = None,
                    order: tuple[str, ...] = (), size="5 seconds", slide="1 second") -> DataFrame:
    """L2: pair each string with its length; one global sliding window
    concatenates the strings in arrival order (time, then ``order``) and sums
    the lengths.  ``order`` (arrival: partition and offset, or a sequence
    number) is needed, as equal times say nothing about it.  One window's
    strings end up in one cell, as the result asks.  Output ``window_start,
    window_end, concat, total_len``."""
    if not order:
        raise ValueError("give the columns that hold the order of arrival")
    timed, t = _with_time(lines, time_col)
    pairs = timed.select(F.col(t).alias("ts"), *order, F.col(text_col).alias("s"), F.length(text_col).alias("len"))
    return time_window(pairs, None, "ts", size,
                       [Agg("concat", F.col("s"), "concat", order=("ts", *order)), Agg("sum", F.col("len"), "total_len")],
                       slide=slide)


def growth_table(df: DataFrame, balance_col: str, rate: float = 0.004, periods: int = 36) -> DataFrame:
    """L3: every balance grown ``periods`` times; total and per-period share."""
    total = compound_growth(balance_col, rate, periods)
    return df.withColumn("total", total).withColumn("per_period", F.col("total") / F.lit(periods))
