"""Removal of repeated byte strings by a two-stage suffix array.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts
anywhere else.  In order, with texts as UTF-8 bytes:

1. *Owners.*  Every window of ``LENGTH`` bytes is owned by the place of the
   smallest hash of a ``GRAM``-byte string in it, the leftmost if several tie.
   The choice looks at the window's bytes alone, so equal windows have owners
   of equal hash at equal offsets.  An owner's windows are consecutive; the
   bytes that they cover are its stretch.
2. *Settled stretches.*  Owners are counted by hash, and by hash and stretch.
   A stretch that occurs more than once is repeated whole; an owner hash with
   a single distinct stretch has no other windows to compare.
3. *Suffix arrays.*  The distinct stretches of the remaining owner hashes are
   dealt into blocks of bounded size, an owner hash as a whole to one block,
   and each block's suffixes are sorted in two stages: those smaller than
   their successors directly, the others induced from them by scanning the
   buckets of first bytes in order.  A window is repeated if the common
   prefix with a neighbour in the array is as long as the window.
4. *Hot owner hashes* with more stretches than a block takes are dealt over
   several blocks by a salt; windows that found no equal in their block are
   then counted by 128-bit hash over all blocks of that owner hash.

Counts aggregate per task before they move, a hash that a third of all
documents share is split in 3 and 4, and joins back to places go by keys that
Spark can split.  Stretches that agree in a 128-bit hash are taken as equal.

Defined results: a null text is empty, nothing is removed from a text shorter
than ``LENGTH``; a row stored twice, or without id, is a document of its own,
so two equal rows of that length lose all bytes; an empty table gives an empty
result; further columns play no part.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamkit.llm.common import fingerprint, id_type, left_join_held, map_texts, may_hold, read_table, stage_table, staged_result, text_rows, trim_memory

#: Bytes of a repeated string, bytes of the hashed strings in it.
LENGTH, GRAM = 400, 32
#: Bytes of stretches in a block on average, stretches of one owner hash in a block.
BLOCK, STRETCHES = 2 << 20, 4096
#: Bytes of a text whose windows are looked at together.
STEP = 1 << 20
_U = np.uint64
#: A byte that UTF-8 never holds ends each stretch in a block.
END = 0xFF


def _byte_codes() -> np.ndarray:
    x = np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


CODES = _byte_codes()


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A mixed 64-bit hash of the ``gram`` bytes, or hashed words (a power of
    two of them), from each place."""
    h, base, n = CODES[data] if data.dtype == np.uint8 else data, _U(0xD6E8FEB86659FD93), 1
    with np.errstate(over="ignore"):
        while n < gram:
            h = h[:-n] * base + h[n:]
            base, n = base * base, 2 * n
        h ^= h >> _U(31)
        h *= _U(0xBF58476D1CE4E5B9)
        h ^= h >> _U(29)
    return h


def window_min(x: np.ndarray, size: int) -> np.ndarray:
    """The minimum of each ``size`` neighbours."""
    n = 1
    while 2 * n <= size:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return np.minimum(x[:len(x) - (size - n)], x[size - n:]) if size > n else x


def owners(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, last window) of each owner, by place."""
    keys, first, last = [], [], []
    span = length - gram + 1
    for at in range(0, len(data) - length + 1, STEP):
        part = data[at:at + STEP + length - 1]
        h = gram_hashes(part, gram)
        low = window_min((h & ~_U((STEP << 1) - 1)) | np.arange(len(h), dtype=_U), span)
        place = low & _U((STEP << 1) - 1)
        begin = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        keys.append(h[place[begin]])
        first.append(begin + at)
        last.append(np.append(begin[1:], len(place)) - 1 + at)
    if not keys:
        return np.empty(0, _U), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(keys), np.concatenate(first), np.concatenate(last)


def by_bytes(data: bytes, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` in the order of the ``depth`` bytes from them: by eight bytes
    at a time, of which only those that are tied so far are looked at again."""
    t = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(depth + 8, np.uint8)])
    order, place = places.copy(), np.arange(len(places), dtype=np.int32)
    group = np.zeros(len(places), np.int32)
    for k in range(0, depth, 8):
        if not len(place):
            break
        p = order[place]
        word = np.zeros(len(p), _U)
        for i in range(min(8, depth - k)):
            word = (word << _U(8)) | t[p + (k + i)]
        by = np.lexsort((word, group))
        word, group, order[place] = word[by], group[by], p[by]
        begin = np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]) | (word[1:] != word[:-1])))).astype(np.int32)
        del word, by, p
        sizes = np.diff(np.append(begin, np.int32(len(place))))
        tied = np.repeat(sizes > 1, sizes)
        group, place = np.repeat(begin, sizes)[tied], place[tied]
    return order


def suffix_array(data: bytes, needed: np.ndarray, is_s: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """The needed places of ``data`` in the order of their first ``depth``
    bytes.  ``is_s`` marks suffixes smaller than their successors; only those
    are compared.  A suffix that isn't follows its successor, so scanning the
    buckets of first bytes upwards meets the successors in order and places
    their predecessors; ``needed`` therefore goes on to a marked place."""
    t = np.frombuffer(data, np.uint8)
    direct = by_bytes(data, np.flatnonzero(needed & is_s).astype(np.int32), depth)
    ends = np.searchsorted(t[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced = needed & ~is_s
    out = []
    for c in range(256):
        level = np.concatenate(waiting[c]) if waiting[c] else direct[:0]
        bucket = []
        while len(level):
            bucket.append(level)
            before = level[level > 0] - 1
            level = before[induced[before] & (t[before] == c)]
        bucket = np.concatenate([*bucket, direct[ends[c]:ends[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[induced[before] & (t[before] > c)]
        first = t[before]
        before = before[np.argsort(first, kind="stable")]
        first = t[before]
        cuts = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1]))) if len(first) else []
        for lo, hi in zip(cuts, [*cuts[1:], len(first)]):
            waiting[first[lo]].append(before[lo:hi])
    return np.concatenate(out)


def common_prefixes(data: bytes, order: np.ndarray, depth: int = LENGTH, step: int = 5_000) -> np.ndarray:
    """For each place in ``order`` but the first, the length (``depth`` at
    most) of the prefix that it shares with the place before it."""
    t = np.frombuffer(data, np.uint8)
    view = np.lib.stride_tricks.sliding_window_view(t, depth)
    out = np.empty(max(0, len(order) - 1), np.int64)
    for at in range(0, len(out), step):
        rows = view[order[at:at + step + 1]]
        differ = rows[1:] != rows[:-1]
        out[at:at + step] = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
    return out


def repeated_windows(stretches: list[bytes], depth: int = LENGTH) -> list[np.ndarray]:
    """For each stretch, which of its windows of ``depth`` bytes occur in the
    stretches more than once."""
    data = bytes([END]).join([*stretches, b""])
    t = np.frombuffer(data, np.uint8)
    sizes = np.array([len(x) for x in stretches])
    begin = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    last = begin + sizes - depth  # the last window of each
    # smaller than the successor: by the next byte that differs
    change = np.flatnonzero(t[1:] != t[:-1])
    rises = np.append(t[change] < t[change + 1], False)
    is_s = np.repeat(rises, np.diff(np.concatenate(([-1], change, [len(t) - 1]))))
    del change, rises
    marked = np.flatnonzero(is_s)
    until = marked[np.searchsorted(marked, last)]
    del marked

    def between(first: np.ndarray, last: np.ndarray) -> np.ndarray:
        edge = np.zeros(len(t) + 1, np.int32)
        np.add.at(edge, first, 1)
        np.add.at(edge, last + 1, -1)
        return np.cumsum(edge[:-1], dtype=np.int32) > 0

    order = suffix_array(data, between(begin, until), is_s, depth)
    del is_s
    order = order[between(begin, last)[order]]
    same = common_prefixes(data, order, depth) >= depth
    found = np.zeros(len(t), bool)
    found[order] = np.append(same, False) | np.insert(same, 0, False)
    return [found[b:e + 1] for b, e in zip(begin.tolist(), last.tolist())]


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


def places(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document of (fa, fb, text): (row, fa, fb, owners),
    ``owners`` holding (key, first and last window, 128 bits of the stretch)."""
    rows = texts.select(F.monotonically_increasing_id().alias("row"), "fa", "fb", "text").where(F.octet_length("text") >= length)

    def make():
        import xxhash

        def one(text: str) -> list[dict]:
            data = text.encode()
            keys, first, last = owners(np.frombuffer(data, np.uint8), length)
            found = []
            for k, a, b in zip(keys.view(np.int64).tolist(), first.tolist(), last.tolist()):
                h = xxhash.xxh3_128_digest(data[a:b + length])
                found.append({"key": k, "first": a, "last": b, "ha": int.from_bytes(h[:8], "little", signed=True), "hb": int.from_bytes(h[8:], "little", signed=True)})
            return found

        return lambda rows: {x: rows[x] for x in ("row", "fa", "fb")} | {"owners": [one(t) for t in rows["text"]]}

    return map_texts(rows, make, "row long, fa long, fb long, owners array<struct<key:long,first:long,last:long,ha:long,hb:long>>")


def compared(docs: DataFrame, owned: DataFrame, todo: DataFrame, length: int = LENGTH) -> DataFrame:
    """Spans (row, begin, end) of the repeated windows of the stretches in
    ``todo``: (key, row, first, last, single, salts, salt)."""
    size = todo.agg(F.sum(F.col("last") - F.col("first") + length)).first()[0] or 0
    blocks = int(-(-size // BLOCK)) or 1
    todo = todo.withColumn("block", F.pmod(F.xxhash64("key", "salt"), F.lit(blocks)))
    by_row = todo.groupBy("row").agg(F.collect_list(F.struct("block", "key", "salts", "single", "first", "last")).alias("stretches"))
    wanted = stage_table(owned.select("row", "fa", "fb").join(by_row, "row"), "wanted")
    texts = may_hold(docs, "fa", wanted).join(wanted.hint("shuffle_hash"), ["fa", "fb"]).select("row", "text", "stretches")

    def make():
        def cut(rows: dict) -> dict:
            out: dict[str, list] = {x: [] for x in ("block", "key", "salts", "single", "first", "row", "stretch")}
            for row, text, stretches in zip(rows["row"], rows["text"], rows["stretches"]):
                data = text.encode()
                for s in stretches:
                    for x in ("block", "key", "salts", "single", "first"):
                        out[x].append(s[x])
                    out["row"].append(row)
                    out["stretch"].append(data[s["first"]:s["last"] + length])
            return out

        return cut

    stretches = map_texts(texts, make, "block long, key long, salts long, single boolean, first long, row long, stretch binary")

    def search(group: pd.DataFrame) -> pd.DataFrame:
        import xxhash

        group = group.drop_duplicates(["row", "first"])
        names = ("key", "wa", "wb", "row", "first", "last")
        told: dict[str, list[np.ndarray]] = {n: [] for n in names}
        none: dict[str, list[np.ndarray]] = {n: [] for n in names}

        def tell(first: np.ndarray, last: np.ndarray, **known) -> None:
            for n, v in (known | {"first": first, "last": last}).items():
                told[n].append(np.broadcast_to(np.int64(0) if v is None else v, len(first)))
                none[n].append(np.broadcast_to(v is None, len(first)))

        repeated = repeated_windows(group["stretch"].tolist(), length)
        for key, salts, single, first, row, stretch, mask in zip(group["key"], group["salts"], group["single"], group["first"], group["row"], group["stretch"], repeated):
            if single and mask.any():
                spans = first + np.array(runs(mask), np.int64)
                tell(spans[:, 0], spans[:, 1], key=None, wa=None, wb=None, row=row)
            if salts > 1:  # all distinct windows for the other blocks; open ones with their place
                hashes = np.frombuffer(b"".join(xxhash.xxh3_128_digest(stretch[i:i + length]) for i in range(len(mask))), "<i8").reshape(-1, 2)
                free = np.flatnonzero(~mask if single else np.ones(len(mask), bool))
                tell(first + free, first + free, key=key, wa=hashes[free, 0], wb=hashes[free, 1], row=row if single else None)
                if single:
                    taken = np.flatnonzero(mask)
                    taken = taken[np.unique(hashes[taken], axis=0, return_index=True)[1]]
                    tell(first + taken, first + taken, key=key, wa=hashes[taken, 0], wb=hashes[taken, 1], row=None)
        join = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
        return pd.DataFrame({n: pd.arrays.IntegerArray(join(told[n], np.int64), join(none[n], bool)) for n in names})

    def searched(group: pd.DataFrame) -> pd.DataFrame:
        found = search(group)
        trim_memory()
        return found

    result = stage_table(stretches.groupBy("block").applyInPandas(searched, "key long, wa long, wb long, row long, first long, last long"), "windows")
    here = result.where("key is null").select("row", "first", "last")
    across = result.where("key is not null")
    # a told window was repeated in its block already; an open one counts once
    known = (across.groupBy("key", "wa", "wb").agg(F.count("row").alias("open"), F.max(F.col("row").isNull()).alias("told"))
             .where("open > 1 or (open = 1 and told)").select("key", "wa", "wb"))
    there = across.where("row is not null").join(known, ["key", "wa", "wb"], "left_semi").select("row", "first", "last")
    return here.unionByName(there)


@staged_result("spans")
def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(fa, fb, spans) of the documents that hold repeated strings of
    ``length`` bytes: byte spans (begin, end exclusive), which may overlap."""
    docs = text_rows(docs).select(*fingerprint("doc_id", "text"), "text")
    owned = stage_table(places(docs, length), "owners")
    each = owned.select("row", F.explode("owners").alias("o")).select("row", "o.*")
    distinct = each.groupBy("key", "ha", "hb").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "first", "last")).alias("at"))
    several = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    kept = distinct.join(several, "key", "left").where("n > 1 or kinds is not null")
    kept = stage_table(kept.select("key", "ha", "hb", "n", "kinds", "at.*"), "stretches")
    settled = each.join(kept.where("n > 1").select("key", "ha", "hb"), ["key", "ha", "hb"], "left_semi").select("row", "first", "last")
    salts = F.ceil(F.col("kinds") / F.lit(STRETCHES)).cast("long")
    todo = (kept.where("kinds is not null")
            .select("key", "row", "first", "last", (F.col("n") == 1).alias("single"), salts.alias("salts"))
            .withColumn("salt", F.pmod(F.xxhash64("row", "first"), F.col("salts"))))
    spans = settled.unionByName(compared(docs, owned, todo, length))
    spans = spans.groupBy("row").agg(F.collect_list(F.struct(F.col("first").alias("begin"), (F.col("last") + length).alias("end"))).alias("spans"))
    return owned.select("row", "fa", "fb").join(spans, "row").select("fa", "fb", "spans").dropDuplicates(["fa", "fb"])


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["begin"], s["end"]) for s in spans or []):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


#: White space beyond ASCII, as regular expressions know it.
WIDE_BLANKS = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 28, 29, 30, 31, 32])
#: Words of the hashed strings that own passages.
WORDS = 8


def word_places(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, begin, end) of the words (runs without white space), in bytes."""
    data = np.frombuffer(text.encode(), np.uint8)
    blank = _BLANK[data]
    if WIDE_BLANKS.search(text):
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        wide = [ord(c) for c in set(WIDE_BLANKS.findall(text))]
        blank = blank | np.repeat(np.isin(codes, wide), 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return np.empty(0, _U), begin, end
    # sums of byte codes times powers of an odd base: equal for equal words
    word = np.zeros(len(data), np.int64)
    word[begin] = begin
    inside = np.arange(len(data)) - np.maximum.accumulate(word)
    inside[blank] = 0
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(inside.max()) + 2, _U(0xD6E8FEB86659FD93)))
        h = np.add.reduceat(np.where(blank, _U(0), CODES[data] * power[inside]), begin)
        h ^= h >> _U(29)
        h *= _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32)), begin, end


def passage_owners(docs: DataFrame, words: int) -> DataFrame:
    """(row, fa, fb, owners) of the documents (fa, fb, text): as ``places``,
    but of windows of ``words`` words, owned by the smallest hash of ``WORDS``
    words in it.  A window's string, with its white space, counts."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "fa", "fb", "text").where(F.octet_length("text") >= 2 * words - 1)

    def make():
        import xxhash

        def one(text: str) -> list[dict]:
            hashes, begin, end = word_places(text)
            keys, first, last = owners(hashes, words, WORDS)
            data, found = text.encode(), []
            for k, a, b in zip(keys.view(np.int64).tolist(), begin[first].tolist(), end[last + words - 1].tolist()):
                h = xxhash.xxh3_128_digest(data[a:b])
                found.append({"key": k, "begin": a, "end": b, "ha": int.from_bytes(h[:8], "little", signed=True), "hb": int.from_bytes(h[8:], "little", signed=True)})
            return found

        return lambda rows: {x: rows[x] for x in ("row", "fa", "fb")} | {"owners": [one(t) for t in rows["text"]]}

    return map_texts(rows, make, "row long, fa long, fb long, owners array<struct<key:long,begin:long,end:long,ha:long,hb:long>>")


def repeated_words(docs: DataFrame, words: int) -> DataFrame:
    """(row, begin, end) and the table of owners: byte spans of the strings of
    ``words`` whole words that also start anywhere else, of documents (fa, fb, text).

    As for bytes, equal windows have owners of equal hash at equal offsets.  An owner
    hash that occurs once is settled; of the others, a stretch that occurs more
    than once is repeated whole, and the windows of stretches that differ are counted
    by 128-bit hash.  Only owners whose hash repeats move more than once."""
    owned = stage_table(passage_owners(docs, words), "passages")
    each = owned.select("row", F.explode("owners").alias("o")).select("row", "o.*")
    whole = F.struct("ha", "hb")
    several = stage_table(each.groupBy("key").agg(F.count(F.lit(1)).alias("n"), (F.min(whole) != F.max(whole)).alias("differ")).where("n > 1").select("key", "differ"), "several")
    shared = stage_table(may_hold(each, "key", several).join(several, "key"), "shared")
    kinds = shared.groupBy("key", "ha", "hb").agg(F.count(F.lit(1)).alias("n"), F.max("differ").alias("differ"), F.min(F.struct("row", "begin", "end")).alias("at"))
    # tables of their own, so that a stretch or window with very many places can be split in the joins
    kinds = stage_table(kinds.where("n > 1 or differ"), "kinds")
    settled = shared.join(kinds.where("n > 1").select("key", "ha", "hb"), ["key", "ha", "hb"], "left_semi").select("row", "begin", "end")
    todo = kinds.where("differ").select((F.col("n") == 1).alias("single"), "at.*")
    wanted = stage_table(owned.select("row", "fa", "fb").join(todo.groupBy("row").agg(F.collect_list(F.struct("single", "begin", "end")).alias("stretches")), "row"), "open")
    texts = may_hold(docs, "fa", wanted).join(wanted.hint("shuffle_hash"), ["fa", "fb"]).select("row", "text", "stretches")

    def make():
        import xxhash

        def windows(rows: dict) -> dict:
            out: dict[str, list] = {x: [] for x in ("row", "single", "begin", "end", "wa", "wb")}
            for row, text, stretches in zip(rows["row"], rows["text"], rows["stretches"]):
                data, (_, begin, end) = text.encode(), word_places(text)
                for single, a, b in {(s["single"], s["begin"], s["end"]) for s in stretches}:
                    lo, hi = np.searchsorted(begin, a), np.searchsorted(end, b)
                    for first, last in zip(begin[lo:hi - words + 2].tolist(), end[lo + words - 1:hi + 1].tolist()):
                        h = xxhash.xxh3_128_digest(data[first:last])
                        for x, v in zip(out, (row, single, first, last, int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True))):
                            out[x].append(v)
            return out

        return windows

    # documents stored twice give their windows twice
    windows = stage_table(map_texts(texts, make, "row long, single boolean, begin long, end long, wa long, wb long"), "open-windows")
    places = F.struct("row", "begin")
    known = windows.groupBy("wa", "wb").agg((F.min(places) != F.max(places)).alias("several")).where("several").select("wa", "wb")
    known = stage_table(known, "known-windows")
    there = windows.where("single").join(known, ["wa", "wb"], "left_semi").select("row", "begin", "end")
    return settled.unionByName(there).join(owned.select("row", "fa", "fb"), "row").select("fa", "fb", "begin", "end")


@staged_result("spans")
def repeated_passages(docs: DataFrame, words: int, length: int = LENGTH) -> DataFrame:
    """(fa, fb, spans) of the documents that hold repeated strings of
    ``length`` bytes or of ``words`` whole words, whatever their bytes: two
    searches, each over owners that lie far apart."""
    rows = text_rows(docs).select(*fingerprint("doc_id", "text"), "text")
    by_length = repeated_spans(docs, length).select("fa", "fb", F.explode("spans").alias("s")).select("fa", "fb", "s.*")
    by_words = repeated_words(rows, words)
    return by_length.unionByName(by_words).distinct().groupBy("fa", "fb").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


def removed(docs: DataFrame) -> DataFrame:
    """Every document: (doc_id, n_bytes, n_spans, kept): the number of
    removed runs and the remaining bytes."""
    rows = text_rows(docs)
    spans = repeated_spans(docs)
    both = left_join_held(rows.select(*fingerprint("doc_id", "text"), "doc_id", "text"), spans, ["fa", "fb"], "fa").select("doc_id", "text", "spans")

    def make():
        def cut(rows: dict) -> dict:
            out: dict[str, list] = {"doc_id": rows["doc_id"], "n_bytes": [], "n_spans": [], "kept": []}
            for text, spans in zip(rows["text"], rows["spans"]):
                data, gone = text.encode(), merged(spans)
                ends = [0, *(b for _, b in gone)]
                out["n_bytes"].append(len(data))
                out["n_spans"].append(len(gone))
                out["kept"].append(b"".join(data[a:b] for a, b in zip(ends, [*(a for a, _ in gone), len(data)])))
            return out

        return cut

    return map_texts(both, make, f"doc_id {id_type(rows)}, n_bytes long, n_spans long, kept binary")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = removed(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
