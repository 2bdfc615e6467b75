"""Benchmark decontamination by a broadcast set of normalised word windows.

Only DataFrame functions: no Python runs on the rows.

1. Benchmark texts become word windows: ``WINDOW`` consecutive words; a text of
   fewer words, but not none, is one window.  Equal windows are one row, with
   the list of items that hold them (lists are stored apart, a window has a
   list's number), and a 64-bit hash.
2. Each training text is cut into words once.  Hashes of one word are combined
   into those of 2, 4, 8, ... words by doubling, and into those of the window
   lengths that occur, so a position costs a few hash steps, not a string.
3. The hashes probe the window set, which is broadcast while its measured size
   is at most ``BROADCAST_BYTES``.  Beyond that a bitmap of fixed size (4 MB)
   drops windows that cannot match and the rest is joined by a shuffle.  A probe
   that hits is verified by comparing the words themselves.
4. Verified hits, few and narrow, move to their document's task, where covered
   words are counted from the sorted spans, and items from the lists.

Every row reads its text once, and no text moves.  ``decontaminate`` removes
the hit spans or the whole documents; there only documents with hits move.

Defined results.  A null or empty text has no words.  A null item id marks words
but is neither counted nor listed; an item stored several times, or under one
id with several texts, counts once.  A document row stored several times gives
a row each time.  Ties do not arise.  With an empty benchmark nothing is hit; an
empty table gives an empty result.  Further columns play no part, whatever their
names, and ``decontaminate`` passes them on unchanged.  A very long text is held
as an array of its words by the task that reads it.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamkit.llm.common import fingerprint, left_join_held, mark_held, read_table, stage_table

#: Words in a window.
WINDOW = 10
#: Largest window set that is broadcast, in bytes as estimated by ``held_bytes``.
BROADCAST_BYTES = 64 << 20

#: A word, of either case, and what lies between words.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(word: Column) -> Column:
    """``word`` with only A-Z in lower case."""
    ascii_only = F.length(word) == F.octet_length(word)
    lower = F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, string.ascii_uppercase, string.ascii_lowercase))
    return F.when(word.rlike("[A-Z]"), lower).otherwise(word)


def words(text: Column) -> Column:
    """The lower-cased words of ``text``."""
    return F.transform(stored_words(F.coalesce(text.cast("string"), F.lit(""))), lowered)


def stored_words(text: Column) -> Column:
    """What lies between the gaps of ``text``, without the empty strings
    before a first and after a last gap."""
    def inner(parts: Column) -> Column:
        before = F.when(parts[0] == "", 1).otherwise(0)
        after = F.when(F.element_at(parts, -1) == "", 1).otherwise(0)
        return F.slice(parts, before + 1, F.greatest(F.size(parts) - before - after, F.lit(0)))

    return let(F.split(text, GAP), inner)


def let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def window_hashes(of: Column, lengths: list[int], body) -> Column:
    """``body(hashes)``, where ``hashes[n]`` is the array of the hashes of the
    ``n``-word windows of the word array ``of``, for each of ``lengths``."""
    doubled: dict[int, Column] = {}

    def joined(a: Column, b: Column, shift: int) -> Column:
        return F.zip_with(a, F.slice(b, shift + 1, F.size(b)), lambda x, y: F.xxhash64(x, y))

    def finish() -> Column:
        out = {}
        for n in lengths:
            parts = [p for p in sorted(doubled, reverse=True) if n & p]
            hashes, at = doubled[parts[0]], parts[0]
            for p in parts[1:]:
                hashes, at = joined(hashes, doubled[p], at), at + p
            out[n] = F.slice(hashes, 1, F.greatest(F.size(of) - (n - 1), F.lit(0)))
        return body(out)

    def grow(size: int, hashes: Column) -> Column:
        doubled[size] = hashes
        if not lengths or 2 * size > max(lengths):
            return finish()
        return let(joined(hashes, hashes, size), lambda h: grow(2 * size, h))

    return let(F.transform(of, lambda w: F.xxhash64(w)), lambda h: grow(1, h))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The distinct windows (h, len, win, list) and the item lists (list, items)."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("item"), words(F.col(f"`{text_col}`")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    cut = items.select("item", F.explode(F.transform(starts, lambda i: F.slice(F.col("w"), i, window))).alias("win"))
    held = stage_table(cut.groupBy("win").agg(F.array_sort(F.collect_set("item")).alias("items")), "windows")
    lists = stage_table(held.select("items").distinct().withColumn("list", F.monotonically_increasing_id()), "lists")
    sized = held.withColumn("len", F.size("win"))
    lengths = window_lengths(sized)
    by_length = F.coalesce(*[F.when(F.col("len") == n, window_hashes(F.col("win"), [n], lambda h, n=n: h[n][0])) for n in lengths], F.lit(0).cast("long"))
    return stage_table(sized.withColumn("h", by_length).join(lists, "items").select("h", "len", "win", "list"), "window-set"), lists


def window_lengths(windows: DataFrame) -> list[int]:
    """The lengths that occur, at most ``WINDOW`` numbers."""
    return sorted(r["len"] for r in windows.select("len").distinct().collect())


def held_bytes(windows: DataFrame) -> int:
    """Bytes of the window set in memory: its words, and about 16 bytes a word and 96 a row besides."""
    size = F.aggregate("win", F.lit(96).cast("long"), lambda a, w: a + F.octet_length(w) + 16)
    return windows.agg(F.sum(size)).first()[0] or 0


def hits(rows: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """Verified hits (keys, n_words, pos, len, list) of ``rows`` (keys, text):
    ``len`` words from word ``pos`` are a window.  Each row also has one entry
    with ``len`` 0, so that rows without a hit stay known."""
    lengths = window_lengths(windows)
    cut = rows.select(*keys, words(F.col("text")).alias("w")).withColumn("n_words", F.size("w").cast("long"))

    def arrays(hashes: dict[int, Column]) -> Column:
        none = F.struct(F.lit(0).alias("len"), F.array(F.xxhash64(*keys)).alias("hs"))
        return F.array(none, *[F.struct(F.lit(n).alias("len"), hashes[n].alias("hs")) for n in lengths])

    hashed = cut.select(*keys, "n_words", "w", window_hashes(F.col("w"), lengths, arrays).alias("by_length"))
    one = hashed.select(*keys, "n_words", "w", F.explode_outer("by_length").alias("x")).select(*keys, "n_words", "w", F.col("x.len").alias("len"), F.col("x.hs").alias("hs"))
    probes = one.select(*keys, "n_words", "w", "len", F.posexplode_outer("hs").alias("pos", "h"))
    at = F.slice(F.col("w"), F.col("pos") + 1, F.col("len"))
    held = windows.select(F.col("h").alias("_h"), F.col("win").alias("_win"), "list")
    # the join is on the hash alone: only windows that it lets through are compared by their words
    if held_bytes(windows) <= BROADCAST_BYTES:
        found, same = probes.join(F.broadcast(held), F.col("h") == F.col("_h"), "left"), at == F.col("_win")
    else:
        maybe = mark_held(probes, "h", windows.select("h")).where("maybe or len = 0")
        moved = maybe.select(*keys, "n_words", "len", "pos", "h", at.alias("win"))
        found, same = moved.join(held, F.col("h") == F.col("_h"), "left"), F.col("win") == F.col("_win")
    hit = F.when(F.col("len") > 0, F.col("list")).alias("list")
    return (found.where((F.col("len") == 0) | (F.col("_h").isNotNull() & same))
            .select(*keys, "n_words", F.col("pos").cast("long").alias("pos"), F.col("len").cast("long").alias("len"), hit))


def covered(found: DataFrame, keys: list[str]) -> DataFrame:
    """``found`` with ``fresh``: the words of the span that no earlier span of
    the row covers, and ``begins``: whether it touches none of them."""
    before = Window.partitionBy(*keys).orderBy("pos", "len").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max(F.when(F.col("len") > 0, F.col("pos") + F.col("len"))).over(before), F.lit(-1))
    out = found.withColumn("reach", reach)
    fresh = F.greatest(F.lit(0), F.col("pos") + F.col("len") - F.greatest("pos", "reach"))
    return out.select(*found.columns, fresh.alias("fresh"), (F.col("pos") > F.col("reach")).alias("begins"))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted as strings)."""
    windows, lists = benchmark_windows(benchmark, window)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = covered(hits(rows.select("row", "doc_id", "text"), windows, ["row", "doc_id"]).withColumnRenamed("doc_id", "id"), ["row"])
    totals = found.groupBy("row").agg(F.max("id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum("fresh").alias("n_hit"), F.collect_set("list").alias("lists"))
    listed = totals.select("row", "doc_id", "n_words", "n_hit", F.explode_outer("lists").alias("list")).join(lists, "list", "left")
    items = F.array_sort(F.array_distinct(F.flatten(F.collect_list("items"))))
    return listed.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.max("n_hit").alias("n_hit"), items.alias("items")).drop("row")


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """``docs`` without what is hit: ``remove="spans"`` takes hit words, with
    what follows each up to the next word, out of the texts; ``"documents"``
    takes out documents with a hit."""
    if remove not in ("spans", "documents"):
        raise ValueError("remove is 'spans' or 'documents'")
    text = F.col(f"`{text_col}`")
    windows, _ = benchmark_windows(benchmark, window)
    fa, fb = fingerprint(F.coalesce(text, F.lit("")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("stored"), text.alias("text"), fa, fb)
    found = hits(rows.select("fa", "fb", "text"), windows, ["fa", "fb"]).where("len > 0").select("fa", "fb", "pos", "len").distinct()
    runs = covered(found, ["fa", "fb"])
    run = F.sum(F.col("begins").cast("int")).over(Window.partitionBy("fa", "fb").orderBy("pos", "len"))
    spans = runs.withColumn("run", run).groupBy("fa", "fb", "run").agg(F.min("pos").alias("a"), F.max(F.col("pos") + F.col("len")).alias("b"))
    gone = stage_table(spans.groupBy("fa", "fb").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("spans")), "spans")
    both = left_join_held(rows, gone, ["fa", "fb"], "fa")
    if remove == "documents":
        return both.where("spans is null").select("stored.*")
    new = F.when(F.col("spans").isNull(), F.col("text")).otherwise(without(F.col("text"), F.col("spans")))
    return both.withColumn("new", new).select(*[(F.col("new") if c == text_col else F.col("stored").getField(c)).alias(c) for c in docs.columns])


def without(text: Column, spans: Column) -> Column:
    """``text`` without the word spans (a, b), which are sorted and apart: a
    text is its first gap, and then each word with the gap behind it."""
    def cut(gaps: Column) -> Column:
        units = F.zip_with(stored_words(text), F.slice(gaps, 2, F.size(gaps)), lambda w, g: F.concat(w, F.coalesce(g, F.lit(""))))
        return F.concat(gaps[0], let(units, kept))

    def kept(units: Column) -> Column:
        begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["b"]))
        ends = F.concat(F.transform(spans, lambda s: s["a"]), F.array(F.size(units).cast("long")))
        stay = F.zip_with(begins, ends, lambda a, b: F.array_join(F.slice(units, (a + 1).cast("int"), (b - a).cast("int")), ""))
        return F.array_join(stay, "")

    return let(F.split(text, WORD), cut)


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE_SQL = r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), b AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ), win AS (
        SELECT DISTINCT item_id, w[i:i + 9] AS g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
    ), lens AS (SELECT DISTINCT len(g) AS n FROM win), dw AS (
        SELECT r, i, n, w[i:i + n - 1] AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN lens)
    ), hit AS (
        SELECT r, i, n, item_id FROM dw JOIN win USING (g)
    ), cov AS (
        SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r
    ), its AS (
        SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY r
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN cov USING (r) LEFT JOIN its USING (r)
"""
