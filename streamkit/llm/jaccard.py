"""N-gram Jaccard join by parity sketches.

A document's set holds the hashes of its distinct word shingles.  XOR-ing one
bit per shingle into a sketch gives a parity sketch: two sketches differ in at
most as many bits as the sets' symmetric difference has members.  Sets of
similarity ``percent`` differ in at most ``D`` members, and ``D`` follows from
their sizes, so per size band

* the sketch is divided into more than ``D`` parts, and a set gives the keys of
  its ``D + 1`` parts with the most members (and of those that tie).  Of these,
  one is equal in both sets (pigeonhole), and the other set gives its key too:
  if its least number of members is lower, directly, and else by the same
  argument from its side.  A part is a sketch of 2**64 positions of which only
  the XOR of the set positions' codes is kept;
* a second sketch of 512 bits, kept whole, bounds the difference of a
  candidate pair from below by its Hamming distance;
* pairs that are left are verified on the sets.

Hot groups.  Equal sets collapse to one representative before any pairing.
Keys that several sets of one batch share are sent as one mark per batch, so a
key's partition gets a row per batch at most, however many documents share
it.  Pairs are formed in three steps: first every member of a key with the
key's smallest member, which is linear; then, in keys of more than ``CROWD``
members that are still in several components, every member with one that a hash
of key and round picks, which is linear too and joins a large group of near
copies, as each member meets others in each of its keys; then, for keys whose
members are still in several components, the members of different components,
tested by size and Hamming distance inside the join.  A pair that is skipped is
already connected, so components are exact.

Hashes have 64 bits and set identities 128; equal ones are taken as equal.
Defined results: a document without words has 0 shingles and is linked with
nothing; with fewer words than a shingle the whole sequence is its one
shingle; a null text is empty; a row stored twice, or without id, is a
document of its own; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamkit.llm.common import fingerprint, id_type, map_texts, may_hold, read_table, stage_table, text_rows
from streamkit.llm.graph import components

#: Words of the Hamming sketch, ratio of a size band, spare parts.
SKETCH, BAND, SPARE = 8, 1.6, 1.25
#: Members of a key beyond which the rounds of picked members come first, and the most of them.
CROWD, ROUNDS = 16, 2
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str, k: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the word k-shingles: A-Z in lower
    case, words between ASCII white space."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return np.empty(0, _U)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), _U, len(words))
    whole = min(k, len(words))
    out = np.full(len(h) - whole + 1, whole, _U)
    for i in range(whole):
        out = mix(out * _U(0x9E3779B97F4A7C15) + h[i:len(h) - whole + 1 + i])
    return np.unique(out)


@lru_cache(maxsize=16)
def bands(percent: int, least: int = 1 << 31) -> list[tuple[int, int, int]]:
    """(smallest size, largest difference D of a pair whose smaller set is
    here, parts) of each size band up to ``least`` members."""
    out, lo = [], 1
    while lo < least:
        hi = max(lo + 1, int(np.ceil(lo * BAND)))
        top = hi - 1
        d = (100 - percent) * (top + top * 100 // percent) // (100 + percent)
        out.append((lo, d, int(np.ceil(SPARE * (d + 1))) + 3))
        lo = hi
    return out


def largest_difference(n: Column, percent: int) -> Column:
    """``D`` of the band of sets of ``n`` members."""
    out = F.lit(0)
    for lo, d, _ in bands(percent):
        out = F.when(n >= lo, F.lit(d)).otherwise(out)
    return out


def part_keys(h: np.ndarray, percent: int) -> np.ndarray:
    """The keys that a set gives: for its own band, and for the band below
    if its partner may be there."""
    n, all_bands, keys = len(h), bands(percent), []
    own = next(i for i in range(len(all_bands) - 1, -1, -1) if all_bands[i][0] <= n)
    lo = all_bands[own][0]
    for band in [own] + [own - 1] * (own > 0 and n * percent <= 100 * (lo - 1)):
        _, d, parts = all_bands[band]
        if d == 0:  # only equal sets link
            continue
        part = ((h >> _U(32)) * _U(parts)) >> _U(32)  # ascending, as h is sorted
        starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        at, members = part[starts], np.diff(np.append(starts, n))
        salt = _U(band) << _U(40)
        words = mix(np.bitwise_xor.reduceat(mix(h ^ _U(0xA5A5A5A5)), starts) ^ mix(salt + at))
        if len(at) > d:
            least = np.partition(members, len(at) - d - 1)[len(at) - d - 1]  # of the D + 1 largest
            keys.append(words[members >= least])
        else:  # fewer parts have members: the empty ones are keys as well
            empty = np.setdiff1d(np.arange(parts, dtype=_U), at)
            keys += [words, mix(mix(salt + empty) + _U(1))]
    return np.concatenate(keys) if keys else np.empty(0, _U)


def sketch(h: np.ndarray) -> np.ndarray:
    odd = np.bincount((h & _U(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def signed(x: np.ndarray) -> list[int]:
    return x.view(np.int64).tolist()


def signatures(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """One row per document: (row, fa, fb, doc_id, n, sa, sb, sketch, solo,
    shared, marks); sa, sb identify the set."""
    rows = text_rows(docs)
    rows = rows.select(F.monotonically_increasing_id().alias("row"), *fingerprint("doc_id", "text"), "doc_id", "text")

    def make():
        def signs(rows: dict) -> dict:
            out: dict[str, list] = {x: rows[x] for x in ("row", "fa", "fb", "doc_id")} | {x: [] for x in ("n", "sa", "sb", "sketch")}
            seen, keys = set(), []
            for text in rows["text"]:
                h = shingles(text, k)
                sa, sb = int(h.sum(dtype=_U)), int(mix(h + _U(7)).sum(dtype=_U))
                for x, v in zip(("n", "sa", "sb", "sketch"), (len(h), sa - (1 << 64) * (sa >> 63), sb - (1 << 64) * (sb >> 63), sketch(h).tolist() if len(h) else None)):
                    out[x].append(v)
                fresh = len(h) > 0 and (len(h), sa, sb) not in seen
                seen.add((len(h), sa, sb))
                keys.append(part_keys(h, percent) if fresh else np.empty(0, _U))
            every, inverse, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
            often = counts[inverse] > 1
            masks = np.split(often, np.cumsum([len(x) for x in keys])[:-1])
            out["solo"] = [signed(x[~m]) for x, m in zip(keys, masks)]
            out["shared"] = [signed(x[m]) for x, m in zip(keys, masks)]
            out["marks"] = [signed(every[counts > 1])] + [[]] * (len(keys) - 1)
            return out

        return signs

    return map_texts(rows, make, f"row long, fa long, fb long, doc_id {id_type(rows)}, n long, sa long, sb long, sketch array<long>, solo array<long>, shared array<long>, marks array<long>")


def live_keys(signed_docs: DataFrame) -> DataFrame:
    """(key, row) of the keys that at least two sets give.  One shuffle of
    the keys; keys already known to be shared move as one mark per batch."""
    pairs = F.concat(F.transform("solo", lambda x: F.struct(x.alias("key"), F.col("row").alias("row"))),
                     F.transform("marks", lambda x: F.struct(x.alias("key"), F.lit(-1).cast("long").alias("row"))))
    one = signed_docs.select(F.explode(pairs).alias("p")).select("p.key", "p.row")
    by_key = Window.partitionBy("key")
    counted = one.select("key", "row", F.count(F.lit(1)).over(by_key).alias("n"))
    return (counted.where((F.col("n") > 1) & (F.col("row") >= 0)).select("key", "row")
            .unionByName(signed_docs.select(F.explode("shared").alias("key"), "row")))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    left = sets.select(F.col("row").alias("a"), F.col("h").alias("ha"))
    right = sets.select(F.col("row").alias("b"), F.col("h").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    return (pairs.join(left, "a").join(right, "b")
            .where((100 + percent) * both.cast("long") >= percent * (F.size("ha") + F.size("hb"))).select("a", "b"))


def sets_of(docs: DataFrame, signs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """(row, h): the shingles of the representatives in ``pairs``, from their
    texts; other texts don't move."""
    wanted = pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct()
    wanted = stage_table(signs.select("row", "fa", "fb").join(wanted, "row", "left_semi"), "wanted")
    texts = may_hold(docs.select(*fingerprint("doc_id", F.coalesce("text", F.lit(""))), "text"), "fa", wanted)
    texts = texts.join(wanted.hint("shuffle_hash"), ["fa", "fb"]).select("row", F.coalesce("text", F.lit("")).alias("text"))

    def make():
        return lambda rows: {"row": rows["row"], "h": [shingles(t, k).view(np.int64) for t in rows["text"]]}

    return stage_table(map_texts(texts, make, "row long, h array<long>"), "sets")


def near(a: str, b: str, percent: int) -> Column:
    """Sizes and sketches of two representatives allow a link."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = sum(F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in range(SKETCH))
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (apart * (100 + percent) <= (100 - percent) * (na + nb))


def rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` (key, rep, n) with the ``root`` of their component."""
    return members.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", "n", F.coalesce("root", "rep").alias("root"))


def met(members: DataFrame, info: DataFrame, order: list[Column], percent: int) -> DataFrame:
    """Pairs (a, b), a the smaller: each member of a key with the key's first by
    ``order``, of another component if these are known, where a link is possible."""
    known = [c for c in ("root",) if c in members.columns]
    ends = members.groupBy("key").agg(F.min(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], "rep", "n", *known)).alias("e"), F.max("rep").alias("z"), F.min("rep").alias("y")).where("y < z")
    allowed = (F.least("n", "e.n") * 100 >= F.greatest("n", "e.n") * percent) & (F.col("rep") != F.col("e.rep"))
    for c in known:
        allowed = allowed & (F.col(c) != F.col(f"e.{c}"))
    pairs = members.join(ends.select("key", "e"), "key").where(allowed).select(F.least("rep", "e.rep").alias("a"), F.greatest("rep", "e.rep").alias("b")).distinct()
    return (pairs.join(info.select(F.col("rep").alias("a"), F.struct("n", "sketch").alias("x")), "a")
            .join(info.select(F.col("rep").alias("b"), F.struct("n", "sketch").alias("y")), "b").where(near("x", "y", percent)).select("a", "b"))


def links(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """One row per document: (row, fa, fb, doc_id, n_shingles, component_id,
    first); ``first`` marks the document that stands for its component.
    ``fa, fb`` identify the stored row."""
    docs = docs.select("doc_id", "text")
    signs = stage_table(signatures(docs, k, percent), "signatures")
    some = signs.where("n > 0")
    sets = some.groupBy("n", "sa", "sb").agg(F.min("row").alias("rep"))
    member = stage_table(some.select("row", "n", "sa", "sb").join(sets, ["n", "sa", "sb"]).select("row", "rep", "n"), "members")
    live = stage_table(live_keys(signs).join(member, "row").select("key", "rep", "n").distinct(), "live-keys")

    # round 1: each member of a key with the key's smallest
    info = signs.select(F.col("row").alias("rep"), "n", "sketch")
    star = stage_table(met(live, info, [F.col("rep")], percent), "star")
    links = stage_table(verified(star, sets_of(docs, signs, star, k), percent), "links")
    roots = components(links)
    label = stage_table(rooted(live, roots), "labels")
    open_keys = label.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("members")).where("lo < hi")
    open_keys = stage_table(open_keys.select("key", "members"), "open-keys")

    # more rounds for crowded keys: each member with a picked one of another component
    many = open_keys.where(F.col("members") > CROWD).select("key")
    crowded = stage_table(may_hold(label.select("key", "rep", "n"), "key", many).join(many, "key", "left_semi"), "crowded")
    for i in range(0 if crowded.isEmpty() else ROUNDS):
        tried = met(rooted(crowded, roots), info, [F.xxhash64("key", "rep", F.lit(i)), F.col("rep")], percent)
        tried = stage_table(tried.join(star, ["a", "b"], "left_anti"), "tried")
        found = stage_table(verified(tried, sets_of(docs, signs, tried, k), percent), "links")
        if found.isEmpty():
            break
        links = links.unionByName(found)
        roots = components(links)

    # last: members of a key that are still in several components
    rest = rooted(label.join(open_keys, "key", "left_semi").drop("root"), roots).join(info.select("rep", "sketch"), "rep")
    pair = (F.col("x.key") == F.col("y.key")) & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.root") != F.col("y.root")) & near("x", "y", percent)
    # linked sets share as many keys as the band's D + 1 exceeds their own largest difference
    n, m = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    need = largest_difference(n, percent) + 1 - F.floor((100 - percent) * (n + m) / (100 + percent))
    across = (rest.alias("x").join(rest.alias("y"), pair).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), need.alias("need"))
              .groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.first("need").alias("need")).where("shared >= need").select("a", "b"))
    across = stage_table(across.join(star, ["a", "b"], "left_anti"), "across")
    found = stage_table(verified(across, sets_of(docs, signs, across, k), percent), "links")
    roots = components(links.unionByName(found)) if not found.isEmpty() else roots

    of_rep = member.select("row", "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("row", F.coalesce("root", "rep").alias("root"))
    placed = signs.select("row", "fa", "fb", "doc_id", F.col("n").alias("n_shingles")).join(of_rep, "row", "left").withColumn("root", F.coalesce("root", "row"))
    # a table of its own, so that a component with very many members can be split in the join
    smallest = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("head"))
    smallest = stage_table(smallest, "components")
    return (placed.join(smallest, "root")
            .select("row", "fa", "fb", "doc_id", "n_shingles", "component_id", (F.col("row") == F.col("head.row")).alias("first")))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
