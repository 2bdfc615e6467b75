"""Best-fit packing by the sum-of-squares rule.

Documents become token sequences, each ended by one separator id; only a
document longer than a sequence is cut, into full pieces and a rest.  A piece
goes where the squared counts of open bins per residual gap become smallest:
taking a bin of gap ``h`` (or a new one, of gap ``capacity``) for a piece of
``n`` tokens lowers the count of gap ``h`` and raises that of gap ``h - n``,
so the choice needs the counts alone.  Equal choices take the smallest gap.

Pieces are dealt by a hash of their identity into shards of about ``SHARD`` pieces, a number that follows the data, and each shard is
packed as a whole by its own task, longest piece first; a shard leaves at most
a few bins open, so the sequences exceed the unsharded number by about one in
a thousand.  Only piece rows move, never ids or texts.

Defined results: a null or empty text is the separator alone; a row stored
twice, or without id, is a document of its own each time; an empty table gives
an empty result; further columns play no part.
"""

from __future__ import annotations

import re
import unicodedata
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamkit.llm.common import id_type, map_texts, read_table, stage_table, task_model, text_rows, tokenizer_path

TOKENIZER = "word_bpe_49k.json"
#: Tokens in a sequence, the id that ends a document, pieces in a shard.
CAPACITY, SEPARATOR, SHARD = 4096, 1, 40_000
#: Runs without white space kept per worker, and the longest that is kept.
KEPT, KEPT_CHARS = 300_000, 48
#: Bytes of texts that are split together.
SPLIT = 1 << 20
#: White space for str.split(), but part of a word for the tokenizer's pattern.
SEPARATORS = re.compile("[\x1c-\x1f]")


def settled_characters() -> str:
    """A character class of the code points below U+10000 that Unicode 3.2
    already had: libraries of different age agree on what they are."""
    old = unicodedata.ucd_3_2_0
    known = [old.category(chr(i)) not in ("Cn", "Cs", "Co") for i in range(0x10000)] + [False]
    out, first = [], None
    for i, k in enumerate(known):
        if k and first is None:
            first = i
        elif not k and first is not None:
            out.append(f"\\u{first:04x}-\\u{i - 1:04x}")
            first = None
    return "".join(out)


class WordTokenizer:
    """Ids of a word-level BPE tokenizer whose words are encoded apart: no word
    holds white space, so the ids of each run between it are kept, and only new
    runs are split into words and encoded by the library.  Texts that hold one
    of its special strings, or a character that is new to some version of
    Unicode, go through the library whole."""

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"a normaliser of {steps} is not known here")
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.new_character = re.compile(f"[^{settled_characters()}]").search
        self.special = [x["content"] for x in spec["added_tokens"]]
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        # words are split and normalised before they get here, so for them blanks are enough
        plain = spec | {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, spec["pre_tokenizer"]["pretokenizers"][1]]}}
        self.words = Tokenizer.from_str(json.dumps(plain))
        close = spec["model"]["end_of_word_suffix"]
        vocab = spec["model"]["vocab"]
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for t, i in vocab.items() if t.endswith(close)]] = True
        self.kept: dict[str, bytes] = {}  # runs met in two calls
        self.once: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return self.ids_of([text])[0]

    def ids_of(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; one call of the library encodes the new runs of all."""
        whole, runs = {}, []
        for i, text in enumerate(texts):
            if any(s in text for s in self.special) or not text.isascii() and self.new_character(text):
                whole[i], text = np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), ""
            if not text.isascii():
                # the library lower-cases each character by itself; str.lower() looks around a capital sigma
                text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            text = text.lower()
            runs.append(self.split(text) if SEPARATORS.search(text) else text.split())
        kept, once = self.kept, self.once
        for held in (kept, once):
            if len(held) > KEPT // 2:
                held.clear()
        new = set().union(*runs).difference(kept)
        met = new.intersection(once)
        kept.update((x, once.pop(x)) for x in met)
        new = list(new - met)
        if new:
            kept.update(zip(new, self.encoded(new)))
        out = [whole[i] if i in whole else b"".join([kept[x] for x in each]) for i, each in enumerate(runs)]
        for x in new:
            ids = kept.pop(x)
            if len(x) <= KEPT_CHARS:
                once[x] = ids
        return out

    def encoded(self, runs: list[str]) -> list[bytes]:
        """The ids of each run; its words are all of it."""
        words = self.split(" ".join(runs))
        # each word ends with its one id that closes a word
        ids = np.array(self.words.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        upto, length = (np.cumsum(np.fromiter(map(len, x), np.int64, len(x))) for x in (words, runs))
        last = np.searchsorted(upto, length)
        if len(ends) != len(words) or not np.array_equal(upto[last], length):
            raise ValueError("the tokenizer does not split these words as its pattern does")
        packed, edges = ids.tobytes(), [0, *(4 * ends[last]).tolist()]
        return [packed[a:b] for a, b in zip(edges, edges[1:])]


@task_model
def tokenizer(name: str) -> WordTokenizer:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordTokenizer(tokenizer_path(name))


def pieces(docs: DataFrame, name: str = TOKENIZER, capacity: int = CAPACITY, separator: int = SEPARATOR, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: (doc_row, doc_id, piece, start, length, ids_crc32,
    ids); ``ids`` (little-endian 32-bit) only where asked for."""
    rows = text_rows(docs, id_col, text_col).withColumn("doc_row", F.monotonically_increasing_id())

    def make():
        ids_of, end = tokenizer(name).ids_of, np.array([separator], "<u4").tobytes()

        def cut(rows: dict) -> dict:
            out: dict[str, list] = {x: [] for x in ("doc_row", "doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for row, doc, ids in zip(rows["doc_row"], rows["doc_id"], ids_of(rows["text"])):
                ids += end
                for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    for x, v in zip(out, (row, doc, i, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None)):
                        out[x].append(v)
            return out

        return cut

    return map_texts(rows, make, f"doc_row long, doc_id {id_type(rows)}, piece int, start long, length long, ids_crc32 long, ids binary", SPLIT)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, placed in the given order."""
    counts = np.zeros(capacity + 1, np.int64)  # open bins by gap; gap 0 is closed and not counted
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, n in enumerate(lengths.tolist()):
        # change of the sum for each gap h >= n: -2 N(h) + 1, and for what is left 2 N(h - n) + 1 unless it is 0
        change = 2 * (counts[:capacity + 1 - n] - counts[n:]) + 2
        change[0] -= 2 * counts[0] + 1
        change[-1] -= 1  # a new bin lowers no count
        usable = counts[n:] > 0
        usable[-1] = True
        change[~usable] = np.iinfo(np.int64).max
        gap = int(change.argmin()) + n
        if gap == capacity:
            at, made = made, made + 1
        else:
            at = open_bins[gap].pop()
            counts[gap] -= 1
        bins[i], offsets[i] = at, capacity - gap
        if gap > n:
            open_bins[gap - n].append(at)
            counts[gap - n] += 1
    return bins, offsets


def pack(items: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """``items`` with (sequence_id, offset); it holds (doc_row, piece,
    length) and may hold more.  Read twice, so it should be a stage table."""
    shards = max(1, -(-items.count() // shard))
    split = items.withColumn("shard", F.pmod(F.xxhash64("doc_row", "piece"), F.lit(shards)))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_row", "piece"], ascending=[False, True, True], ignore_index=True)
        bins, offsets = sum_of_squares(rows["length"].to_numpy(), capacity)
        return rows.assign(sequence_id=(rows["shard"].to_numpy() << 32) + bins, offset=offsets)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in split.schema) + ", sequence_id long, offset long"
    return split.groupBy("shard").applyInPandas(place, schema).drop("shard")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the pieces of each sequence joined in order, from
    packed rows that kept their ``ids``.  A group holds one sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def packed_documents(docs: DataFrame) -> DataFrame:
    items = stage_table(pieces(docs, with_ids=False).drop("ids"), "pieces")
    return pack(items).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(read_table(spark, sf_dir, "documents"))
