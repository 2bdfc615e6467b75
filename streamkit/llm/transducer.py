"""Token counts by a finite-state transducer compiled from a BPE vocabulary.

The number of tokens that a greedy pair-merging tokenizer gives is counted
without tokenizing.  Reading a text one character at a time, the encoding of
the prefix read so far always ends in one token; it is the piece ``s`` that
ends here, encodes to itself, and may stand after the last token before it
(the pair encodes to itself as well).  What the next characters can still
change depends only on

* the longest suffix that begins some piece, and
* for every place where such a suffix starts, how the last token before that
  place restricts the next, and the count there, relative to the count here.

That is a finite state.  The transducer is deterministic, its transitions are
annotated with the change of the token count, and it is built lazily: a state
is compiled when a text first reaches it, and the table starts anew when it
holds ``STATES`` states, which changes no count.

Long texts are split into chunks.  Between two characters that stand side by
side in no piece, every state becomes the same one, so a chunk's map from
entry state to exit state and count is three values: the text up to its first
such cut, the count between its first and last cut, and the text after the
last.  These maps compose associatively; composing them in order gives the
count of the whole text, wherever the chunks were processed.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamkit.llm.common import id_type, map_texts, read_table, text_rows, tokenizer_path

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Code points in a chunk, the limit of the report.
CHUNK, LIMIT = 1 << 16, 4096
#: Compiled states and whole segments kept per task, the longest segment kept.
STATES, WORDS, WORD_CHARS = 220_000, 300_000, 32
#: Characters between two looks at the number of states.
STRIDE = 4096


def reference_merge(text: str, score: dict[str, float]) -> list[str]:
    """Plain merging of the best pair, leftmost first: the definition that
    the transducer is compiled from, used on strings of two pieces."""
    parts = list(text)
    while True:
        best, at = None, -1
        for i in range(len(parts) - 1):
            s = score.get(parts[i] + parts[i + 1])
            if s is not None and (best is None or s > best):
                best, at = s, i
        if at < 0:
            return parts
        parts[at:at + 2] = [parts[at] + parts[at + 1]]


class State(dict):
    """Transitions of one state by character: (next state, change of the
    count), compiled on first use.  ``places``: (distance back, last token
    before that place or "" for any, relative count there)."""

    __slots__ = ("owner", "suffix", "places")

    def __missing__(self, c: str):
        out = self.owner.transition(self, c)
        self[c] = out
        return out


class Words(dict):
    """The change of the count by whole segments, from the state that all
    cuts lead to back to that state: transitions over many characters."""

    __slots__ = ("owner",)

    def __missing__(self, segment: str) -> int:
        out = self.owner.run(segment, self.owner.start)[1]
        if len(segment) <= WORD_CHARS:
            self[segment] = out
        return out


class Transducer:
    def __init__(self, score: dict[str, float]):
        self.score = score
        self.prefixes = {p[:i] for p in score for i in range(1, len(p) + 1)}
        self.beside = {p[i:i + 2] for p in score for i in range(len(p) - 1)}
        #: pieces that encode to themselves
        self.tokens = {p for p in score if len(p) == 1 or len(reference_merge(p, score)) == 1}
        if any(a != SPACE and b == SPACE for a, b in self.beside):
            raise ValueError("a piece holds a space after another character: words are no segments")
        self.words = Words()
        self.words.owner = self
        self.segments = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n" if not any("\n" in p for p in score) else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall
        self.reset()

    def reset(self) -> None:
        """Everything that was compiled goes; states still in use go on."""
        self.pairs: dict[tuple[str, str], bool] = {}
        self.classes: dict[tuple, str] = {}
        self.alike: dict[tuple[str, str], str] = {}
        self.spines: dict[str, list] = {}
        self.known: dict[tuple, State] = {}
        self.start = self.state("", ((0, "", 0),))

    def state(self, suffix: str, places: tuple) -> State:
        key = (suffix, places)
        out = self.known.get(key)
        if out is None:
            out = State()
            out.owner, out.suffix, out.places = self, suffix, places
            self.known[key] = out
        return out

    def may_follow(self, a: str, b: str) -> bool:
        """Whether the text of token ``a`` then ``b`` encodes to these two."""
        if not a or a[-1] + b[0] not in self.beside:
            return True
        out = self.pairs.get((a, b))
        if out is None:
            out = self.pairs[a, b] = reference_merge(a + b, self.score) == [a, b]
        return out

    def spine(self, token: str) -> list[tuple[str, float | None, float | None]]:
        """What stands last while ``token`` is merged: (symbol, score of the
        merge that made it, score of the merge that used it)."""
        out = self.spines.get(token)
        if out is None:
            parts, made, out = list(token), None, []
            while len(parts) > 1:
                scores = [self.score.get(a + b) for a, b in zip(parts, parts[1:])]
                best = max(x for x in scores if x is not None)
                i = scores.index(best)
                if i == len(parts) - 2:
                    out.append((parts[-1], made, best))
                    made = best
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            out.append((parts[0], made, None))
            self.spines[token] = out
        return out

    def like(self, token: str, begun: str) -> str:
        """The first token seen that restricts a next token beginning with
        ``begun`` as ``token`` does: only symbols that could merge with such a
        beginning matter, and when they exist.  "" where none does."""
        key = token, begun
        out = self.alike.get(key)
        if out is None:
            score, prefixes = self.score, self.prefixes
            meets = tuple(x for x in self.spine(token) if x[0] + begun in prefixes or any(x[0] + begun[:j] in score for j in range(1, len(begun) + 1)))
            out = self.alike[key] = self.classes.setdefault((begun, meets), token) if meets else ""
        return out

    def transition(self, state: State, c: str) -> tuple[State, int]:
        suffix, places, tokens = state.suffix, state.places, self.tokens
        found = None
        for back, token, count in places:
            s = (suffix[-back:] if back else "") + c
            if s in tokens and self.may_follow(token, s):
                found = s, count + 1
        if found is None:  # a character outside the vocabulary: one token per byte
            return self.state("", ((0, "", 0),)), len(c.encode())
        last, change = found
        longest, kept = "", [(0, last, 0)]
        for back, token, count in places:
            s = (suffix[-back:] if back else "") + c
            if s in self.prefixes:
                kept.append((back + 1, token and self.like(token, s), count - change))
                longest = max(longest, s, key=len)
        return self.state(longest, tuple(sorted(kept))), change

    def run(self, text: str, state: State) -> tuple[State, int]:
        total = 0
        for at in range(0, len(text), STRIDE):
            if len(self.known) > STATES:
                begun = state is self.start
                self.reset()
                state = self.start if begun else self.state(state.suffix, state.places)
            for c in text[at:at + STRIDE]:
                state, change = state[c]
                total += change
        return state, total

    def count(self, text: str) -> int:
        """Tokens of a text that begins at a cut."""
        if len(self.words) > WORDS:
            self.words.clear()
        return sum(map(self.words.__getitem__, self.segments(text)))

    def cut(self, text: str, lo: int, hi: int, step: int) -> int:
        """The first i from lo to hi (by step) with a cut before text[i], or -1."""
        beside = self.beside
        for i in range(lo, hi, step):
            if text[i - 1:i + 1] not in beside:
                return i
        return -1

    def chunk_map(self, text: str) -> tuple[str, int | None, str]:
        """(head, count, tail); without any cut (text, None, "")."""
        first = self.cut(text, 1, len(text), 1)
        if first < 0:
            return text, None, ""
        last = self.cut(text, len(text) - 1, 0, -1)
        return text[:first], self.count(text[first:last]), text[last:]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of two neighbouring chunks; associative.  A seam is text
        like any other, so it is mapped again, with the cuts it holds."""
        seam = self.chunk_map(a[2] + b[0] if a[1] is not None else a[0] + b[0])
        if a[1] is None and b[1] is None:
            return seam
        if a[1] is None:
            return (seam[0], b[1], b[2]) if seam[1] is None else (seam[0], seam[1] + self.count(seam[2]) + b[1], b[2])
        if b[1] is None:
            return (a[0], a[1], seam[0]) if seam[1] is None else (a[0], a[1] + self.count(seam[0]) + seam[1], seam[2])
        return a[0], a[1] + self.count(a[2] + b[0]) + b[1], b[2]

    def total(self, parts: tuple) -> int:
        head, count, tail = parts
        return self.count(head) + (count or 0) + self.count(tail)


@lru_cache(maxsize=2)
def compiled(name: str) -> Transducer:
    """The transducer of a sentencepiece BPE model with byte fallback, a
    space before the text and no other normalisation."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name))
    plain = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    return Transducer({model.id_to_piece(i): model.get_score(i) for i in plain})


def count_tokens(docs: DataFrame, name: str = MODEL, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every text.

    Chunks are rows of their own and are mapped independently; the maps, a
    few bytes each, are grouped by document and composed in order.  Defined
    results: a null or empty text has 0 tokens; a row stored twice, or without
    id, returns once per row; further columns play no part."""
    rows = text_rows(docs, id_col, text_col)
    parts = F.greatest(F.ceil(F.length("text") / F.lit(chunk)).cast("int"), F.lit(1))
    begin = (F.col("part") * F.lit(chunk) + 1).cast("int")
    pieces = (rows.withColumn("row", F.monotonically_increasing_id()).withColumn("parts", parts)
              .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .select("row", "doc_id", "part", F.octet_length("text").cast("long").alias("n_bytes"),
                      F.when(F.col("parts") == 1, F.col("text")).otherwise(F.substring("text", begin, F.lit(chunk))).alias("text")))

    def make():
        machine = compiled(name)

        def maps(rows: dict) -> dict:
            out: dict[str, list] = {x: rows[x] for x in ("row", "doc_id", "part", "n_bytes")} | {"head": [], "count": [], "tail": []}
            for part, text in zip(rows["part"], rows["text"]):
                text = text.replace(" ", SPACE)
                one = machine.chunk_map(SPACE + text if part == 0 and text else text)
                for x, v in zip(("head", "count", "tail"), one):
                    out[x].append(v)
            return out

        return maps

    kind = id_type(rows)
    mapped = map_texts(pieces, make, f"row long, doc_id {kind}, part int, n_bytes long, head string, count long, tail string")
    grouped = mapped.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"),
                                        F.array_sort(F.collect_list(F.struct("part", "head", "count", "tail"))).alias("maps"))

    def make_scan():
        machine = compiled(name)

        def scan(rows: dict) -> dict:
            out = {"doc_id": rows["doc_id"], "n_bytes": rows["n_bytes"], "n_tokens": []}
            for maps in rows["maps"]:
                todo = [(m["head"], m["count"], m["tail"]) for m in maps]
                while len(todo) > 1:  # neighbours by pairs, as a parallel scan composes them
                    todo = [machine.compose(*todo[i:i + 2]) if i + 1 < len(todo) else todo[i] for i in range(0, len(todo), 2)]
                out["n_tokens"].append(machine.total(todo[0]))
            return out

        return scan

    return map_texts(grouped.select("doc_id", "n_bytes", "maps"), make_scan, f"doc_id {kind}, n_bytes long, n_tokens long")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(read_table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
