"""Chat formatting: speaker roles of plain transcripts by a hidden Markov model.

A transcript is lines of text; some lines carry a speaker marker, others don't.
The hidden state of a line is its speaker's role and whether it begins a turn;
the observation is a code of the line's features: the kind of marker, a blank
line before it, a closing question mark, its length.  ``fit`` counts starts,
transitions and observations on a bounded sample of transcripts whose roles
are known; ``parse`` recovers the most probable states by Viterbi and renders
the turns in one canonical form.

A conversation is cut into parts of ``TURNS`` turn numbers, and a part whose
turn numbers repeat into cuts of ``TURNS`` rows, by the row numbers of a blocked
scan.  Each cut gives a matrix of the best score from any state before it to
any state at its end; these compose in order, ``FAN`` at a time and level by
level, so the best path of a long conversation fixes the states at the cuts'
ends, and the cuts are decoded on their own between them.

Defined results: rows stored twice (same conversation, turn, role and text)
are one row; rows of one turn are ordered by role, then text, nulls first;
rows without conversation id form one conversation without id, and a null
turn is turn 0; a null text is empty; a role that is not one of ``ROLES``
writes no marker and is recovered as one of them; an empty table gives an
empty result; further columns play no part.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamkit.llm.common import map_texts, read_table, stage_table
from streamkit.operators.scan import Scan, keyed_scan

ROLES = ("system", "user", "assistant")
#: Speaker markers by style, in the order of ``ROLES``.
STYLES = (("System:", "User:", "Assistant:"), ("Instructions:", "Human:", "AI:"), ("### System", "### User", "### Assistant"), ("Context:", "Q:", "A:"))
#: Turns in a part, transcripts that a model is fitted on.
TURNS, SAMPLE = 256, 2000
#: Matrices composed together.
FAN = 256
#: A state is 2 * role + (1 inside a turn, 0 at its begin).
STATES = 2 * len(ROLES)
CODES = (len(ROLES) + 1) * 2 * 2 * 3
_MARKS = {m: r for style in STYLES for r, m in enumerate(style)}
MARKER = re.compile("(" + "|".join(re.escape(m) for m in sorted(_MARKS, key=len, reverse=True)) + r")[ \t]*")


def write(conversation: str, turns: list[tuple[int, str | None, str]], first: bool) -> tuple[list[str], list[int]]:
    """A plain transcript of (turn, role, text): its lines, and the state of
    each that isn't blank.  The style follows the conversation; about one turn
    in seven, never the first, stands after a blank line without a marker."""
    style = STYLES[zlib.crc32(conversation.encode()) % len(STYLES)]
    lines: list[str] = []
    states: list[int] = []
    for i, (turn, role, text) in enumerate(turns):
        known = role in ROLES
        marked = known and (first and i == 0 or zlib.crc32(f"{conversation}-{turn}".encode()) % 7 != 0)
        head = style[ROLES.index(role)] if marked else ""
        body = text.split("\n")
        if head:
            body[0] = f"{head} {body[0]}".rstrip()
        else:
            lines.append("")
        begun = False
        for line in body:
            lines.append(line)
            if line.strip():
                states.append((2 * ROLES.index(role) + begun) if known else -1)
                begun = True
    return lines, states


def observe(lines: list[str]) -> tuple[list[int], list[str]]:
    """The codes of the lines that aren't blank, and the lines without marker."""
    codes, texts, blank = [], [], False
    for line in lines:
        if not line.strip():
            blank = True
            continue
        m = MARKER.match(line)
        text = line[m.end():] if m else line
        size = 0 if len(text) <= 40 else 1 if len(text) <= 160 else 2
        kind = 1 + _MARKS[m[1]] if m else 0
        codes.append(((kind * 2 + blank) * 2 + text.rstrip().endswith("?")) * 3 + size)
        texts.append(text)
        blank = False
    return codes, texts


@dataclass
class Model:
    """Log probabilities of a step (from state, to state) and an observation
    (state, code).  The last state stands before a transcript's first line."""

    step: np.ndarray
    see: np.ndarray

    def matrix(self, codes: list[int]) -> np.ndarray:
        """The best log score from each state before the lines to each at
        their end."""
        out = np.where(np.eye(STATES + 1, dtype=bool), 0.0, -np.inf)
        for c in codes:
            out = (out[:, :, None] + self.step[None]).max(axis=1) + self.see[:, c]
        return out

    def path(self, codes: list[int], entry: int, end: int | None) -> list[int]:
        """The best states of the lines after state ``entry`` that end in
        ``end`` (None: anywhere)."""
        if not codes:
            return []
        score, back = self.step[entry] + self.see[:, codes[0]], []
        for c in codes[1:]:
            every = score[:, None] + self.step
            back.append(every.argmax(axis=0))
            score = every.max(axis=0) + self.see[:, c]
        out = [int(score.argmax()) if end is None else end]
        for b in reversed(back):
            out.append(int(b[out[-1]]))
        return out[::-1]


def parts(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, cut, first, turns): the distinct rows of each cut in
    order, ``TURNS`` at most; ``first`` marks a conversation's first cut."""
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(0))
    rows = conversations.select(F.col("conv_id").cast("string").alias("conv_id"), turn.alias("turn"), F.col("role").cast("string").alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    rows = stage_table(rows.withColumn("part", F.floor(F.col("turn") / TURNS).cast("long")), "rows")
    least = rows.groupBy("conv_id").agg(F.min("part").alias("p")).select(F.col("conv_id").alias("c"), "p", F.lit(0).cast("long").alias("z"))
    counted = keyed_scan(rows, ["conv_id", "part"], ["turn", "role", "text"], [Scan("count", None, "n")])
    cuts = (counted.withColumn("cut", F.floor((F.col("n") - 1) / TURNS).cast("long")).groupBy("conv_id", "part", "cut")
            .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")))
    both = cuts.join(least, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("cut") == F.col("z")), "left")
    return both.select("conv_id", "part", "cut", F.col("p").isNotNull().alias("first"), "turns")


def transcripts(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, cut, first, lines, states): conversations written as
    plain transcripts, with the true state of each line that isn't blank (-1
    where its role is not one of ``ROLES``)."""
    rows = parts(conversations)

    def make():
        def one(rows: dict) -> dict:
            out = {x: rows[x] for x in ("conv_id", "part", "cut", "first")} | {"lines": [], "states": []}
            for name, turns, first in zip(rows["conv_id"], rows["turns"], rows["first"]):
                lines, states = write(name or "", [(t["turn"], t["role"], t["text"]) for t in turns], first)
                out["lines"].append(lines)
                out["states"].append(states)
            return out

        return one

    return map_texts(rows, make, "conv_id string, part long, cut long, first boolean, lines array<string>, states array<int>")


def fit(known: DataFrame) -> Model:
    """Counts, each raised by a half, on ``SAMPLE`` cuts at most, by the
    order of a hash of their ids."""
    sample = known.orderBy(F.xxhash64("conv_id", "part"), "conv_id", "part", "cut").limit(SAMPLE)

    def make():
        def count(rows: dict) -> dict:
            n: dict[tuple, int] = {}
            for lines, states, first in zip(rows["lines"], rows["states"], rows["first"]):
                before = STATES if first else -1
                for c, s in zip(observe(lines)[0], states):
                    if s >= 0:
                        n["see", s, c] = n.get(("see", s, c), 0) + 1
                    if s >= 0 and before >= 0:
                        n["step", before, s] = n.get(("step", before, s), 0) + 1
                    before = s
            return {"kind": [k[0] for k in n], "a": [k[1] for k in n], "b": [k[2] for k in n], "n": list(n.values())}

        return count

    counted = map_texts(sample.select("lines", "states", "first"), make, "kind string, a int, b int, n long")
    table = {"step": np.full((STATES + 1, STATES + 1), 0.5), "see": np.full((STATES + 1, CODES), 0.5)}
    for r in counted.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect():  # a cell of the tables each
        table[r["kind"]][r["a"], r["b"]] += r["n"]
    for a in range(STATES + 1):  # a line inside a turn goes on in its role
        for b in range(1, STATES, 2):
            if b // 2 != a // 2:
                table["step"][a, b] = 0.0
    table["step"][:, STATES] = 0.0
    with np.errstate(divide="ignore"):
        step, see = (np.log(t / t.sum(axis=1, keepdims=True)) for t in (table["step"], table["see"]))
    return Model(step, see)


def ends(matrices: DataFrame) -> DataFrame:
    """(c, at, entry, end): the best path's states before and at the end of
    each of the matrices (conv_id, at, matrix), numbered from 0 within their
    conversation.  ``FAN`` neighbours at most are composed together, level by
    level up to one group a conversation; its states are then handed down."""

    def make_composed():
        def one(rows: dict) -> dict:
            out = []
            for chain in rows["chain"]:
                whole = np.array(chain[0]["matrix"]).reshape(STATES + 1, -1)
                for x in chain[1:]:
                    whole = (whole[:, :, None] + np.array(x["matrix"]).reshape(STATES + 1, -1)[None]).max(axis=1)
                out.append(whole.ravel().tolist())
            return {"conv_id": rows["conv_id"], "at": rows["up"], "matrix": out}

        return one

    def make_ends():
        def one(rows: dict) -> dict:
            out: dict[str, list] = {"c": [], "at": [], "entry": [], "end": []}
            for name, chain, entry, end in zip(*(rows[x] for x in ("conv_id", "chain", "entry", "end"))):
                score, back = np.where(np.arange(STATES + 1) == entry, 0.0, -np.inf), []
                for x in chain:
                    every = score[:, None] + np.array(x["matrix"]).reshape(STATES + 1, -1)
                    back.append(every.argmax(axis=0))
                    score = every.max(axis=0)
                path = [int(score.argmax()) if end is None else end]
                for b in reversed(back):
                    path.append(int(b[path[-1]]))
                path.reverse()
                for x, before, after in zip(chain, path, path[1:]):
                    for k, v in zip(out, (name, x["at"], before, after)):
                        out[k].append(v)
            return out

        return one

    levels, level = [], matrices
    while True:
        up = F.floor(F.col("at") / FAN).cast("long").alias("up")
        groups = stage_table(level.groupBy("conv_id", up).agg(F.array_sort(F.collect_list(F.struct("at", "matrix"))).alias("chain")), "chains")
        levels.append(groups)
        if not groups.agg(F.max("up")).first()[0]:
            break
        level = map_texts(groups, make_composed, "conv_id string, at long, matrix array<double>")
    fixed = levels[-1].select("conv_id", "chain", F.lit(STATES).alias("entry"), F.lit(None).cast("int").alias("end"))
    for groups in [*reversed(levels[:-1]), None]:
        solved = map_texts(fixed, make_ends, "c string, at long, entry int, end int")
        if groups is not None:
            fixed = groups.join(solved, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("up") == F.col("at"))).select("conv_id", "chain", "entry", "end")
    return solved


def parse(written: DataFrame, model: Model) -> DataFrame:
    """One row per recovered turn, or piece of one that goes on from the cut
    before: (conv_id, part, cut, piece, role, continued, n_lines, text,
    rendered, states) of (conv_id, part, cut, lines)."""

    def make_matrices():
        return lambda rows: {x: rows[x] for x in ("conv_id", "part", "cut")} | {"matrix": [model.matrix(observe(x)[0]).ravel().tolist() for x in rows["lines"]]}

    def make_turns():
        def one(rows: dict) -> dict:
            names = ("conv_id", "part", "cut", "piece", "role", "continued", "n_lines", "text", "rendered", "states")
            out: dict[str, list] = {x: [] for x in names}
            for name, part, cut, lines, entry, end in zip(*(rows[x] for x in ("conv_id", "part", "cut", "lines", "entry", "end"))):
                codes, texts = observe(lines)
                states = model.path(codes, STATES if entry is None else entry, end)
                begins = [i for i, s in enumerate(states) if i == 0 or s % 2 == 0]
                for piece, (lo, hi) in enumerate(zip(begins, [*begins[1:], len(states)])):
                    role, on, text = ROLES[states[lo] // 2], states[lo] % 2 == 1, "\n".join(texts[lo:hi])
                    closing = "" if piece == 0 and entry in (None, STATES) else "<|im_end|>\n"
                    rendered = f"\n{text}" if on else f"{closing}<|im_start|>{role}\n{text}"
                    for k, v in zip(names, (name, part, cut, piece, role, on, hi - lo, text, rendered, states[lo:hi])):
                        out[k].append(v)
            return out

        return one

    matrices = stage_table(map_texts(written.select("conv_id", "part", "cut", "lines"), make_matrices, "conv_id string, part long, cut long, matrix array<double>"), "matrices")
    placed = stage_table(keyed_scan(matrices, ["conv_id"], ["part", "cut"], [Scan("count", None, "n")]).withColumn("at", F.col("n") - 1).drop("n"), "placed")
    solved = ends(placed.select("conv_id", "at", "matrix")).withColumnRenamed("at", "i")
    known = placed.join(solved, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("at") == F.col("i"))).select("c", F.col("part").alias("p"), F.col("cut").alias("z"), "entry", "end")
    fixed = written.join(known, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("cut") == F.col("z")))
    fixed = fixed.select("conv_id", "part", "cut", "lines", "entry", "end")
    return map_texts(fixed, make_turns, "conv_id string, part long, cut long, piece int, role string, continued boolean, n_lines int, text string, rendered string, states array<int>")


def op9_transcript_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation written as a plain transcript, its roles recovered."""
    table = read_table(spark, sf_dir, "conversations")
    written = stage_table(transcripts(table), "transcripts")
    return parse(written, fit(written)).select("conv_id", "part", "cut", "piece", "role", "continued", "n_lines", "text", "rendered")
