"""Tokenising and parsing columns.

``java_split`` gives the piece list of the classic line-splitting rule
used by the word-count and flatMap operators: inner and leading empty
pieces are kept, trailing empty pieces are dropped, an all-separator
string gives no piece and the empty string gives one empty piece.
Spark's ``split`` keeps trailing empties, so they are stripped first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the single-character whitespace class (space, tab, newline,
# vertical tab, form feed, carriage return).  Written out so the same class
# is used by Spark (Java regex) and by the DuckDB oracle (RE2).
WHITESPACE = r"[ \t\n\x0B\f\r]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(col, pattern: str = WHITESPACE) -> Column:
    """Pieces of ``col`` split on each match of ``pattern`` (one match = one cut)."""
    c = _col(col)
    stripped = F.regexp_replace(c, f"(?:{pattern})+\\z", "")
    return (
        F.when(c.isNull(), F.lit(None))
        .when((stripped == "") & (c != ""), F.array().cast("array<string>"))
        .otherwise(F.split(stripped, pattern, -1))
    )


def tokens(col, pattern: str = WHITESPACE, drop_empty: bool = False) -> Column:
    """Token array; ``drop_empty`` removes the empty pieces between repeated separators."""
    arr = java_split(col, pattern)
    if drop_empty:
        arr = F.filter(arr, lambda t: t != "")
    return arr


def token_at(arr: Column, index: int, strict: bool = True) -> Column:
    """Element ``index`` (0-based).  Strict raises on a missing element (ANSI);
    lenient gives null."""
    return arr.getItem(index) if strict else F.get(arr, index)


_CASES = {"upper": F.upper, "lower": F.lower, "keep": lambda c: c}


def cased_tokens(col, spec=((0, "upper"), (1, "upper")), sep: str = " ", strict: bool = True) -> Column:
    """Array of selected tokens, each in the case given: ``spec`` is a sequence of
    ``(token index, 'upper'|'lower'|'keep')`` in output order.  Explode it with
    ``posexplode`` to emit one row per token with its position."""
    arr = java_split(col, sep)
    return F.array(*[_CASES[case](token_at(arr, i, strict)) for i, case in spec])


def parse_key_int(col, sep: str = " ", strict: bool = True, int_type: str = "int") -> tuple[Column, Column]:
    """``"key 12"`` → (key, 12).  Strict: a missing token or bad number raises;
    lenient: null."""
    arr = java_split(col, sep)
    key = token_at(arr, 0, strict)
    raw = token_at(arr, 1, strict)
    num = raw.cast(int_type) if strict else raw.try_cast(int_type)
    return key, num


def random_int(bound: int, seed: int | None = None) -> Column:
    """A pseudo-random int in ``[0, bound)`` per row (seeded: reproducible for
    a given partitioning)."""
    return F.floor(F.rand(seed) * bound).cast("int")


# Fixed value: line terminators of a text file (CR LF, CR, LF).
LINE_BREAK = r"\r\n|\r|\n"


def text_lines(col) -> Column:
    """Lines of a text, as a line-oriented file reader yields them: split at
    CR LF, CR or LF; a final terminator adds no empty line; an empty text
    has no lines."""
    c = _col(col)
    parts = F.split(c, LINE_BREAK, -1)
    ends_with_break = c.rlike(f"(?:{LINE_BREAK})\\z")
    trimmed = F.when(ends_with_break, F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return F.when(c.isNull(), F.lit(None)).when(c == "", F.array().cast("array<string>")).otherwise(trimmed)
