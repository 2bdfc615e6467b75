"""Column functions: tokenising, case, parsing, event time, growth."""

from streamkit.functions.text import (
    WHITESPACE,
    java_split,
    tokens,
    token_at,
    cased_tokens,
    parse_key_int,
    random_int,
    text_lines,
)
from streamkit.functions.time import epoch_millis_to_ts, leading_epoch_millis, to_interval, interval_micros, ntz_micros, micros_between
from streamkit.functions.growth import compound_growth

__all__ = [
    "WHITESPACE", "java_split", "tokens", "token_at", "cased_tokens", "parse_key_int", "random_int", "text_lines",
    "epoch_millis_to_ts", "leading_epoch_millis", "to_interval", "interval_micros", "ntz_micros", "micros_between",
    "compound_growth",
]
