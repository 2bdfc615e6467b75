"""DataFrame -> DataFrame operators."""

from streamkit.operators.scan import Scan, keyed_scan
from streamkit.operators.keyed import (
    key_by, resolve_key, rolling_sum, rolling_fold, rolling_reduce, rolling_extreme,
    rolling_extreme_by, rolling_map_in_pandas,
)
from streamkit.operators.routing import (
    union, split, select_outputs, first_match_selector, connect, Connected, write_split, read_output,
)
from streamkit.operators.transform import map_values, flat_map, flat_map_python, filter_rows, word_tokens, word_count
from streamkit.operators.windows import Agg, time_window, count_window, session_window
from streamkit.operators.monoid import Monoid, count_window_monoid, reduce_monoid, rolling_monoid, time_window_monoid

__all__ = [
    "Scan", "keyed_scan", "key_by", "resolve_key", "rolling_sum", "rolling_fold", "rolling_reduce",
    "rolling_extreme", "rolling_extreme_by", "rolling_map_in_pandas", "union", "split", "select_outputs",
    "first_match_selector", "connect", "Connected", "write_split", "read_output", "map_values", "flat_map", "flat_map_python", "filter_rows", "word_tokens",
    "word_count", "Agg", "time_window", "count_window", "session_window",
    "Monoid", "reduce_monoid", "rolling_monoid", "time_window_monoid", "count_window_monoid",
]
