"""streamkit: keyed stream and table analytics expressed as Spark DataFrame plans.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark
expressions, so Catalyst prunes, pushes down and codegens it.  Batch and
Structured Streaming inputs share the stateless operators; the stateful
ones have a batch form (window functions / aggregations, skew-safe) and a
streaming form (watermarked aggregation or ``applyInPandasWithState``).
"""

__version__ = "0.1.0"

from streamkit.operators import (  # noqa: E402
    Agg,
    Scan,
    connect,
    count_window,
    first_match_selector,
    key_by,
    keyed_scan,
    rolling_extreme,
    rolling_extreme_by,
    rolling_fold,
    rolling_reduce,
    rolling_sum,
    select_outputs,
    session_window,
    split,
    time_window,
    union,
)
from streamkit.session import build_session, checkpoint_dir, cluster_conf  # noqa: E402

__all__ = [
    "Agg", "Scan", "connect", "count_window", "first_match_selector", "key_by", "keyed_scan", "rolling_extreme",
    "rolling_extreme_by", "rolling_fold", "rolling_reduce", "rolling_sum", "select_outputs", "session_window",
    "split", "time_window", "union", "build_session", "checkpoint_dir", "cluster_conf",
]
