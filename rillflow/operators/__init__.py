"""Relational building blocks, each a DataFrame -> DataFrame function."""

from rillflow.operators.aggregates import balance_fold, balance_reduce, count_by
from rillflow.operators.folds import fold_by
from rillflow.operators.joins import (
    asof_join,
    interval_join,
    lookup_join,
    snapshot_lookup,
    table_join,
)
from rillflow.operators.running import running_sum
from rillflow.operators.tables import filter_table, keyed, latest_per_key
from rillflow.operators.topk import top_k, top_k_array
from rillflow.operators.windows import (
    closed_windows,
    hopping_count,
    session_count,
    session_count_stream,
    tumbling_count,
)

__all__ = [
    "balance_fold", "balance_reduce", "count_by", "asof_join", "keyed", "fold_by",
    "interval_join", "lookup_join", "snapshot_lookup", "table_join", "running_sum",
    "filter_table", "latest_per_key", "top_k", "top_k_array", "closed_windows",
    "hopping_count", "session_count", "session_count_stream", "tumbling_count",
]
