from .relational import (
    active_semi_join,
    baseline_avg,
    conditional_sums,
    dedupe_latest,
    keyed_update,
    latest_per_key,
    ordered_string_agg,
    running_sum,
    top_n_per_group,
    union_by_name,
    weighted_mean,
)
from .upsert import insert_only, recover, replace_groups, upsert

__all__ = [
    "active_semi_join", "baseline_avg", "conditional_sums", "dedupe_latest", "insert_only", "keyed_update", "latest_per_key",
    "ordered_string_agg", "recover", "replace_groups", "running_sum", "top_n_per_group", "union_by_name", "upsert", "weighted_mean",
]
