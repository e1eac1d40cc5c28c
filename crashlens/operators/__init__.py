"""Generic table operators the crash analyses are composed of.

Each takes and returns DataFrames (lazy, no action inside), so a whole
analysis stays one Catalyst plan.
"""

from crashlens.operators.aggregates import count_distinct_per, count_groups_having, global_count
from crashlens.operators.distinct import Matched, distinct_projection, distinct_rows
from crashlens.operators.joins import (
    counted_join,
    having_match,
    join_count,
    join_renaming,
    lacking_match,
)
from crashlens.operators.ranking import (
    dense_rank_all,
    number_per_group,
    rank_band,
    rank_band_wide,
    top_per_group,
    top_values_ranked,
)
from crashlens.operators.tagged import Tag, rows_of_tag, tagged_aggregates
from crashlens.operators.topk import best_k, in_top_k, ordered, top_k

__all__ = [
    "Tag",
    "best_k",
    "count_distinct_per",
    "count_groups_having",
    "counted_join",
    "dense_rank_all",
    "Matched",
    "distinct_projection",
    "distinct_rows",
    "global_count",
    "having_match",
    "in_top_k",
    "join_count",
    "join_renaming",
    "lacking_match",
    "number_per_group",
    "ordered",
    "rank_band",
    "rank_band_wide",
    "rows_of_tag",
    "tagged_aggregates",
    "top_k",
    "top_per_group",
    "top_values_ranked",
]
