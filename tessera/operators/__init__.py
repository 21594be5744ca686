"""DataFrame -> DataFrame operators: relational, spatial, dissolve, nearest, strategy."""

import sys

from pyspark import cloudpickle

from .dissolve import dissolve
from .nearest import nearest
from .relational import (bucket_count, code_lookup, conditional_rate, count_by, not_in, rank_within,
                         semi_filter, top_k, word_count)
from .spatial import plan_grid, prepare_polygons, spatial_join, tag_points
from .strategy import (JOIN_STRATEGIES, SUPPORTED_STRATEGIES, broadcast_if_bounded, physical_join_nodes,
                       strategy_sweep, with_strategy)
from .union import rings, union_aggregate

__all__ = [
    "dissolve", "nearest", "bucket_count", "code_lookup", "conditional_rate", "count_by", "not_in",
    "rank_within", "semi_filter", "top_k", "word_count", "plan_grid", "prepare_polygons", "spatial_join", "tag_points",
    "rings", "union_aggregate",
    "JOIN_STRATEGIES", "SUPPORTED_STRATEGIES", "broadcast_if_bounded", "physical_join_nodes",
    "strategy_sweep", "with_strategy",
]

# The small helpers that tasks run travel to the executors with the job; nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
