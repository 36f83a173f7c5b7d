from admart.operators.aggregates import (concat_by_group, distinct_concat, distinct_count_and_sums, last_state, last_value,
                                         money_parts, money_sum, ordered_concat, segment_sums, zero_fill_sum)
from admart.operators.joins import backfill, channel_merge, lookup, merge_by_key
from admart.operators.periods import period_labels, period_rollup
from admart.operators.sets import union_years
from admart.operators.windows import clamp_outliers, dedupe_top1, median_ranks, rank_median

__all__ = ["backfill", "channel_merge", "clamp_outliers", "concat_by_group", "dedupe_top1", "distinct_concat", "distinct_count_and_sums",
           "last_state", "last_value", "lookup", "median_ranks", "merge_by_key", "money_parts", "money_sum", "ordered_concat",
           "period_labels", "period_rollup", "rank_median", "segment_sums", "union_years",
           "zero_fill_sum"]
