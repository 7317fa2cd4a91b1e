"""DataFrame operators."""

from priceloom.operators.calendar import calendar
from priceloom.operators.joins import enrich, orphans
from priceloom.operators.merge import MergeResult, merge_by_key
from priceloom.operators.picking import distinct_members, duplicate_keys, pick_one
from priceloom.operators.ranking import rank_in_group, rank_with_gap, top_n
from priceloom.operators.stats import cheapest_groups, gap_to_group_mean, group_stats, kpis
from priceloom.operators.watermark import after, high_watermark

__all__ = [
    "MergeResult", "after", "calendar", "cheapest_groups", "distinct_members", "duplicate_keys", "enrich",
    "gap_to_group_mean", "group_stats", "high_watermark", "kpis", "merge_by_key", "orphans", "pick_one",
    "rank_in_group", "rank_with_gap", "top_n",
]
