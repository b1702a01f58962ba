"""DataFrame -> DataFrame operators with column names as parameters."""

from .feed import field_types, map_feed, replay_counts, time_slices
from .joins import attach_global, bounded_rows, join_small
from .ntile import ntile, ntile_from_rank, ntile_profile, rank_in_group
from .pairs import proximity_pairs
from .share import share_of_total
from .sigma import sigma_label
from .topk import latest_n, top_per_group
from .trend import period_change, with_previous
from .weighted import weighted_avg
from .windowed import (feed_status, flatten_window, near_point, window_avg,
                       window_avg_nst, window_count, window_count_above,
                       window_energy, window_metrics, window_near_point_count,
                       window_share_below, window_trend, windowed)

__all__ = [n for n in dir() if not n.startswith("_")]
