"""Column-level functions (``Column -> Column``)."""

from .clean import (SIGNED_NUMBER, STRICT_UNSIGNED, bracketed_number, clean_numeric,
                    gated_cast, nan_to_null, normalise_trailing_dot, split_triplet,
                    strip_brackets, to_float, with_clean_columns)
from .geo import EARTH_RADIUS_KM, distance_band, haversine_km
from .labels import energy_joules, sigma_flag, threshold_flag, trend_label
from .timefn import (cutoff_date, epoch_ms_to_ts, quarter_label, truncate_to,
                     ts_to_epoch_ms)

__all__ = [n for n in dir() if not n.startswith("_")]
