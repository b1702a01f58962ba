"""The curated batch questions over the cleaned trace table (reference column names).

Each function takes the cleaned table and returns a lazy DataFrame; nothing
here collects. ``as_of`` replaces a moving "today" so results are repeatable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import (bracketed_number, clean_numeric, split_triplet, to_float)
from ..functions.geo import distance_band, haversine_km
from ..functions.timefn import cutoff_date, quarter_label, truncate_to
from ..operators.ntile import ntile_profile
from ..operators.share import share_of_total
from ..operators.sigma import sigma_label
from ..operators.topk import top_per_group
from ..operators.trend import period_change
from ..operators.weighted import weighted_avg
from ..schemas import CLEANED_FLOAT_COLUMNS

TIME, NET, MAG = "source_origin_time", "network_code", "source_magnitude"

# Fixed value: S-wave speed (km/s) used to approximate S travel time.
S_WAVE_KM_PER_SEC = 3.5


def preprocess(raw: DataFrame, split_mechanism: bool = False) -> DataFrame:
    """Raw traces -> cleaned table (one projection, no shuffle)."""
    out = raw.withColumns({
        TIME: truncate_to(TIME, "second"),
        "trace_start_time": truncate_to("trace_start_time", "second"),
        "coda_end_sample": bracketed_number("coda_end_sample", "float"),
        **{c: to_float(c, "float") for c in CLEANED_FLOAT_COLUMNS},
    })
    if split_mechanism:
        col = "source_mechanism_strike_dip_rake"
        out = out.select("*", *split_triplet(col)).drop(col)
    return out


def biggest_per_year_network(q: DataFrame, as_of=None, years: int = 30) -> DataFrame:
    """Q1: largest event per (year, network) within the last ``years``*365 days; ties kept."""
    kept = q.filter(F.col(TIME).isNotNull() & F.col(MAG).isNotNull()
                    & clean_numeric("source_depth_km").isNotNull()
                    & (F.col(TIME) >= cutoff_date(as_of, years * 365)))
    top = top_per_group(kept, [F.year(TIME), F.col(NET)], [F.col(MAG).desc()])
    return (top.select(F.year(TIME).alias("year"), F.month(TIME).alias("month"),
                       F.dayofmonth(TIME).alias("day"), NET, "source_id", MAG,
                       "source_depth_km")
               .orderBy("year", NET))


def quarterly_magnitude_trend(q: DataFrame, as_of=None, years: int = 10) -> DataFrame:
    """Q2: average magnitude per (quarter, network) and change from the previous quarter."""
    kept = q.filter((F.col(TIME) >= cutoff_date(as_of, years * 365)) & F.col(MAG).isNotNull())
    out = period_change(kept, quarter_label(TIME), {"avg_magnitude": F.avg(MAG)},
                        "avg_magnitude", by=[NET], period_name="quarter",
                        prev_name="prev_quarter_avg", change_name="change_from_prev_quarter")
    return out.select("quarter", NET, "avg_magnitude", "prev_quarter_avg",
                      "change_from_prev_quarter").orderBy(NET, "quarter")


def azimuthal_gap_outliers(q: DataFrame, k: float = 2.0, ordered: bool = False) -> DataFrame:
    """Q3: gap beyond mean + k*sigma over all usable rows; sorted for display
    only if asked, since that sorts the whole table."""
    kept = (q.withColumn("__gap", clean_numeric("source_gap_deg"))
              .filter(F.col("__gap").isNotNull()))
    out = sigma_label(kept, "__gap", k=k, mean_name="avg_gap", std_name="std_dev_gap",
                      label_name="gap_category")
    out = out.select("source_id", MAG, "source_gap_deg", "source_horizontal_uncertainty_km",
                     "source_depth_uncertainty_km", "avg_gap", "std_dev_gap", "gap_category")
    return out.orderBy(F.desc("gap_category"), F.desc(MAG)) if ordered else out


def depth_magnitude_profile(q: DataFrame, tiles: int = 3, tiebreak: str = "source_id",
                            **kw) -> DataFrame:
    """Q4: ntile of (numeric) depth within each network; magnitude avg/min/max per tile."""
    kept = (q.withColumn("__depth", clean_numeric("source_depth_km"))
              .filter(F.col("__depth").isNotNull()))
    out = ntile_profile(kept, tiles, ["__depth", tiebreak],
                        {"avg_magnitude": F.avg(MAG), "min_magnitude": F.min(MAG),
                         "max_magnitude": F.max(MAG)}, by=[NET], tile_name="depth_quartile", **kw)
    return out.orderBy(NET, "depth_quartile")


def p_s_time_difference(q: DataFrame) -> DataFrame:
    """Q5: per year avg/max of (distance/3.5 - P travel) and change from the previous year."""
    kept = (q.filter(F.col("p_travel_sec").isNotNull() & F.col("source_distance_km").isNotNull())
              .withColumn("__diff", F.col("source_distance_km") / S_WAVE_KM_PER_SEC
                          - F.col("p_travel_sec")))
    out = period_change(kept, F.year(TIME), {"avg_time_difference": F.avg("__diff"),
                                             "max_time_difference": F.max("__diff")},
                        "avg_time_difference", period_name="year",
                        change_name="change_from_prev_year")
    return out.select("year", "avg_time_difference", "max_time_difference",
                      "change_from_prev_year").orderBy("year")


def magnitude_with_distance(q: DataFrame) -> DataFrame:
    """Q6: per year avg of magnitude / (1 + distance) and avg magnitude."""
    out = weighted_avg(q.withColumn("year", F.year(TIME)), MAG, "source_distance_km", ["year"])
    return out.orderBy("year")


def distance_error_profile(q: DataFrame, tiles: int = 10, tiebreak: str | None = "source_id",
                           **kw) -> DataFrame:
    """Q7: global ntile of distance (nulls first) over rows with a usable error."""
    kept = (q.withColumn("source_error_sec", clean_numeric("source_error_sec"))
              .filter(F.col("source_error_sec").isNotNull()))
    order = ["source_distance_km"] + ([tiebreak] if tiebreak else [])
    out = ntile_profile(kept, tiles, order,
                        {"avg_error_sec": F.avg("source_error_sec"),
                         "event_count": F.count(F.lit(1))},
                        tile_name="distance_quintile", **kw)
    return out.orderBy("distance_quintile")


def events_by_region(q: DataFrame) -> DataFrame:
    """Q8: rows per network, the total, and the percentage."""
    return share_of_total(q, [NET]).orderBy(F.desc("event_count"))


def processing_time_anomalies(q: DataFrame, k: float = 2.0, ordered: bool = False) -> DataFrame:
    """Q9: whole seconds from origin to trace start, k-sigma label per network;
    sorted for display only if asked."""
    kept = (q.filter(F.col(TIME).isNotNull() & F.col("trace_start_time").isNotNull())
              .withColumn("processing_time", F.unix_timestamp("trace_start_time")
                          - F.unix_timestamp(TIME)))
    out = sigma_label(kept, "processing_time", by=[NET], k=k,
                      mean_name="avg_processing_time", std_name="std_dev_processing_time",
                      label_name="processing_status")
    out = out.select(NET, "source_id", "processing_time", "avg_processing_time",
                     "std_dev_processing_time", "processing_status")
    return out.orderBy(F.desc(NET), F.desc("processing_time")) if ordered else out


def station_distance(q: DataFrame, near: float = 50.0, far: float = 100.0) -> DataFrame:
    """Q10: station-to-source great-circle km and its band (native expression)."""
    kept = q.filter(F.col("receiver_latitude").isNotNull()
                    & F.col("receiver_longitude").isNotNull()
                    & F.col("source_latitude").isNotNull()
                    & F.col("source_longitude").isNotNull())
    d = haversine_km("receiver_latitude", "receiver_longitude",
                     "source_latitude", "source_longitude")
    return (kept.withColumn("distance_km", d)
                .withColumn("distance_category", distance_band("distance_km", near, far))
                .select(NET, "source_id", "distance_km", "source_error_sec",
                        "distance_category"))


# Names of the curated tables (fixed values).
CURATED = {
    "BiggestEarthquakesIn30Years": biggest_per_year_network,
    "AverageMagnitudeTrendIn10Years": quarterly_magnitude_trend,
    "AzimuthalGapEarthquakes": azimuthal_gap_outliers,
    "DepthMagnitudeCorrelation": depth_magnitude_profile,
    "TimeDifferenceBetweenPAndS": p_s_time_difference,
    "AverageMagnitudeWithDistance": magnitude_with_distance,
    "DistanceAndErrorCorrelation": distance_error_profile,
    "EventsByRegion": events_by_region,
    "TimeProcessingAnomalies": processing_time_anomalies,
    "EarthquakeStationDistance": station_distance,
}


def dedup_events(q: DataFrame, key: str = "source_id") -> DataFrame:
    """Opt-in: one row per event (the table's grain is station x event)."""
    return q.dropDuplicates([key])
