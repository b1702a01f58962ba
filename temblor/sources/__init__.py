"""Sources and sinks."""

from .feed import decode, flatten_geojson, publish_json, to_feature_collections
from .files import (land_raw, list_tables, preview, raw_history, read_parquet,
                    read_raw_csv, read_table)
from .replay import land_in_order, order_files, replay, slice_name, stage_slices
from .sinks import counted, read_store, upsert_days, write_curated, write_topic

__all__ = [n for n in dir() if not n.startswith("_")]
