"""Structured Streaming: sources, sinks, runners, scoring, archive."""

from .archive import archive_batch, archive_history, archive_rows, fold_days
from .late import read_counts, read_rows, split_late
from .runner import (kafka_stream, parquet_stream, run_available, start_append,
                     start_console, start_upsert, text_stream)
from .scoring import (ALERT_THRESHOLD, alert_messages, prepare_scoring_input, score,
                      scoring_batch, skipped_rows)

__all__ = [n for n in dir() if not n.startswith("_")]
