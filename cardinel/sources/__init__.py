"""Kafka messages, JSON and CSV files, and the incremental watchlist export."""

from cardinel.sources.export import (
    export_entries,
    landed_mark,
    new_entries,
    read_landed,
    read_watchlist_csv,
)
from cardinel.sources.kafka import KafkaSource, envelope
from cardinel.sources.watchlist import (
    infer_schema,
    parse_watchlist,
    read_json_lines,
    stream_json_lines,
)

__all__ = [
    "KafkaSource",
    "envelope",
    "export_entries",
    "infer_schema",
    "landed_mark",
    "new_entries",
    "parse_watchlist",
    "read_json_lines",
    "read_landed",
    "read_watchlist_csv",
    "stream_json_lines",
]
