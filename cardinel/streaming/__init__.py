"""Running streams: table sinks, declared tables, the outbox and progress."""

from cardinel.streaming.batches import append_batches, rule_totals
from cardinel.streaming.folds import Fold, FoldLost, first_rows, sums
from cardinel.streaming.history import History, append_joined
from cardinel.streaming.outbox import attach_outbox, outbox_stats, read_outbox, write_outbox
from cardinel.streaming.progress import (
    ProgressKeeper,
    kept_counts,
    kept_late_rows,
    late_rows,
    observed_counts,
    read_reports,
    state_rows,
)
from cardinel.streaming.runner import (
    StateChanged,
    append_to_path,
    append_to_table,
    finish,
    kept_state,
)
from cardinel.streaming.tables import create_layers, declare, reset, table_properties

__all__ = [
    "Fold",
    "FoldLost",
    "History",
    "ProgressKeeper",
    "StateChanged",
    "append_batches",
    "append_joined",
    "append_to_path",
    "append_to_table",
    "attach_outbox",
    "create_layers",
    "declare",
    "finish",
    "first_rows",
    "kept_counts",
    "kept_late_rows",
    "kept_state",
    "late_rows",
    "observed_counts",
    "outbox_stats",
    "read_outbox",
    "read_reports",
    "reset",
    "rule_totals",
    "state_rows",
    "sums",
    "table_properties",
    "write_outbox",
]
