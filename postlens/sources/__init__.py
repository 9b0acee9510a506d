"""Inputs, outputs and the session."""

from postlens.sources.readers import (
    BROKEN,
    read_landed_lines,
    read_landed_metrics,
    read_rejected_lines,
    read_sources,
    read_text_snapshot,
)
from postlens.sources.runs import Hold, finish_run, finished_runs, hold_latest, hold_run, retire_runs, schemas_of
from postlens.sources.session import build_session, checkpoint_folder, input_bytes, shuffle_partitions, size_shuffles, stage, staging
from postlens.sources.writers import (
    LANDED,
    OWN_LAYOUTS,
    READABLE,
    REJECTED,
    TABLE_LAYOUTS,
    create_view,
    read_landed_part,
    read_table,
    with_load_time,
    write_landed,
    write_table,
)

__all__ = [
    "BROKEN", "Hold", "LANDED", "OWN_LAYOUTS", "READABLE", "REJECTED", "TABLE_LAYOUTS", "build_session", "checkpoint_folder", "create_view",
    "finish_run", "finished_runs", "hold_latest", "hold_run", "input_bytes", "read_landed_lines", "read_landed_metrics",
    "read_landed_part", "read_rejected_lines", "read_sources", "read_table", "read_text_snapshot", "retire_runs", "schemas_of",
    "shuffle_partitions", "size_shuffles", "stage", "staging", "with_load_time", "write_landed", "write_table",
]
