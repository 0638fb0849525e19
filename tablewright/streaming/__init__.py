"""Incremental processing."""

from tablewright.streaming.increments import (
    BATCH,
    checkpoint_path,
    process_increments,
    progress,
    read_increments,
    recorded_progress,
    stage_increments,
)

__all__ = [
    "BATCH",
    "checkpoint_path",
    "process_increments",
    "progress",
    "read_increments",
    "recorded_progress",
    "stage_increments",
]
