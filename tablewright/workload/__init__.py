"""Queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from tablewright.workload import (
    clustering,
    columns,
    increments,
    preset,
    quality,
    rollups,
    storage,
)
from tablewright.workload.tables import Query

ALL: dict[str, Query] = {
    **columns.QUERIES,
    **rollups.QUERIES,
    **quality.QUERIES,
    **increments.QUERIES,
    **clustering.QUERIES,
    **storage.QUERIES,
    **preset.QUERIES,
}
