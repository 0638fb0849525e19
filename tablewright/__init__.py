"""A PySpark library for wide record tables.

Ingest and profile files, clean and deduplicate rows, derive bands, flags and
scores, roll tables up, enrich rows with their group's statistics, process
increments with Structured Streaming, publish typed marts and cluster rows.
"""
