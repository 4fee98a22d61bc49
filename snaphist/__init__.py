"""Snapshot history on Spark: from periodic membership snapshots to a queryable history."""
