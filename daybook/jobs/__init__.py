"""Data jobs: quality reports, work lists, freshness, trips, snapshots."""
