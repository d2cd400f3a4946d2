"""daybook — a Spark-native personal-activity warehouse.

Bronze tables are append-only Parquet read as "latest version per key";
silver and gold models are plain DataFrame functions of a ``Cfg``; jobs
(trips, work lists, snapshots, freshness) are Spark jobs over the same
tables. See README.md for the layout.
"""

__version__ = "0.1.0"
