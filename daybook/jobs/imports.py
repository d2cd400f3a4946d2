"""Import jobs (PIP-10..13) with observed counts and the mismatch guard
(SNK-05): parse distributed, count with ``observe`` in the same pass as
the write, fail when an adopted input parses to nothing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from daybook.config import Cfg
from daybook.session import scratch_path
from daybook.sources import archive, google, spotify
from daybook.sources.snapshot import _fs
from daybook.sources.tables import append


def _land(df: DataFrame, cfg: Cfg, table: str, name: str, require_rows: bool) -> int:
    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    append(observed, cfg, table, skip_empty=False)   # the write job fills the observation
    rows = int(obs.get.get("rows", 0))
    if require_rows and rows == 0:
        raise ValueError(f"{table}: the adopted input parsed to no rows")
    return rows


def import_extended_history(spark: SparkSession, cfg: Cfg, root: str, require_rows: bool = True) -> dict:
    """Full-history import (PIP-10): every ``Streaming_History_Audio_*.json``
    under ``root`` (zips expanded first), episodes and undated rows skipped."""
    s = spotify.schema(spotify.EXTENDED_HISTORY_DDL)
    files = archive.read_many(spark, root, "Streaming_History_Audio_*.json", s)
    zipped = archive.expand_zips(spark, root).filter(F.col("member").rlike("Streaming_History_Audio_.*\\.json$"))
    entries = files.unionByName(archive.parse_json_array(zipped, s))
    obs = Observation("history_in")
    entries = entries.observe(obs, F.count(F.lit(1)).alias("entries"))
    kept = _land(spotify.extended_history_rows(entries), cfg, "spotify_plays_raw", "history_kept", require_rows)
    total = int(obs.get.get("entries", 0))
    return {"entries": total, "kept": kept, "skipped": total - kept}


def import_google_archive(spark: SparkSession, cfg: Cfg, root: str, require_rows: bool = False) -> dict:
    """One tree, three outputs (PIP-11): Maps activity, YouTube watches and
    searches from the MyActivity files under ``root`` and in its zips.

    The tree is read and parsed once, into a staging folder of this import
    where Maps entries lie apart; Maps activity reads its own part only, the
    titles decide about the other two, as in the exports."""
    s = spotify.schema(google.MY_ACTIVITY_DDL)
    files = archive.read_many(spark, root, "*.json", s)
    zipped = archive.parse_json_array(archive.expand_zips(spark, root), s)
    stage = scratch_path(spark, "google-archive")
    part = F.when(F.col("header") == "Maps", "maps").otherwise("rest")
    files.unionByName(zipped).withColumn("__part", part).write.partitionBy("__part").parquet(stage)
    staged = spark.read.schema(StructType([*s.fields, StructField("__part", StringType())])).parquet(stage)
    watches, searches = google.youtube_archive(staged.drop("__part"))
    maps = google.maps_activity_rows(staged.filter("__part = 'maps'").drop("__part"))
    return {"maps": _land(maps, cfg, "maps_activity", "maps", require_rows),
            "watches": _land(watches, cfg, "youtube_watch_history", "watches", require_rows),
            "searches": _land(searches, cfg, "youtube_search_history", "searches", False)}


def windowed(entries: DataFrame, ts: str, as_of: dt.datetime, lookback_days: int = 3) -> DataFrame:
    """Daily ingest window with overlap (PIP-12, STM-09): the last
    ``lookback_days``; re-ingesting overlap is idempotent because bronze is
    read latest-version-per-key. ``ingest_dates`` keeps a ledger, so that a
    missed run loses nothing."""
    lo = F.lit(as_of - dt.timedelta(days=lookback_days)).cast("timestamp")
    return entries.filter(F.col(ts) >= lo)


LEDGER = "source string, high_water date, run_at timestamp"


def high_water(spark: SparkSession, ledger: str, source: str) -> dt.date | None:
    """The last date that an ingest of ``source`` has covered."""
    fs, p = _fs(spark, ledger)
    if not fs.exists(p):
        return None
    rows = spark.read.schema(LEDGER).parquet(ledger).filter(F.col("source") == source)
    return rows.agg(F.max("high_water")).first()[0]


def ingest_dates(spark: SparkSession, entries: DataFrame, ts: str, source: str, path: str, ledger: str,
                 as_of: dt.datetime, lookback_days: int = 3, date_col: str = "event_date") -> dt.date | None:
    """Late re-ingest by whole dates (STM-09, PIP-12).

    From ``lookback_days`` before the ledger's high-water mark (or before
    ``as_of``, whichever is earlier; from the beginning without a mark) up to
    ``as_of``, the dates that ``entries`` has rows for are replaced in the table at ``path``
    (partitioned by ``date_col``), other dates stay. The mark is written after
    the rows. So a run missed for any time is made up by the next, and a rerun
    writes the same. ``entries`` must hold all rows of those dates; rows
    without a time are left out. Returns the first date read (None: all)."""
    mark = high_water(spark, ledger, source)
    first = None if mark is None else min(mark, as_of.date()) - dt.timedelta(days=lookback_days)
    rows = entries.filter(F.col(ts).isNotNull() & (F.col(ts) <= F.lit(as_of).cast(entries.schema[ts].dataType)))
    rows = rows.withColumn(date_col, F.to_date(ts))
    if first is not None:
        rows = rows.filter(F.col(date_col) >= F.lit(first))
    # a date's rows go to a few tasks, so that a date has few files and a busy one is split
    dealt = rows.repartition(date_col, F.pmod(F.xxhash64(*entries.columns), F.lit(4)))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path)
    spark.createDataFrame([(source, as_of.date(), as_of)], LEDGER).coalesce(1).write.mode("append").parquet(ledger)
    return first


def import_calendar(spark: SparkSession, cfg: Cfg, events: DataFrame) -> int:
    """Per-calendar event payloads (with calendar_id/calendar_name columns)
    → bronze (PIP-13); deletions arrive as status 'cancelled' versions."""
    return _land(google.calendar_event_rows(events), cfg, "calendar_events", "calendar", False)


def rebuild_private_places(spark: SparkSession, cfg: Cfg, root: str, radius_m: int = 100) -> int:
    """Rebuild the privacy filter from starred-place GeoJSON files (SRC-13,
    SNK-03/04): only coordinates are kept, and an input that yields no
    coordinates refuses to replace the current list."""
    from daybook.sources.tables import overwrite_guarded
    collections = (spark.read.schema(spotify.schema(google.STARRED_DDL)).option("multiLine", True)
                   .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(root))
    rows = google.starred_place_rows(collections, radius_m).withColumn(
        "_set_at", F.lit(cfg.as_of).cast("timestamp"))
    overwrite_guarded(rows, cfg, "maps_private_places", allow_empty=False)
    return spark.read.parquet(f"{cfg.table_path('silver', 'maps_private_places')}").count()
