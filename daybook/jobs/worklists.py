"""Enrichment work lists and catalog merges (PIP-05..09, JON-11, JON-17,
SRT-08, SRT-10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def worklist(requested: DataFrame, catalog: DataFrame, key: str, cap: int | None = None) -> DataFrame:
    """Distinct requested keys not yet in the catalog (``left_anti``, which
    unlike ``NOT IN`` is NULL-safe); with ``cap`` (a caller's lookup budget)
    the first by key, the next run takes the rest."""
    todo = (requested.select(key).filter(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
            .distinct().join(catalog.select(key).hint("merge"), key, "left_anti"))
    return todo.orderBy(key).limit(cap) if cap else todo


def merge_with_tombstones(cached: DataFrame, todo: DataFrame, fetched: DataFrame, key: str,
                          defaults: dict[str, object]) -> DataFrame:
    """cached ∪ fetched ∪ placeholders for keys asked for but not returned,
    so the next work list no longer contains them (PIP-09)."""
    tomb = todo.join(fetched.select(key), key, "left_anti")
    for c, v in defaults.items():
        tomb = tomb.withColumn(c, F.lit(v))
    cols = [key, *defaults.keys()]
    return (cached.select(*cols).withColumn("is_tombstone", F.lit(0)).withColumn("origin", F.lit("cached"))
            .unionByName(fetched.select(*cols).withColumn("is_tombstone", F.lit(0)).withColumn("origin", F.lit("fetched")))
            .unionByName(tomb.select(*cols).withColumn("is_tombstone", F.lit(1)).withColumn("origin", F.lit("tombstone"))))


def chunks(todo: DataFrame, key: str, size: int = 50) -> DataFrame:
    """Batches of at most ``size`` keys for a bulk lookup (SRT-10).

    Keys are dealt to ranges and numbered inside them; a batch is a run of
    ``size`` numbers of one range, so none is larger and at most one per range
    is smaller."""
    from pyspark.sql import Window
    ranged = todo.select(key).repartitionByRange(F.col(key)).withColumn("__part", F.spark_partition_id())
    w = Window.partitionBy("__part").orderBy(key)
    batch = F.col("__part").cast("long") * (1 << 32) + F.floor((F.row_number().over(w) - 1) / size)
    return (ranged.withColumn("batch", batch)
            .groupBy("batch").agg(F.sort_array(F.collect_list(key)).alias("ids")))


def latest_text_and_coords(rows: DataFrame, key: str, text: str, ts: str,
                           lat: str | None = None, lng: str | None = None) -> DataFrame:
    """Per unknown key: latest text (``max_by`` on time) and mean coordinates (PIP-05)."""
    aggs = [F.max_by(text, ts).alias(text)]
    if lat and lng:
        aggs += [F.avg(lat).alias(lat), F.avg(lng).alias(lng)]
    return rows.groupBy(key).agg(*aggs)


def skip_done(candidates: DataFrame, done: DataFrame, keys: Sequence[str], force: bool = False) -> DataFrame:
    """Monotonic skip of already-processed keys unless forced (JON-17)."""
    return candidates if force else candidates.join(done.select(*keys).distinct(), list(keys), "left_anti")


# ---------------------------------------------------------------- domain lists
def place_worklist(spark, cfg, cap: int | None = None) -> DataFrame:
    """Maps keys with no catalog row: latest text and mean raw coordinates (PIP-05)."""
    from daybook.plans.maps import maps_activity_keyed
    from daybook.sources.tables import read_table
    k = maps_activity_keyed(spark, cfg).filter(F.col("geo_key") != "")
    todo = worklist(k.select("geo_key"), read_table(spark, cfg, "maps_place_catalog")
                    .select(F.col("place_id").alias("geo_key")), "geo_key", cap)
    info = latest_text_and_coords(k.join(todo, "geo_key", "left_semi"), "geo_key", "best_text", "event_ts", "lat", "lng")
    return info.withColumnRenamed("best_text", "text")


def calendar_place_worklist(spark, cfg, cap: int | None = None) -> DataFrame:
    """Calendar locations with no catalog row, keyed like Maps (PIP-06)."""
    from daybook.functions.text import text_key
    from daybook.plans.calendar import silver_calendar_events
    from daybook.sources.tables import read_table
    e = silver_calendar_events(spark, cfg).filter(F.col("location") != "").withColumn("geo_key", text_key("location"))
    todo = worklist(e.select("geo_key"), read_table(spark, cfg, "maps_place_catalog")
                    .select(F.col("place_id").alias("geo_key")), "geo_key", cap)
    return latest_text_and_coords(e.join(todo, "geo_key", "left_semi"), "geo_key", "location", "started_at") \
        .withColumnRenamed("location", "text")


def track_worklist(spark, cfg, cap: int | None = None) -> DataFrame:
    """Track ids played but missing from the catalog (PIP-08)."""
    from daybook.sources.tables import read_table
    return worklist(read_table(spark, cfg, "spotify_plays_raw").select("track_id"),
                    read_table(spark, cfg, "spotify_tracks"), "track_id", cap)


def artist_worklist(spark, cfg, cap: int | None = None, backfill: bool = False) -> DataFrame:
    """Artist ids from plays (and, for the backfill, from catalog tracks ∪
    plays) missing from the artist catalog (PIP-08, ARR-06, SET-03)."""
    from daybook.sources.tables import read_table
    ids = read_table(spark, cfg, "spotify_plays_raw").select(F.explode("artists_ids").alias("artist_id"))
    if backfill:
        ids = ids.union(read_table(spark, cfg, "spotify_tracks").select(F.explode("artists_ids").alias("artist_id")))
    return worklist(ids.distinct(), read_table(spark, cfg, "spotify_artists"), "artist_id", cap)


def video_worklist(spark, cfg, cap: int | None = None) -> DataFrame:
    from daybook.sources.tables import read_table
    return worklist(read_table(spark, cfg, "youtube_watch_history").select("video_id"),
                    read_table(spark, cfg, "youtube_videos"), "video_id", cap)


def video_tombstones(requested: DataFrame, returned: DataFrame, failed_batches: DataFrame | None = None) -> DataFrame:
    """Placeholder ``youtube_videos`` rows for ids requested but not returned
    (PIP-09), so the work list converges; ids of failed batches are not
    tombstoned (they are retried)."""
    miss = requested.select("video_id").join(returned.select("video_id"), "video_id", "left_anti")
    if failed_batches is not None:
        miss = miss.join(failed_batches.select("video_id"), "video_id", "left_anti")
    return miss.select("video_id", F.lit("").alias("video_title"), F.lit("").alias("channel_id"),
                       F.lit("").alias("category_id"), F.lit(0).cast("long").alias("duration_seconds"),
                       F.lit("1970-01-01 00:00:00").cast("timestamp").alias("published_at"),
                       F.lit("").alias("default_language"))
