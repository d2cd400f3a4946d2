"""Model registry: name → function, and a daily run that builds every model
once, sharing the silver frames between the gold models (OPT-15/16)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybook.config import Cfg
from daybook.plans import calendar, home, maps, spotify, unified, youtube
from daybook.session import ensure_checkpoint_dir, landed

SILVER: dict[str, Callable[[SparkSession, Cfg], DataFrame]] = {
    "maps_activity_keyed": maps.maps_activity_keyed,
    "silver_maps_activity_enriched": maps.silver_maps_activity_enriched,
    "silver_home_base": maps.silver_home_base,
    "silver_geo_daily": maps.silver_geo_daily,
    "silver_calendar_events": calendar.silver_calendar_events,
    "silver_calendar_geo": calendar.silver_calendar_geo,
    "silver_spotify_plays": spotify.silver_spotify_plays,
    "silver_spotify_plays_stream": spotify.silver_spotify_plays_stream,
    "silver_spotify_plays_merged": spotify.silver_spotify_plays_merged,
    "silver_spotify_saved": spotify.silver_spotify_saved,
    "silver_youtube_watches": youtube.silver_youtube_watches,
    "silver_youtube_searches": youtube.silver_youtube_searches,
    "silver_events_unified": unified.silver_events_unified,
}


def build_all(spark: SparkSession, cfg: Cfg, persist: bool = False,
              land: Callable[[str, DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """Every silver and gold model as a lazy DataFrame. Shared silver frames
    are built once; with ``persist`` they are cached, with ``land`` each
    silver model is what ``land(name, frame)`` returns (a written table), so
    the models on top read it instead of computing it again."""
    out: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame, shared: bool = True) -> DataFrame:
        out[name] = land(name, df) if land else df.persist() if persist and shared else df
        return out[name]

    keep("maps_activity_keyed", maps.maps_activity_keyed(spark, cfg), False)
    enriched = keep("silver_maps_activity_enriched", maps.silver_maps_activity_enriched(spark, cfg))
    base = keep("silver_home_base", maps.silver_home_base(spark, cfg, enriched), False)
    keep("silver_geo_daily", maps.silver_geo_daily(spark, cfg, enriched), False)
    cal = keep("silver_calendar_events", calendar.silver_calendar_events(spark, cfg))
    keep("silver_calendar_geo", calendar.silver_calendar_geo(spark, cfg, cal, base), False)
    keep("silver_spotify_plays", spotify.silver_spotify_plays(spark, cfg), False)
    keep("silver_spotify_plays_stream", spotify.silver_spotify_plays_stream(spark, cfg), False)
    plays = keep("silver_spotify_plays_merged", spotify.silver_spotify_plays_merged(spark, cfg))
    saved = keep("silver_spotify_saved", spotify.silver_spotify_saved(spark, cfg), False)
    watches = keep("silver_youtube_watches", youtube.silver_youtube_watches(spark, cfg))
    searches = keep("silver_youtube_searches", youtube.silver_youtube_searches(spark, cfg), False)
    parts = {"plays": unified.events_spotify_plays(plays), "liked": unified.events_spotify_liked(saved),
             "maps": unified.events_maps_visits(enriched), "youtube": unified.events_youtube_watches(watches),
             "calendar": unified.events_calendar(cal)}
    names = {"plays": "spotify_plays", "liked": "spotify_liked", "maps": "maps_visits", "youtube": "youtube_watches",
             "calendar": "calendar"}
    parts = {k: keep(f"silver_events_unified_{names[k]}", v, False) for k, v in parts.items()}
    uni = keep("silver_events_unified", unified.silver_events_unified(spark, cfg, parts))
    # gold
    out["gold_spotify_current_track"] = spotify.gold_spotify_current_track(spark, cfg)
    for name in ("recent_tracks", "kpis_summary", "kpis_dashboard", "top_artists", "genres", "daily_listening"):
        out[f"gold_spotify_{name}"] = getattr(spotify, f"gold_spotify_{name}")(spark, cfg, plays)
    out["gold_youtube_kpis_with_watch_time_dashboard"] = youtube.gold_youtube_kpis_with_watch_time_dashboard(
        spark, cfg, watches, searches)
    for name in ("top_channels_dashboard", "category_breakdown_dashboard", "hourly_activity_dashboard",
                 "recent_videos_dashboard"):
        out[f"gold_youtube_{name}"] = getattr(youtube, f"gold_youtube_{name}")(spark, cfg, watches)
    out["gold_youtube_daily_watch_time_breakdown_dashboard"] = \
        youtube.gold_youtube_daily_watch_time_breakdown_dashboard(spark, cfg, watches, searches)
    trips = out["gold_maps_trips"] = maps.gold_maps_trips(spark, cfg)
    out["gold_maps_kpis_dashboard"] = maps.gold_maps_kpis_dashboard(spark, cfg, enriched)
    out["gold_maps_locations_dashboard"] = maps.gold_maps_locations_dashboard(spark, cfg, enriched)
    for name in ("destinations_dashboard", "hourly_activity_dashboard", "daily_activity_dashboard",
                 "recent_activities"):
        out[f"gold_maps_{name}"] = getattr(maps, f"gold_maps_{name}")(spark, cfg, enriched)
    for name in ("kpis", "busy_hours", "categories", "weekday_breakdown", "daily_events", "week_grid",
                 "upcoming_events"):
        out[f"gold_calendar_{name}"] = getattr(calendar, f"gold_calendar_{name}")(spark, cfg, cal)
    out["gold_home_overview_stats"] = home.gold_home_overview_stats(spark, cfg, plays, watches, searches, enriched,
                                                                   out["gold_maps_kpis_dashboard"])
    out["gold_home_daily_data_generation"] = home.gold_home_daily_data_generation(spark, cfg, uni)
    out["gold_home_recent_events"] = home.gold_home_recent_events(spark, cfg, uni)
    del trips
    return out


def run_daily(spark: SparkSession, cfg: Cfg) -> dict[str, int]:
    """Model build + trip rebuild (PIP-01) — the modelling half of the daily
    chain; ingestion jobs append to bronze before it.

    Silver tables are written first, each once; the gold tables are built from
    what was written. Every model is a Parquet folder of its layer afterwards,
    registered as a view (SNK-14). Returns the rows per model."""
    from daybook.jobs.trips import segment_trips
    from daybook.sources.tables import overwrite_guarded, publish, register_views
    overwrite_guarded(segment_trips(spark, cfg), cfg, "maps_trips")

    def land(name: str, df: DataFrame) -> DataFrame:
        path = cfg.table_path("gold" if name.startswith("gold_") else "silver", f"model_{name}")
        publish(df, path)
        return spark.read.schema(df.schema).parquet(path)

    models = build_all(spark, cfg, land=land)
    models |= {k: land(k, df) for k, df in models.items() if k.startswith("gold_")}
    register_views(spark, models)
    return {k: df.count() for k, df in models.items()}


def _overview(spark, cfg, enriched, plays, watches):
    return home.gold_home_overview_stats(
        spark, cfg, plays, watches, youtube.silver_youtube_searches(spark, cfg), enriched,
        maps.gold_maps_kpis_dashboard(spark, cfg, enriched))


def _uni(spark, cfg, enriched, plays, watches):
    return unified.silver_events_unified(spark, cfg, {
        "plays": unified.events_spotify_plays(plays),
        "liked": unified.events_spotify_liked(spotify.silver_spotify_saved(spark, cfg)),
        "maps": unified.events_maps_visits(enriched), "youtube": unified.events_youtube_watches(watches),
        "calendar": unified.events_calendar(calendar.silver_calendar_events(spark, cfg))})


_MAPS = ("silver_maps_activity_enriched",)
_FEED = (*_MAPS, "silver_spotify_plays_merged", "silver_youtube_watches")

# name → silver models that it takes (long chains, most of them read more than once), builder on their frames
ON_SILVER: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    **{f"gold_maps_{n}": (_MAPS, getattr(maps, f"gold_maps_{n}"))
       for n in ("kpis_dashboard", "locations_dashboard", "destinations_dashboard")},
    "gold_home_overview_stats": (_FEED, _overview),
    "gold_home_daily_data_generation": (
        _FEED, lambda s, c, *silver: home.gold_home_daily_data_generation(s, c, _uni(s, c, *silver))),
    "gold_home_recent_events": (_FEED, lambda s, c, *silver: home.gold_home_recent_events(s, c, _uni(s, c, *silver))),
}


def build_landed(spark: SparkSession, cfg: Cfg, name: str) -> DataFrame:
    """One model like ``MODELS[name]``, but the silver models of ``ON_SILVER``
    are written first, each once, as ``run_daily`` does. The driver plans
    each chain in a job of its own instead of one plan that holds them all, again
    for each reading, and that is planned anew whenever a stage ends."""
    if name not in ON_SILVER:
        return MODELS[name](spark, cfg)
    silver, build = ON_SILVER[name]
    return build(spark, cfg, *[landed(SILVER[n](spark, cfg), n) for n in silver])


# name → builder of that model alone (its own dependency chain only)
MODELS: dict[str, Callable[[SparkSession, Cfg], DataFrame]] = {
    **SILVER,
    "silver_events_unified_spotify_plays":
        lambda s, c: unified.events_spotify_plays(spotify.silver_spotify_plays_merged(s, c)),
    "silver_events_unified_spotify_liked": lambda s, c: unified.events_spotify_liked(spotify.silver_spotify_saved(s, c)),
    "silver_events_unified_maps_visits":
        lambda s, c: unified.events_maps_visits(maps.silver_maps_activity_enriched(s, c)),
    "silver_events_unified_youtube_watches":
        lambda s, c: unified.events_youtube_watches(youtube.silver_youtube_watches(s, c)),
    "silver_events_unified_calendar": lambda s, c: unified.events_calendar(calendar.silver_calendar_events(s, c)),
    "gold_spotify_current_track": spotify.gold_spotify_current_track,
    **{f"gold_spotify_{n}": getattr(spotify, f"gold_spotify_{n}")
       for n in ("recent_tracks", "kpis_summary", "kpis_dashboard", "top_artists", "genres", "daily_listening")},
    **{f"gold_youtube_{n}": getattr(youtube, f"gold_youtube_{n}")
       for n in ("kpis_with_watch_time_dashboard", "top_channels_dashboard", "category_breakdown_dashboard",
                 "daily_watch_time_breakdown_dashboard", "hourly_activity_dashboard", "recent_videos_dashboard")},
    **{f"gold_maps_{n}": getattr(maps, f"gold_maps_{n}")
       for n in ("trips", "hourly_activity_dashboard", "daily_activity_dashboard", "recent_activities")},
    **{f"gold_calendar_{n}": getattr(calendar, f"gold_calendar_{n}")
       for n in ("kpis", "busy_hours", "categories", "weekday_breakdown", "daily_events", "week_grid",
                 "upcoming_events")},
    **{name: lambda s, c, silver=silver, build=build: build(s, c, *[SILVER[n](s, c) for n in silver])
       for name, (silver, build) in ON_SILVER.items()},
}

_READS: dict[str, frozenset[str]] = {}


def tables_of(spark: SparkSession, name: str) -> frozenset[str]:
    """Warehouse tables that a model reads, noted while it is built on a
    warehouse without tables (building a plan runs nothing)."""
    if name not in _READS:
        reads: set[str] = set()
        empty = Cfg(root=f"{ensure_checkpoint_dir(spark).rstrip('/')}/no-warehouse", extra={"reads": reads})
        MODELS[name](spark, empty)
        _READS[name] = frozenset(reads)
    return _READS[name]
