"""Table contract: one schema per bronze/silver table plus its read rule
(dedup keys and version column). Strings default to '' (never NULL) at
the model boundary; schemas are explicit, never inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType, _parse_datatype_string


@dataclass(frozen=True)
class TableSpec:
    name: str
    layer: str
    ddl: str
    keys: tuple[str, ...] = ()
    version: str | None = None     # None → plain append table, no dedup on read

    @property
    def schema(self) -> StructType:
        return _parse_datatype_string(self.ddl)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


_A = "array<string>"

TABLES: dict[str, TableSpec] = {t.name: t for t in [
    TableSpec("spotify_player_current", "bronze",
              f"captured_at timestamp, track_id string, track_name string, track_uri string, "
              f"track_duration_ms int, progress_ms int, is_playing boolean, album_id string, album_name string, "
              f"album_uri string, album_images {_A}, artists_ids {_A}, artists_names {_A}, device_id string, "
              f"device_name string, device_type string, device_volume_percent int, context_type string, "
              f"context_uri string, _ingested_at timestamp", ("track_id", "captured_at"), "_ingested_at"),
    TableSpec("spotify_player_current_dlq", "bronze",
              "rejected_at timestamp, topic string, error string, payload string, _ingested_at timestamp",
              ("rejected_at", "error", "payload"), "_ingested_at"),
    TableSpec("spotify_plays_raw", "bronze",
              f"played_at timestamp, track_id string, track_uri string, track_name string, artists_ids {_A}, "
              f"artists_names {_A}, album_name string, album_images {_A}, duration_ms bigint, "
              f"context_type string, context_uri string, _ingested_at timestamp", ("track_id", "played_at"),
              "_ingested_at"),
    TableSpec("spotify_tracks", "bronze",
              f"track_id string, track_name string, track_uri string, duration_ms bigint, explicit boolean, "
              f"popularity int, isrc string, album_id string, album_name string, album_uri string, "
              f"album_images {_A}, album_release_date date, artists_ids {_A}, _fetched_at timestamp",
              ("track_id",), "_fetched_at"),
    TableSpec("spotify_artists", "bronze",
              f"artist_id string, artist_name string, artist_uri string, genres {_A}, popularity int, "
              f"followers bigint, image_url string, _fetched_at timestamp", ("artist_id",), "_fetched_at"),
    TableSpec("spotify_saved_tracks", "bronze",
              "added_at timestamp, track_id string, track_uri string, _ingested_at timestamp",
              ("track_id", "added_at"), "_ingested_at"),
    TableSpec("maps_activity", "bronze",
              "event_ts timestamp, activity_type string, query string, place_name string, place_id string, "
              "lat double, lng double, origin string, destination string, raw_url string, _ingested_at timestamp",
              ("event_ts", "place_id"), "_ingested_at"),
    TableSpec("maps_place_catalog", "bronze",
              f"place_id string, lookup_key string, place_name string, place_types {_A}, primary_type string, "
              f"lat double, lng double, formatted_address string, neighborhood string, sublocality string, "
              f"locality string, admin_area_1 string, country string, country_code string, "
              f"match_confidence float, match_type string, _fetched_at timestamp", ("place_id",), "_fetched_at"),
    TableSpec("youtube_watch_history", "bronze",
              "watched_at timestamp, video_id string, video_title string, video_url string, channel_id string, "
              "channel_title string, activity_type string, is_from_ads boolean, _ingested_at timestamp",
              ("video_id", "watched_at"), "_ingested_at"),
    TableSpec("youtube_search_history", "bronze",
              "searched_at timestamp, query string, _ingested_at timestamp", ("searched_at", "query"), "_ingested_at"),
    TableSpec("youtube_videos", "bronze",
              "video_id string, video_title string, channel_id string, category_id string, "
              "duration_seconds bigint, published_at timestamp, default_language string, _fetched_at timestamp",
              ("video_id",), "_fetched_at"),
    TableSpec("youtube_channels", "bronze",
              "channel_id string, channel_title string, primary_category_name string, subscriber_count bigint, "
              "thumbnail_url string, _fetched_at timestamp", ("channel_id",), "_fetched_at"),
    TableSpec("calendar_events", "bronze",
              "event_id string, calendar_id string, calendar_name string, started_at timestamp, "
              "ended_at timestamp, title string, description string, location string, status string, "
              "attendee_count int, recurrence_id string, _ingested_at timestamp", ("event_id", "started_at"),
              "_ingested_at"),
    TableSpec("calendar_sync_notifications", "bronze",
              "channel_id string, message_number bigint, received_at timestamp, resource_id string, "
              "calendar_id string, processed_at timestamp, _ingested_at timestamp",
              ("channel_id", "message_number"), "_ingested_at"),
    TableSpec("maps_home_locations", "silver",
              "valid_from timestamp, lat double, lng double, radius_km double, label string, _set_at timestamp",
              ("valid_from",), "_set_at"),
    TableSpec("maps_trips", "silver",
              "started_at date, ended_at date, days int, destination string, destination_country string, "
              "km bigint, localities int, countries int, max_km bigint"),
    TableSpec("maps_trips_enriched", "silver",
              "trip_key string, started_at date, ended_at date, days int, is_trip int, confidence float, "
              "trip_type string, title string, destination_label string, destination_country string, "
              "summary string, evidence string, suggested_split string, model string, _enriched_at timestamp",
              ("trip_key",), "_enriched_at"),
    TableSpec("maps_trip_labels", "silver",
              "trip_key string, label string, edited_title string, edited_destination string, "
              "edited_trip_type string, note string, _set_at timestamp", ("trip_key",), "_set_at"),
    TableSpec("maps_trip_weather", "silver",
              "trip_key string, lat double, lng double, temp_mean double, temp_max double, temp_min double, "
              "precip_mm double, summary string, _fetched_at timestamp", ("trip_key",), "_fetched_at"),
    TableSpec("maps_private_places", "silver",
              "lat double, lng double, radius_m int, _set_at timestamp", ("lat", "lng"), "_set_at"),
    TableSpec("calendar_category_aliases", "silver",
              "calendar_name string, display_category string, _set_at timestamp", ("calendar_name",), "_set_at"),
    TableSpec("alerts", "auth", "raised_at timestamp, kind string, account_email string, message string"),
    TableSpec("calendar_channels", "auth",
              "calendar_id string, channel_id string, calendar_name string, resource_id string, "
              "sync_token string, expiration timestamp, started_at timestamp, _updated_at timestamp",
              ("calendar_id", "channel_id"), "_updated_at"),
]}

UNIFIED_DDL = ("event_ts timestamp, source string, kind string, title string, subtitle string, "
               "image_url string, is_from_ads int, metadata string, event_id string")
PLAY_COLUMNS = ["played_at", "track_id", "track_name", "duration_ms", "primary_artist_id",
                "primary_artist_name", "genres", "album_name", "album_art_url", "context_type", "context_uri"]
