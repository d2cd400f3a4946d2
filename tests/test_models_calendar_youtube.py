"""Calendar and YouTube models, unified feed and home models."""

import datetime as dt

from daybook.plans import calendar, home, unified, youtube

AS_OF = dt.datetime(2025, 6, 30, 12, 0, 0)


def test_calendar_events_rules(spark, cfg, put_rows):
    put_rows(cfg, "calendar_events", [
        {"event_id": "e1", "calendar_name": "Work", "started_at": dt.datetime(2025, 6, 2, 9), "ended_at": dt.datetime(2025, 6, 2, 10),
         "title": "Team sync", "status": "confirmed", "attendee_count": 3},
        {"event_id": "e2", "calendar_name": "me@example.com", "started_at": dt.datetime(2025, 6, 3), "ended_at": dt.datetime(2025, 6, 4),
         "title": "Flight to Rome", "status": "confirmed"},
        {"event_id": "e3", "calendar_name": "Work", "started_at": dt.datetime(2025, 6, 5, 23, 59), "ended_at": dt.datetime(2025, 6, 6, 0, 1),
         "title": "late", "status": "confirmed"},
        {"event_id": "e4", "calendar_name": "Work", "started_at": dt.datetime(2025, 6, 6, 8), "ended_at": dt.datetime(2025, 6, 6, 9),
         "title": "to cancel", "status": "confirmed"},
        {"event_id": "e5", "calendar_name": "Fam", "started_at": dt.datetime(2025, 7, 1, 9), "ended_at": dt.datetime(2025, 7, 1, 9, 30),
         "title": "future", "status": "confirmed"},
        {"event_id": "e6", "calendar_name": "Fam", "started_at": dt.datetime(2025, 6, 7), "ended_at": dt.datetime(2025, 6, 10),
         "title": "hotel check-in", "status": "confirmed"},
    ])
    put_rows(cfg, "calendar_events", [{"event_id": "e4", "calendar_name": "Work", "started_at": dt.datetime(2025, 6, 6, 8),
                                       "ended_at": dt.datetime(2025, 6, 6, 9), "status": "cancelled"}],
             ingested_at=AS_OF + dt.timedelta(seconds=1))
    put_rows(cfg, "calendar_category_aliases", [{"calendar_name": "Fam", "display_category": "Family"}])
    ev = {r["event_id"]: r for r in calendar.silver_calendar_events(spark, cfg).collect()}
    assert set(ev) == {"e1", "e2", "e3", "e5", "e6"}                 # newer cancelled version wins, then dropped
    assert ev["e2"]["category"] == "Personal" and ev["e2"]["is_all_day"] == 1
    assert ev["e6"]["category"] == "Family" and ev["e6"]["is_all_day"] == 1 and ev["e6"]["duration_minutes"] == 4320
    assert ev["e3"]["duration_minutes"] == 2 and ev["e1"]["day_of_week"] == 1
    geo = {r["event_id"]: r for r in calendar.silver_calendar_geo(
        spark, cfg, home=spark.createDataFrame([("Paris", "France", 48.85, 2.35)],
                                                "home_locality string, home_country string, home_lat double, home_lng double")
    ).collect()}
    assert geo["e2"]["is_travel_title"] == 1 and geo["e6"]["is_travel_title"] == 1 and geo["e1"]["is_travel_title"] == 0
    assert geo["e6"]["is_multi_day"] == 1
    k = calendar.gold_calendar_kpis(spark, cfg).first()
    assert k["totalEvents"] == 2 and k["plansCount"] == 1 and k["busiestDay"] == "Mon"
    assert len(calendar.gold_calendar_busy_hours(spark, cfg).collect()) == 24
    assert [r["day"] for r in calendar.gold_calendar_weekday_breakdown(spark, cfg).collect()][0] == "Mon"
    grid = calendar.gold_calendar_week_grid(spark, cfg).collect()
    assert len(grid) == 168 and max(r["intensity"] for r in grid) == 1.0
    up = calendar.gold_calendar_upcoming_events(spark, cfg).collect()
    assert [r["title"] for r in up] == ["future"]
    cats = {r["name"]: r for r in calendar.gold_calendar_categories(spark, cfg).collect()}
    assert cats["Work"]["value"] == 2 and cats["Work"]["percentage"] == 50.0


def test_youtube_models(spark, cfg, put_rows):
    w = lambda h, vid, ads=False, ch="c1": {"watched_at": AS_OF - dt.timedelta(hours=h), "video_id": vid,
                                           "video_title": "raw " + vid, "channel_id": ch, "channel_title": "Raw",
                                           "is_from_ads": ads}
    put_rows(cfg, "youtube_watch_history", [w(1, "v1"), w(2, "v2"), w(3, "v3", True), w(4, "v4", ch="c2"), w(30, "v1")])
    put_rows(cfg, "youtube_videos", [
        {"video_id": "v1", "video_title": "Video One", "channel_id": "c1", "category_id": "23", "duration_seconds": 600},
        {"video_id": "v2", "video_title": "", "channel_id": "", "category_id": "34", "duration_seconds": 300},
        {"video_id": "v3", "video_title": "Ad", "channel_id": "c1", "category_id": "999", "duration_seconds": 30},
        {"video_id": "v4", "video_title": "[deleted]", "channel_id": "", "category_id": "", "duration_seconds": 0}])
    put_rows(cfg, "youtube_channels", [{"channel_id": "c1", "channel_title": "Channel One"}])
    put_rows(cfg, "youtube_search_history", [{"searched_at": AS_OF - dt.timedelta(hours=5), "query": "x"}])
    rows = {(r["video_id"], r["watched_at"]): r for r in youtube.silver_youtube_watches(spark, cfg).collect()}
    v2 = [r for k, r in rows.items() if k[0] == "v2"][0]
    assert v2["video_title"] == "raw v2" and v2["channel_title"] == "Channel One"
    cats = {r["category_name"]: r for r in youtube.gold_youtube_category_breakdown_dashboard(spark, cfg).collect()}
    assert cats["Comedy"]["watch_count"] == 3 and cats["Other"]["watch_count"] == 1
    k = youtube.gold_youtube_kpis_with_watch_time_dashboard(spark, cfg).first()
    assert k["videos_watched"] == 5 and k["total_ads_watched"] == 1 and k["total_searches"] == 1
    assert k["total_watch_time_seconds"] == 1530 and k["total_watch_time_formatted"] == "25 minutes and 30 seconds"
    assert k["avg_watch_time_seconds"] == 383.0
    top = youtube.gold_youtube_top_channels_dashboard(spark, cfg).collect()
    assert top[0]["channel_id"] == "c1" and top[0]["primary_category"] == "Comedy"
    daily = youtube.gold_youtube_daily_watch_time_breakdown_dashboard(spark, cfg).collect()
    assert sum(r["watched_count"] for r in daily) == 4 and sum(r["ads_count"] for r in daily) == 1
    assert len(youtube.gold_youtube_hourly_activity_dashboard(spark, cfg).collect()) == 24
    rec = youtube.gold_youtube_recent_videos_dashboard(spark, cfg).collect()
    assert rec[0]["title"] == "Video One" and len(rec) == 5
    # unified + home
    parts = {"youtube": unified.events_youtube_watches(youtube.silver_youtube_watches(spark, cfg))}
    uni = unified.silver_events_unified(spark, cfg, parts)
    assert uni.count() == 5 and uni.select("event_id").distinct().count() == 5
    assert home.gold_home_recent_events(spark, cfg, uni).count() == 5
    tl = home.live_timeline(spark, cfg, uni).collect()
    assert tl[0]["label"] == "Watched" and tl[0]["value"] == "Video One - Channel One"
