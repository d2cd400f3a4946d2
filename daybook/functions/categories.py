"""Code → label lookups (PRJ-09, PRJ-10)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: video category id → display name; two ids map to 'Comedy'
YOUTUBE_CATEGORY_NAMES = {
    "1": "Film & Animation", "2": "Autos & Vehicles", "10": "Music",
    "15": "Pets & Animals", "17": "Sports", "18": "Short Movies",
    "19": "Travel & Events", "20": "Gaming", "21": "Videoblogging",
    "22": "People & Blogs", "23": "Comedy", "24": "Entertainment",
    "25": "News & Politics", "26": "Howto & Style", "27": "Education",
    "28": "Science & Technology", "29": "Nonprofits & Activism", "30": "Movies",
    "31": "Anime/Animation", "32": "Action/Adventure", "33": "Classics",
    "34": "Comedy", "35": "Documentary", "36": "Drama", "37": "Family",
    "38": "Foreign", "39": "Horror", "40": "Sci-Fi/Fantasy", "41": "Thriller",
    "42": "Shorts", "43": "Shows", "44": "Trailers",
}

# fixed values: unified-event kind → display label (unknown kinds pass through)
KIND_LABELS = {
    "play": "Played",
    "liked": "Liked",
    "watch": "Watched",
    "meeting": "Event",
    "maps_search": "Searched",
    "maps_directions": "Directions",
    "maps_view": "Viewed",
    "maps_other": "Maps",
}


def _map_literal(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def category_name(cat_id) -> Column:
    """'' for an empty id, the label for a known id, else 'Other'."""
    c = F.coalesce((F.col(cat_id) if isinstance(cat_id, str) else cat_id).cast("string"), F.lit(""))
    return F.when(c == "", F.lit("")).otherwise(
        F.coalesce(F.try_element_at(_map_literal(YOUTUBE_CATEGORY_NAMES), c), F.lit("Other")))


def kind_label(kind) -> Column:
    k = F.col(kind) if isinstance(kind, str) else kind
    return F.coalesce(F.try_element_at(_map_literal(KIND_LABELS), k), k)
