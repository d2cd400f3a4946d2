"""Relational building blocks composed from DataFrame operations."""

from daybook.operators.joins import (  # noqa: F401
    band_anti_join, overlap_join, valid_intervals, within_radius_flag,
)
from daybook.operators.spine import date_spine, densify, int_spine  # noqa: F401
from daybook.operators.topn import rank_rows, top_n, top_n_per_group, top_n_plus_other  # noqa: F401
from daybook.operators.versioned import latest_by_version  # noqa: F401
