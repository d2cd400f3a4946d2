"""Column-expression helpers. Everything here returns a ``Column`` built from
built-in Spark functions, so it stays inside whole-stage codegen."""

from daybook.functions.geo import haversine_km, haversine_m  # noqa: F401
from daybook.functions.numeric import (  # noqa: F401
    finite_or_zero, fmt_num, pct, round_half, safe_div,
)
from daybook.functions.text import (  # noqa: F401
    clip, first_nonblank, join_nonblank, nonblank, text_key, truncate_ellipsis,
)
from daybook.functions.timefn import (  # noqa: F401
    age_label, iso_dow, iso_utc, minutes_between, readable_delta, seconds_between,
)
