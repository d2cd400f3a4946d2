"""Run configuration: every model takes an explicit ``as_of`` (SEM-12)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Cfg:
    """Parameters shared by all models and jobs.

    Fixed values below equal the reference's model variables and constants.
    """

    as_of: dt.datetime = dt.datetime(2026, 1, 1)
    # fixed values (model variables / job constants of the reference)
    kpi_start_date: dt.date = dt.date(2025, 1, 1)
    dwell_seconds: int = 30
    dedup_window_seconds: int = 120
    stream_lookback_days: int = 7
    gap_days: int = 3
    trip_window_days: int = 365
    home_confidence_min: float = 0.4
    away_km: float = 50.0
    far_km: float = 100.0
    evidence_buffer_days: int = 2
    private_radius_m: float = 100.0
    # warehouse layout
    root: str = "warehouse"
    env: str = "prod"
    # execution knobs
    salt_buckets: int = 8
    extra: dict = field(default_factory=dict)

    @property
    def as_of_date(self) -> dt.date:
        return self.as_of.date()

    def with_(self, **kw) -> "Cfg":
        return replace(self, **kw)

    def layer(self, name: str) -> str:
        """Environment-prefixed layer name (SNK-13): ``dev_silver`` in dev."""
        if self.env and self.env != "prod" and name in ("silver", "gold"):
            return f"{self.env}_{name}"
        return name

    def table_path(self, layer: str, table: str) -> str:
        return f"{self.root}/{self.layer(layer)}/{table}"
