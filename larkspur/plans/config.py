"""Settings as frozen values, passed explicitly; environment variables override periods."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Tier:
    level: int
    name: str
    every_hours: int
    pages: int | None
    queue_cap: int
    stale_days: int = 30
    sample_percent: float = 10


# The four tiers.
TIERS = (Tier(1, "hot_listings", 6, 10, 500), Tier(2, "daily_sync", 24, 100, 5_000), Tier(3, "weekly_deep", 168, None, 10_000, 7), Tier(4, "monthly_refresh", 720, None, 20_000))


@dataclass(frozen=True)
class Settings:
    tiers: tuple[Tier, ...] = field(default=TIERS)
    price_percent: float = 1.0
    price_amount: float = 1000.0
    missing_before_removal: int = 2
    backlog_cap: int = 10_000
    quality_gate: float = 0.6
    score_gate: float = 0.7


def from_env(base: Settings = Settings(), env=os.environ) -> Settings:
    """TIER_<n>_EVERY: hours for tiers 1 and 2, days for 3 and 4."""
    tiers = []
    for t in base.tiers:
        said = env.get(f"TIER_{t.level}_EVERY")
        tiers.append(replace(t, every_hours=int(said) * (24 if t.level >= 3 else 1)) if said else t)
    return replace(base, tiers=tuple(tiers))
