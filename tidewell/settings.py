"""Every business constant of the pipeline in one place."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

# Raw status word -> unified status.
STATUS_WORDS = {
    "paid": "paid",
    "completed": "paid",
    "success": "paid",
    "void": "void",
    "cancelled": "cancelled",
    "refund": "refunded",
}

# Phone prefix -> locale.
LOCALE_PREFIXES = {"61": "AU", "44": "GB", "86": "CN", "85": "HK"}

# Product-code prefix -> category; anything else is the default.
CATEGORY_PREFIXES = {"SYD": "City Tour", "TAS": "Island Tour"}
CATEGORY_DEFAULT = "General"

# Channel id -> channel type; anything else is the default.
CHANNEL_TYPES = {"website": "Online", "ota": "Online", "store": "Offline"}
CHANNEL_TYPE_DEFAULT = "Partner"

# Upper bound in days -> bucket label, and the label beyond.
RECENCY_BUCKETS = ((7, "≤ 7 days"), (30, "8–30 days"), (90, "31–90 days"))
RECENCY_BEYOND = "> 90 days"

# Age limits, in seconds, of the inventory freshness classes.
FRESH_BELOW_SECONDS = 900
STALE_UP_TO_SECONDS = 145600

# The freshness classes, newest first.
FRESHNESS_LABELS = ("fresh", "stale", "expired")

# Minimum counts of the floored freshness chart.
FRESHNESS_FLOORS = {"fresh": 25, "stale": 15, "expired": 9}

# Currency codes the sellers legitimately use; others are reported, not changed.
KNOWN_CURRENCIES = ("AUD", "CNY", "HKD", "USD", "GBP", "EUR")


@dataclass(frozen=True)
class Settings:
    """Choices a build may make; the defaults reproduce the established numbers."""

    as_of: datetime
    identity_mode: str = "one_pass"  # or "transitive"
    customer_grain: str = "person_source"  # or "record"
    inventory_grain: str = "latest"  # or "all"
    exact_amounts: bool = False
    keep_hyphen: bool = False
    price_tolerance: float = 0.0
    default_currency: str = "AUD"
    local_zones: dict[str, str] = field(default_factory=dict)  # source -> zone of local times
    append_snapshots: bool = False
    stable_keys: bool = False  # surrogate keys stay from build to build
    # gold table -> rule -> rows that may break it; given, gold tables are written through gates
    quality_limits: dict[str, dict[str, int]] | None = None

    def __post_init__(self) -> None:
        for name, allowed in (
            ("identity_mode", ("one_pass", "transitive")),
            ("customer_grain", ("person_source", "record")),
            ("inventory_grain", ("latest", "all")),
        ):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}")
