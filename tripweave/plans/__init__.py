"""The engine's user-facing tables."""

from .audit import audit_by_digest, audit_counts, golden_counts
from .destinations import destinations_from
from .lookups import refresh_lookup, zone_lookup
from .profiles import (
    bike_profile, join_profiles, mode_profile, mode_table, mode_tables, multimodal_profile,
    multimodal_profile_of, taxi_profile,
)

__all__ = [
    "bike_profile", "taxi_profile", "mode_profile", "multimodal_profile", "multimodal_profile_of",
    "join_profiles", "mode_table", "mode_tables", "destinations_from", "golden_counts", "audit_counts", "audit_by_digest",
    "refresh_lookup", "zone_lookup",
]
