"""Multimodal trip analytics on Spark."""

from .plans import (
    audit_counts, bike_profile, destinations_from, golden_counts, join_profiles, mode_profile,
    mode_tables, multimodal_profile, multimodal_profile_of, refresh_lookup, taxi_profile,
    zone_lookup,
)
from .session import build_session

__all__ = [
    "build_session", "bike_profile", "taxi_profile", "mode_profile", "multimodal_profile",
    "multimodal_profile_of", "join_profiles", "mode_tables", "destinations_from",
    "golden_counts", "audit_counts", "refresh_lookup", "zone_lookup",
]
