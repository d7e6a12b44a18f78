"""Column expressions: numbers, time, masking, geography, rules."""

from .columns import (
    age_years, banding, card_hash, card_last4, compact_number, day, day_ordinal, epoch_seconds, exact_avg, exact_ratio, exact_round, exact_share, exact_sum, first_match, fourier_terms,
    freshness_status, haversine_km, hour_bucket, present_tier, reject_reason, seconds_between, strip_prefix, weekday_name,
)

__all__ = [
    "age_years", "banding", "card_hash", "card_last4", "compact_number", "day", "day_ordinal", "epoch_seconds", "exact_avg", "exact_ratio", "exact_round", "exact_share", "exact_sum", "first_match", "fourier_terms",
    "freshness_status", "haversine_km", "hour_bucket", "present_tier", "reject_reason", "seconds_between", "strip_prefix", "weekday_name",
]
