"""Column expressions; every one stays inside whole-stage codegen."""

from .codes import compose_code, document_id, message_key, prefix
from .labels import band, matches_label, quality_flag, zone
from .measures import geo_struct, guarded_rate, half_up, or_zero, unit_price
from .parsing import date_from_text, number_from_text, whole_from_text

__all__ = [
    "band", "compose_code", "date_from_text", "document_id", "geo_struct",
    "guarded_rate", "half_up", "matches_label", "message_key", "number_from_text",
    "or_zero", "prefix", "quality_flag", "unit_price", "whole_from_text", "zone",
]
