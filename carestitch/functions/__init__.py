from .dates import as_date, as_timestamp, birth_parts, end_or_start, hl7_timestamp
from .keys import (
    FANOUT_BITS, SOURCE_BITS, add_row_id, composite_id, distinct_with_row_id, duplicate_keys,
    fact_id, location_key, person_key, stable_id,
)
from .values import (
    base64_text, blank_to_null, code_label, concept_or_zero, decimal_value, first_filled,
    preferred_type, repair_interval, trimmed,
)

__all__ = [
    "as_date", "as_timestamp", "birth_parts", "end_or_start", "hl7_timestamp",
    "FANOUT_BITS", "SOURCE_BITS", "add_row_id", "composite_id", "distinct_with_row_id",
    "duplicate_keys", "fact_id", "location_key", "person_key", "stable_id",
    "base64_text", "blank_to_null", "code_label", "concept_or_zero", "decimal_value",
    "first_filled", "preferred_type", "repair_interval", "trimmed",
]
