"""Scalar rules on staging values, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _cols(values) -> list[Column]:
    return [F.col(v) if isinstance(v, str) else v for v in values]


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(*_cols([value]), F.lit(""))


def concept_or_zero(concept_id: Column | str, actual_domain: Column | str | None = None,
                    wanted_domain: str | None = None) -> Column:
    """Unresolved concepts, and those outside the wanted domain, become 0.

    A concept whose domain is unknown is kept."""
    (concept,) = _cols([concept_id])
    found = F.coalesce(concept, F.lit(0))
    if wanted_domain is None:
        return found
    (domain,) = _cols([actual_domain])
    return F.when(domain != F.lit(wanted_domain), F.lit(0)).otherwise(found)


def first_filled(*values: Column | str) -> Column:
    return F.coalesce(*_cols(values))


def code_label(code: Column | str, text: Column | str) -> Column:
    """code|text with missing parts empty."""
    code, text = _cols([code, text])
    empty = F.lit("")
    return F.concat(F.coalesce(code, empty), F.lit("|"), F.coalesce(text, empty))


def decimal_value(*values: Column | str) -> Column:
    """First non-null value as a double; text that is no number is null."""
    return F.coalesce(*_cols(values)).try_cast("double")


def preferred_type(mapped_id: Column | str, source_id: Column | str) -> Column:
    """The mapped type concept if it resolved, otherwise the source one."""
    mapped, source = _cols([mapped_id, source_id])
    return F.when(mapped > 0, mapped).otherwise(source)


def repair_interval(start: Column | str, end: Column | str, exclude: Column | str) -> dict[str, Column]:
    """Start falls back to the end; a row with neither is marked for exclusion."""
    start, end, exclude = _cols([start, end, exclude])
    repaired = F.coalesce(blank_to_null(start), blank_to_null(end))
    return {"start": repaired, "exclude": F.when(repaired.isNull(), F.lit("1")).otherwise(exclude)}


def base64_text(value: Column | str) -> Column:
    """Text of a Base64 body; the surrounding white space is not part of it."""
    (col,) = _cols([value])
    return F.decode(F.unbase64(F.trim(col)), "UTF-8")


def trimmed(value: Column | str, width: int) -> Column:
    return F.substring(*_cols([value]), 1, width)
