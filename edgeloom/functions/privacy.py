"""Masking, decoding and splitting of text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: credential names whose values are masked, and the mask --------------
SECRET_NAMES = ["password", "token", "key"]
MASK = "***"
# --------------------------------------------------------------------------------------


def redact_secrets(col: Column | str) -> Column:
    """Replace the value in ``name=value`` for every credential name."""
    out = F.col(col) if isinstance(col, str) else col
    for name in SECRET_NAMES:
        out = F.regexp_replace(out, rf"{name}=\S+", f"{name}={MASK}")
    return out


def url_decode(col: Column | str) -> Column:
    """Percent-decoding; NULL instead of an error for a malformed escape."""
    return F.try_url_decode(col)


def edgeworker_duration(col: str = "ew_execution_info") -> Column:
    """The 7th ``:`` part up to its first ``|``, as INT; NULL when it is no number."""
    part = F.split_part(F.col(col), F.lit(":"), F.lit(7))
    return F.split_part(part, F.lit("|"), F.lit(1)).try_cast("int")


def edgeworker_id(col: str = "ew_execution_info") -> Column:
    return F.substring(col, 1, 50)


def edgeworker_fields(col: str = "ew_execution_info") -> list[Column]:
    return [edgeworker_id(col).alias("edgeworker_id"), edgeworker_duration(col).alias("duration_ms")]
