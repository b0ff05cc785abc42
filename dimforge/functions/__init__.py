"""Column builders: pure ``Column -> Column`` helpers, all JVM-side built-ins."""

from dimforge.functions.columns import (
    blank_to_null,
    changed_any,
    col_of,
    derived_status,
    first_known,
    first_seen,
    row_hash,
    safe_cast,
    safe_date,
    sticky,
    when_codes,
)

__all__ = [
    "blank_to_null",
    "changed_any",
    "col_of",
    "derived_status",
    "first_known",
    "first_seen",
    "row_hash",
    "safe_cast",
    "safe_date",
    "sticky",
    "when_codes",
]
