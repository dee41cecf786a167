"""Column-level helpers. Everything returns a ``Column`` built from Spark's
built-in functions, so it stays inside whole-stage code generation."""

from lakeshelf.functions.columns import (  # noqa: F401
    any_changed,
    days_to_date,
    json_field,
    null_safe_equal,
    parse_date,
    parse_iso_ts,
    parse_ts,
    row_hash,
    surrogate_key,
    to_decimal,
    tier,
)
