"""Column-level helpers built only from ``pyspark.sql.functions``."""

from fieldbook.functions.columns import (  # noqa: F401
    canonical_array,
    fill_null_text,
    keyword_match,
    list_items,
    replace_when_contains,
    strip_ws,
    to_text,
    unit_for,
)
from fieldbook.functions.dates import date_tokens, parse_dmy  # noqa: F401
