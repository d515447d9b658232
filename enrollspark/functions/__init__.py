"""Column-level helpers: fixed-width layouts and string/date rules."""

from enrollspark.functions.layout import (  # noqa: F401
    COB_LAYOUT,
    DEMO_LAYOUT,
    ELIG_BODY_LAYOUT,
    ELIG_LAYOUT,
    Field,
    Layout,
    Lit,
    encode,
    source_columns,
)
from enrollspark.functions.text import (  # noqa: F401
    blank_to_empty,
    is_blank,
    pad,
    parse_ymd,
    row_key,
    spaces,
    ymd_to_iso,
)
