"""Column expressions: pure `Column -> Column` helpers, all JVM-side built-ins."""

from billbook.functions.classify import (  # noqa: F401
    days_late,
    days_late_as_of,
    delay_band,
    delay_band_filter,
    mart_status,
    minimum_behaviour,
    minimum_behaviour_filter,
    payment_status,
    payment_status_total,
    retention_category,
    value_band,
)
from billbook.functions.dates import (  # noqa: F401
    flag_within,
    month_label,
    month_start,
    months_between,
    ref_from_date,
    ref_from_text,
    truncated_months,
)
from billbook.functions.parsing import money, parse_date, parse_id, version_key  # noqa: F401
