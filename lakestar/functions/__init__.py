"""Pure Column -> Column functions (no data access, no Python UDFs)."""

from lakestar.functions.text import (  # noqa: F401
    content_type_label, device_type_label, event_type_label, genre_label,
    initcap_alnum, is_blank, os_label, plan_type_label,
)
from lakestar.functions.dates import (  # noqa: F401
    date_key, iso_or_us_date, iso_or_us_timestamp, strict_iso_date,
    strict_iso_timestamp, text_to_date, us_text_to_date,
)
