"""Date and timestamp parsing rules of the silver build, and calendar parts.

Parsing never raises: a value that matches a pattern but is not a real date
becomes NULL (``try_cast`` / ``try_to_date``) and is reported as a reject by the
silver build, where the reference would abort the whole load.
Timestamps are produced as TIMESTAMP_NTZ holding the UTC wall clock.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Patterns of the reference's parsing rules (POSIX-style, `.` is any character).
ISO_DATE_PREFIX = r"^\d{4}-\d{2}-\d{2}"
ISO_DATE_EXACT = r"^\d{4}-\d{2}-\d{2}\z"
US_DATE_EXACT = r"^\d{1,2}/\d{1,2}/\d{4}\z"
US_DATE_PREFIX = r"^\d{1,2}/\d{1,2}/\d{4}"
ISO_TIMESTAMP_MICROS_Z = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}.\d{6}Z\z"
PLAIN_DATE = r"^\s*\d{4,}-\d{1,2}-\d{1,2}\s*\z"
US_DATE_FORMAT = "M/d/yyyy"          # month and day with one or two digits
# ---------------------------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_to_date(c: Column | str) -> Column:
    """ISO text to DATE; a valid time after the date is left off, anything else after it gives NULL."""
    c = _c(c)
    return F.when(c.rlike(PLAIN_DATE), c.try_cast("date")).otherwise(c.try_cast("timestamp_ntz").cast("date"))


def text_to_timestamp(c: Column | str) -> Column:
    """ISO text to TIMESTAMP_NTZ; a zone suffix is dropped, the wall clock kept."""
    return _c(c).try_cast("timestamp_ntz")


def us_text_to_date(c: Column | str) -> Column:
    """``M/D/YYYY`` to DATE; impossible dates (02/30) give NULL."""
    return F.try_to_date(_c(c), US_DATE_FORMAT)


def iso_or_us_date(c: Column | str) -> Column:
    """ISO date (prefix match) or an exact US date, else NULL (user sign-up dates)."""
    c = _c(c)
    return (F.when(c.rlike(ISO_DATE_PREFIX), text_to_date(c))
            .when(c.rlike(US_DATE_EXACT), us_text_to_date(c)))


def strict_iso_date(c: Column | str) -> Column:
    """Exactly ``YYYY-MM-DD``, else NULL (subscription start / end)."""
    c = _c(c)
    return F.when(c.rlike(ISO_DATE_EXACT), text_to_date(c))


def strict_iso_timestamp(c: Column | str) -> Column:
    """``YYYY-MM-DDTHH:MM:SS.ffffffZ`` only, else NULL."""
    c = _c(c)
    return F.when(c.rlike(ISO_TIMESTAMP_MICROS_Z), text_to_timestamp(c))


def iso_or_us_timestamp(c: Column | str) -> Column:
    """ISO text, or a US date with anything after it (taken as midnight), else NULL."""
    c = _c(c)
    us_part = F.regexp_extract(c, "(" + US_DATE_PREFIX + ")", 1)
    return (F.when(c.rlike(ISO_DATE_PREFIX), text_to_timestamp(c))
            .when(c.rlike(US_DATE_PREFIX), us_text_to_date(us_part).cast("timestamp_ntz")))


def date_key(d: Column | str) -> Column:
    """``YYYYMMDD`` as an INT."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_day_of_week(d: Column | str) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.extract(F.lit("DAYOFWEEK_ISO"), _c(d))


def month_name(d: Column | str) -> Column:
    """Full English month name."""
    return F.date_format(_c(d), "MMMM")
