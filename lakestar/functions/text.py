"""Text rules of the silver build: trimming, title case and label canonicalisation.

Every function maps Columns to a Column, so it stays inside whole-stage codegen
(or, for the higher-order ``transform``, at least inside the JVM).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's label rules exactly.
# Device types: an upper-cased, trimmed label starting with the prefix maps to the name.
DEVICE_TYPE_PREFIXES = [
    ("MOBILE", "Mobile"),
    ("SMARTTV", "SmartTV"),
    ("TABLET", "Tablet"),
    ("WEB", "Web"),
]
# Operating systems: same prefix rule.
OS_PREFIXES = [
    ("ANDROID", "Android"),
    ("IOS", "iOS"),
    ("WEBOS", "WebOS"),
    ("TIZEN", "Tizen"),
    ("CHROME", "Chrome"),
]
# Event types: upper-cased, trimmed label; this one alias is renamed.
EVENT_TYPE_ALIASES = {"SUBSCRIBE": "SIGNUP"}
# Genre: the first part of the trimmed label split on this separator.
GENRE_SEPARATOR = ","
# A "word" for title case is a run of letters and digits (any script).
WORD_OR_GAP = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"
# ---------------------------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def initcap_alnum(c: Column | str) -> Column:
    """Title case where a word is a run of letters/digits.

    ``o'brien-smith mcDONALD`` -> ``O'Brien-Smith Mcdonald``. Spark's own
    ``initcap`` only splits on spaces, so the string is cut into alternating
    word / non-word runs and each run is capitalised.
    """
    runs = F.regexp_extract_all(_c(c), F.lit(WORD_OR_GAP), 0)
    cased = F.transform(
        runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30))))
    return F.array_join(cased, "")


def is_blank(c: Column | str) -> Column:
    """NULL or only spaces."""
    c = _c(c)
    return c.isNull() | (F.trim(c) == F.lit(""))


def _prefix_label(c: Column | str, table: list[tuple[str, str]]) -> Column:
    u = F.upper(F.trim(_c(c)))
    out = None
    for prefix, name in table:
        cond = u.startswith(prefix)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(None).cast("string"))


def device_type_label(c: Column | str) -> Column:
    return _prefix_label(c, DEVICE_TYPE_PREFIXES)


def os_label(c: Column | str) -> Column:
    return _prefix_label(c, OS_PREFIXES)


def event_type_label(c: Column | str) -> Column:
    u = F.upper(F.trim(_c(c)))
    out = u
    for alias, name in EVENT_TYPE_ALIASES.items():
        out = F.when(u == F.lit(alias), F.lit(name)).otherwise(out)
    return out


def genre_label(c: Column | str) -> Column:
    """First separator-part of the trimmed genre; the part itself is not re-trimmed."""
    return F.split_part(F.trim(_c(c)), F.lit(GENRE_SEPARATOR), F.lit(1))


def content_type_label(c: Column | str) -> Column:
    return initcap_alnum(F.trim(_c(c)))


def plan_type_label(c: Column | str) -> Column:
    return initcap_alnum(F.trim(_c(c)))
