"""Column functions shared by operators. All are built-in expressions, none a UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def is_missing(c: Column) -> Column:
    """True for null and for words that mean no value."""
    return c.isNull() | F.lower(F.trim(c.cast("string"))).isin(V.MISSING)


def _word(c: Column, words: Sequence[str], upper: bool = False) -> Column:
    text = F.trim(c.cast("string"))
    return F.coalesce((F.upper(text) if upper else F.lower(text)).isin(list(words)), F.lit(False))


def is_fault_word(c: Column) -> Column:
    """A fault by name; a missing value is none."""
    return ~is_missing(c) & _word(c, V.FAULT, upper=True)


def is_audit_fault(c: Column) -> Column:
    """The audit's reading, for which N/A is a fault too."""
    return _word(c, V.AUDIT_FAULT, upper=True)


def is_offline_word(c: Column) -> Column:
    return ~is_missing(c) & _word(c, V.OFFLINE)


def says_true(c: Column) -> Column:
    return ~is_missing(c) & _word(c, V.TRUE_WORDS)


def says_false(c: Column) -> Column:
    return ~is_missing(c) & _word(c, V.FALSE_WORDS)


def first_value(*columns: Column) -> Column:
    """The first that is neither null, empty, ``null`` nor ``None``."""
    return F.coalesce(*(F.when(~c.cast("string").isin("", "null", "None"), c) for c in columns))


def number(c: Column) -> Column:
    """A plain decimal number, else null; casts would also take NaN and suffixes."""
    return F.when(c.rlike(_NUMBER), F.trim(c).try_cast("double"))


def state_of(c: Column) -> Column:
    """offline, online or unknown: by word, else by pattern; a disconnect is never online."""
    text = F.lower(F.trim(c))
    return (
        F.when(text.isin(V.OFFLINE_STATES), "offline")
        .when(text.isin(V.ONLINE_STATES), "online")
        .when(c.rlike(V.OFFLINE_TEXT), "offline")
        .when(c.rlike(V.ONLINE_TEXT) & ~F.contains(text, F.lit("disconnect")), "online")
        .otherwise("unknown")
    )


def first_match(c: Column, rules: Sequence[tuple[str, str]], prefix: str = "") -> Column:
    """The name of the first pattern that occurs in ``c``, any case; null if none does."""
    found = F.lit(None).cast("string")
    for pattern, name in reversed(rules):
        found = F.when(c.rlike(f"(?i){pattern}"), prefix + name).otherwise(found)
    return found


def epoch_micros(c: Column) -> Column:
    """Microseconds of a number or text: digits over 1e17 are ns, over 1e14 us, over 1e10 ms, else s; else ISO in UTC."""
    digits = c.rlike(r"^\s*\d+(\.\d+)?\s*$")
    n = F.trim(c).try_cast("double")
    scaled = F.when(n > 1e17, n / 1000).when(n > 1e14, n).when(n > 1e10, n * 1000).otherwise(n * 1_000_000)
    return F.when(digits, scaled.cast("long")).otherwise(iso_micros(c))


def iso_micros(c: Column) -> Column:
    """Microseconds of a date-time text read as UTC; null if it cannot be read.

    The text is read without zone, so the session's zone plays no part; an offset of
    zero, written Z or +00:00, is allowed.
    """
    local = F.regexp_replace(F.trim(c), r"(?i)(Z|[+-]00:?00)$", "")
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), local.try_cast("timestamp_ntz"))


def severity(score: Column) -> Column:
    (a, x), (b, y), (c, z) = V.SEVERITIES
    return F.when(score >= a, x).when(score >= b, y).when(score >= c, z).otherwise("HEALTHY")


def tier(probability: Column) -> Column:
    (a, x), (b, y), (c, z) = V.TIERS
    return F.when(probability >= a, x).when(probability >= b, y).when(probability >= c, z).otherwise("HEALTHY")


def digest16(*columns: Column) -> Column:
    """Sixteen hex digits that stand for values which must not be shown."""
    return F.substring(F.sha2(F.concat_ws("|", *columns), 256), 1, 16)


def redacted_url(c: Column) -> Column:
    """A connection address without its user, password and passwords among its parameters; ``<unset>`` if there is none."""
    user = F.regexp_replace(c, "://[^@/]*@", "://***:***@")
    return F.when(c.isNull() | (c == ""), "<unset>").otherwise(F.regexp_replace(user, r"(?i)(password|passwd|pwd)=[^&;\s]+", "$1=***"))


def safe_cell(c: Column) -> Column:
    """A spreadsheet must not take the cell for a formula."""
    return F.when(c.rlike(r"^[=+\-@]"), F.concat(F.lit("'"), c)).otherwise(c)


def safe_name(key: str) -> str:
    return "".join(ch if ch.isalnum() or ch == "_" else "_" for ch in key)
