"""Timestamps from text and from epoch numbers, always normalised to UTC."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from evlake.fixed_values import EPOCH_MILLIS_ABOVE
from evlake.functions.json_values import strip

# Extended ISO form only. Spark's own cast would also take 'now', '2026' or
# 'T09:03', none of which is a timestamp here.
_DATE = r"(?!0000)\d{4}-\d{2}-\d{2}"
_CLOCK = r"\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?"
_ZONE = r"(?:[Zz]|[+-]\d{2}:\d{2}(?::\d{2})?)?"
# The form nearly all event times have; Spark's cast takes it as it is.
_COMPLETE = rf"^{_DATE}T\d{{2}}:\d{{2}}:\d{{2}}(?:\.\d+)?(?:Z|[+-]\d{{2}}:\d{{2}})$"
_ISO = rf"^{_DATE}(?:[T ]{_CLOCK}{_ZONE})?$"


def from_text(text: Column) -> Column:
    """ISO-8601 date or date-time. No zone means UTC; fractions beyond
    microseconds are cut; anything else is null.

    ``text`` is used more than once: give a column, not a costly expression.
    """
    complete = text.rlike(_COMPLETE)
    return F.when(complete, text.try_cast("timestamp")).otherwise(_spelled_out(text))


def _spelled_out(text: Column) -> Column:
    iso = F.regexp_extract(strip(text), _ISO, 0)  # '' unless it matches
    # Spell out what Spark's cast wants to see: midnight, seconds and UTC.
    timed = F.regexp_replace(iso, r"^(.{10})$", "$1T00:00")
    full = F.regexp_replace(timed, r"^(.{11}\d\d:\d\d)(|[Zz]|[+-].*)$", "$1:00$2")
    zoned = F.regexp_replace(full, r"^(.{11}[0-9:.]+)[Zz]?$", "$1+00:00")
    return zoned.try_cast("timestamp")


def from_epoch(number: Column) -> Column:
    """Seconds since 1970, or milliseconds when the magnitude says so."""
    real = number.cast("double")
    seconds = F.when(F.abs(real) > F.lit(EPOCH_MILLIS_ABOVE), real / 1000.0).otherwise(real)
    micros = F.bround(seconds * 1000000.0).try_cast("bigint")
    # Years 1 to 9999, the range of a calendar date.
    lowest, highest = -62135596800000000, 253402300799999999
    return F.when(micros.between(lowest, highest), F.timestamp_micros(micros))
