"""Arithmetic of the progress report, as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from evlake.fixed_values import SCALE_STOPS


def floored_gap(ahead: Column, behind: Column) -> Column:
    """How far ``behind`` trails, never negative; null when either is unknown."""
    both = ahead.isNotNull() & behind.isNotNull()
    return F.when(both, F.greatest(F.lit(0), ahead - behind))


def topic_count(retained: Column, end: Column) -> Column:
    """Messages on the topic: those retained, else the end offset."""
    return F.coalesce(retained, end)


def effective_lag(lag: Column, on_topic: Column, in_table: Column) -> Column:
    """Reported lag, else the distance between topic and table."""
    return F.coalesce(lag, floored_gap(on_topic, in_table))


def rate(earlier: Column, later: Column, seconds: Column) -> Column:
    """Change per second; null without two values or elapsed time."""
    return F.when(seconds > 0, (later - earlier) / seconds)


def mean_file_rows(rows: Column, files: Column) -> Column:
    """Rows in a data file on average; null while there is no file."""
    return rows / F.nullif(F.greatest(files, F.lit(0)), F.lit(0))


def is_buffering(gap: Column, batch_size: int) -> Column:
    """True while fewer rows than one batch wait for their commit."""
    return (gap > 0) & (gap < batch_size)


def axis_top(value: Column) -> Column:
    """Top of an axis that shows ``value``: the first stop that reaches it, or a twentieth
    more than the value where none does."""
    shown = F.greatest(value.cast("double"), F.lit(0.0))
    reached = F.filter(F.array(*[F.lit(stop).cast("bigint") for stop in SCALE_STOPS]), lambda stop: stop >= shown)
    return F.when(value.isNotNull(), F.coalesce(F.try_element_at(reached, F.lit(1)), F.floor(shown * 1.05) + 1))
