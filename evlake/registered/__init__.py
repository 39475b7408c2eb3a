"""The queries this package answers for, each over whole tables."""

from evlake.registered import progress_entries, stream_entries, table_entries, topic_entries  # noqa: F401
from evlake.registered.entries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
