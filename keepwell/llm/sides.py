"""Joining a wide table with a list of ids whose size is checked first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ids a broadcast may hold: some ten megabytes, whatever the input.
BROADCAST_ROWS = 500_000


def checked(stored: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``stored`` (a materialised table) with a broadcast hint if it has at most
    ``limit`` rows; beyond that Spark shuffles both sides."""
    return F.broadcast(stored) if stored.limit(limit + 1).count() <= limit else stored
