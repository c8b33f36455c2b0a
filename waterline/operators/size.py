"""When a table may be broadcast.

Spark takes an aggregate over large facts to be as large as the facts, so it never plans to
broadcast the small tables that this library derives from them. Their size follows from the number
of entities, which is counted here before a hint is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# One row per entity, at most a few hundred bytes each: about 60 MB.
MAX_BROADCAST_ROWS = 200_000


def is_small(df: DataFrame, max_rows: int | None = None) -> bool:
    """Whether the table has at most max_rows rows. Runs a job that stops counting after that."""
    max_rows = MAX_BROADCAST_ROWS if max_rows is None else max_rows
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if(small: bool, df: DataFrame) -> DataFrame:
    return F.broadcast(df) if small else df
