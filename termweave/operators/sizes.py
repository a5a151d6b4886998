"""Broadcasts behind a check of the size."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a table counts as small.
SMALL = 20_000


def small(df: DataFrame, most: int = SMALL) -> DataFrame:
    """The table, to be broadcast if it has at most ``most`` rows; joins shuffle it otherwise.

    For tables that Catalyst can't tell the size of, like an aggregate of a calendar. Counting stops
    beyond the bound. A session that forbids broadcasts is obeyed.
    """
    return F.broadcast(df) if is_small(df, most) else df


def is_small(df: DataFrame, most: int = SMALL) -> bool:
    """Whether ``small`` has the table broadcast."""
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return not limit.startswith("-") and df.limit(most + 1).count() <= most
