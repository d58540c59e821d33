"""Deal rows out over a given number of tasks before costly per-row work."""

from __future__ import annotations

from pyspark.sql import DataFrame

from jobtide.session import SPREAD_TASKS


def spread(df: DataFrame, *keys: str, tasks: int | None = None) -> DataFrame:
    """Deal the rows out over ``tasks`` tasks, by a hash of ``keys``.

    Without ``tasks`` the session's setting counts; where there is none the rows stay where they
    are.  Inputs of many splits need no dealing out, so only sessions for small tables set it.
    """
    setting = df.sparkSession.conf.get(SPREAD_TASKS, None)
    count = tasks or (int(setting) if setting else None)
    return df.repartition(count, *keys) if count and not df.isStreaming else df
