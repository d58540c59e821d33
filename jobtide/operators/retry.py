"""Delivery attempts: attempt number, waits, exhaustion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from jobtide import fixed
from jobtide.operators.numbering import DEFAULT_SLICE, number_rows, serial_slice


def retry_schedule(
    failures: DataFrame,
    message: Sequence[str],
    serial: str,
    max_attempts: int = fixed.MAX_ATTEMPTS,
    slice_width: int = DEFAULT_SLICE,
) -> DataFrame:
    """Number the failed attempts of each message and plan what follows.

    The n-th failure waits ``5 n`` seconds (unroutable) or ``2 n`` seconds (no connection);
    the last permitted attempt is followed by nothing.  The time waited so far has a closed
    form, so no running sum is needed.
    """
    numbered = number_rows(
        failures, message, [serial], serial_slice(serial, slice_width), "attempt", first=1
    )
    attempt = F.col("attempt")
    exhausted = attempt >= max_attempts
    # waits of the attempts before this one: 1 + 2 + ... + (n - 1) steps
    steps = (attempt * (attempt - 1) / 2).cast("bigint")
    return numbered.withColumns(
        {
            "exhausted": exhausted,
            "publish_delay": F.when(~exhausted, attempt * fixed.PUBLISH_DELAY_SECONDS),
            "connect_delay": F.when(~exhausted, attempt * fixed.CONNECT_DELAY_SECONDS),
            "waited_before": steps * fixed.PUBLISH_DELAY_SECONDS,
        }
    )
