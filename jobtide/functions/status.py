"""Job status predicates and classification over the counters of a job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from jobtide import fixed


def _zero_or_null(counter: Column) -> Column:
    return F.coalesce(counter, F.lit(0)) == 0


def _positive(counter: Column) -> Column:
    return F.coalesce(counter, F.lit(0)) > 0


def is_starting(active: Column, failed: Column, succeeded: Column, start_time: Column) -> Column:
    """Nothing is known about the job yet."""
    return start_time.isNull() & active.isNull() & failed.isNull() & succeeded.isNull()


def is_running(active: Column, failed: Column) -> Column:
    return _positive(active) & _zero_or_null(failed)


def is_retry(active: Column, failed: Column) -> Column:
    return _positive(active) & _positive(failed)


def is_failed(active: Column, succeeded: Column, start_time: Column) -> Column:
    return _zero_or_null(active) & _zero_or_null(succeeded) & start_time.isNotNull()


def is_success(active: Column, succeeded: Column) -> Column:
    return _zero_or_null(active) & _positive(succeeded)


def job_status(active: Column, failed: Column, succeeded: Column, start_time: Column) -> Column:
    """Status text, or NULL when no rule applies."""
    return (
        F.when(is_running(active, failed), fixed.RUNNING)
        .when(is_retry(active, failed), fixed.RETRY)
        .when(is_starting(active, failed, succeeded, start_time), fixed.STARTING)
        .when(is_failed(active, succeeded, start_time), fixed.FAILED)
        .when(is_success(active, succeeded), fixed.SUCCESS)
    )


def is_suspect_failure(
    active: Column, failed: Column, succeeded: Column, start_time: Column
) -> Column:
    """Counts as failed only because it has started and no counter is set yet."""
    no_counter = active.isNull() & failed.isNull() & succeeded.isNull()
    return start_time.isNotNull() & no_counter


def routing_key(status: Column) -> Column:
    """An unclassified job gets the key that ends in the text for 'no value'."""
    return F.concat(
        F.lit(fixed.STATUS_KEY_PREFIX), F.coalesce(status, F.lit(fixed.NO_STATUS_TEXT))
    )


def is_terminal(key: Column) -> Column:
    ends = [fixed.STATUS_KEY_PREFIX + s for s in (fixed.FAILED, fixed.SUCCESS)]
    return key.isin(ends)


def newest_condition(conditions: Column) -> Column:
    """The condition with the latest probe time; the first one listed wins a tie.

    A missing probe time counts as the oldest.  NULL for an empty or missing list.
    """
    keyed = F.transform(
        conditions,
        lambda c, i: F.struct(
            c["last_probe_time"].alias("probed"),
            (-i).alias("listed"),
            c["reason"].alias("reason"),
            c["message"].alias("message"),
        ),
    )
    return F.array_max(keyed)


def reason_text(reason: Column, message: Column) -> Column:
    missing = F.lit(fixed.NO_STATUS_TEXT)
    return F.concat(F.coalesce(reason, missing), F.lit(" - "), F.coalesce(message, missing))


def failure_reason(conditions: Column) -> Column:
    newest = newest_condition(conditions)
    return F.when(newest.isNull(), fixed.UNKNOWN_REASON).otherwise(
        reason_text(newest["reason"], newest["message"])
    )
