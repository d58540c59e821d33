"""All registered queries and their check SQL."""

from __future__ import annotations

from jobtide.plans import events, launches, logs, messages, reaping, streams

ALL = {
    **events.QUERIES,
    **messages.QUERIES,
    **launches.QUERIES,
    **reaping.QUERIES,
    **logs.QUERIES,
    **streams.QUERIES,
}
