"""Readers: change events, queue messages, log folders, state tables."""
