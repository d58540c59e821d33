"""Registered queries: the operators run over the given tables."""
