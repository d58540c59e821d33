"""Operators for preparing training text: scans, filters, classifiers, near duplicates, tokens, packing."""
