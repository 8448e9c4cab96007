"""Operators that clean and pack text for training: deduplication, filters, scans, packing."""
