"""Operators of a training-data pipeline (text deduplication, filtering, mixing,
scoring, personal data, token files).  Nothing outside this package imports it."""
