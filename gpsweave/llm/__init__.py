"""Operators for preparing training data: deduplication, decontamination,
scoring, tokenising and formatting. Nothing else in the library imports this."""
