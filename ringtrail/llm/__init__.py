"""Operators of a training-data pipeline: quality, toxicity, language, duplicates, leaks, URLs, tokens."""
