"""Operators of a training-data pipeline: quality, dedup, tokens, language, mixing, archives."""
