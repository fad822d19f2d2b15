"""Operators for preparing training text: search, language, mixing, dedup, tokens, licences, models."""
