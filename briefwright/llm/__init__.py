"""Operators of a training-data pipeline: duplicates, quality, contamination, secrets, language, toxicity, tokens, licences, vectors."""
