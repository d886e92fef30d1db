"""Operators of a training-data pipeline: near duplicates, secrets, tokens, packing, archives, languages, quality."""
