"""Operators of a training-data pipeline: archives, personal data, search, links, tokens, duplicates, packing, quality."""
