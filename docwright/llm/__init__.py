"""Operators for preparing training text: archives, sharding, quality, packing, duplicates, language models, search, PII."""
