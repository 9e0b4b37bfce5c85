"""Operators for training data: licences, fingerprints, mixing, languages, secrets, packing, quality,
lines, vector search, near duplicates, conversations and web pages. Nothing outside this package imports it."""
