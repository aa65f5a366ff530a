"""Operators of a training-data pipeline: tokens, scores, duplicates, quality, personal data, packing.

Nothing else in the library imports this package; it takes only the session helpers from it.
"""
