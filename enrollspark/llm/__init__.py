"""Operators of a training-data pipeline (secrets, quality, packing, search, mixing, duplicates, toxicity, chat, sharding).

Nothing else in the library imports this package.
"""
