"""Operators for large training-data pipelines (quality, sharding, secrets, packing,
archives, toxicity, mixing, line rules, exact search, near-duplicates).

Nothing else in the library imports this subpackage.
"""
