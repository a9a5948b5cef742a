"""Operators for training-data pipelines: deduplication, filtering, extraction, sharding and packing.

Nothing outside this subpackage imports it.
"""
