"""Operators of a training-data pipeline: decontamination, secret scans,
packing, deduplication, classification, sharding and nearest neighbours.

Nothing else in the library imports this subpackage.
"""
