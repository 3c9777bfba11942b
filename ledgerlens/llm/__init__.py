"""Operators of a training-data pipeline: scoring, filters, deduplication,
decontamination, sharding and packing of documents.

Each module holds one operator with its own general interface; ``queries``
binds them to the driver's tables.
"""
