"""Operators of a training-data pipeline: sharding, de-duplication, filters, mixing and packing."""
