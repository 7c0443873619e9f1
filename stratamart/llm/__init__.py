"""Operators for training-data pipelines: filtering, de-duplication, search, encoding, mixing, sharding."""
