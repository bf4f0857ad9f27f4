"""Operators for training-data pipelines: filters, archives, classifiers, deduplication, packing, search."""
