"""Corpus operators for training data: sharding, packing, filters, deduplication, mixing, scoring, search, output."""
