"""Training-data operators: scans, deduplication, scoring, packing and sharding of text tables."""
