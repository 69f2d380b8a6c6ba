"""Training-data operators: quality, deduplication, privacy, encoding, packing and scoring of texts."""
