"""Training-data operators: mixing, search, dedup, extraction, packing, formatting."""
