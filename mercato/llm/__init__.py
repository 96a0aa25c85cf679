"""Training-data operators: dedup, mixing, search, archives, sharding, scans, tokens, models."""
