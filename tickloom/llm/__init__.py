"""Training-data operators: packing, search, language, sharding, near-duplicates, quality, scans, toxicity."""
