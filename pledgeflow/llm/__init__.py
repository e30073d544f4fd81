"""Training-data operators: packing, sharding, tokenisation, search, filters and deduplication."""
