"""Training-data operators: deduplication, language, tokens, packing, sharding, decontamination."""
