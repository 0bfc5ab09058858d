"""Training-data operators: filters, archives, packing, search, extraction, deduplication, mixing."""
