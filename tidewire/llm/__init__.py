"""Training-data operators: encoding, mixing, deduplication, filtering, archives and language ID."""
