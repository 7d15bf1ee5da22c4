"""Training-data operators: tokenisation, near-duplicates, search, extraction, packing."""
