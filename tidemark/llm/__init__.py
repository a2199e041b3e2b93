"""Training-data operators: packing, mixing, near-duplicates, secrets, search, quality, URLs, vectors, language, lines."""
