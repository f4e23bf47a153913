"""Training-data operators: archives, extraction, language, mixing,
near-duplicates, quality, line dedup, exact search, toxicity and packing."""
