"""Training-data operators: deduplication, filtering, extraction, tokenizing."""
