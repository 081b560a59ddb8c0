"""Training-data operators: scoring, filtering, deduplication, mixing and tokenisation of text tables."""
