"""Training-data operators: extraction, scoring, filtering, deduplication, tokenisation."""
