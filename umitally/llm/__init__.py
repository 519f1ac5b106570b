"""Training-data operators: scoring, tokenising, packing, deduplication, archives and chat formatting."""
