"""Training-data operators: tokens, quality, duplicates, search and packing."""
