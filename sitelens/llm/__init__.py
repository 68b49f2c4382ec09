"""Training-data operators: filters, near-duplicates, packing, tokenised output."""
