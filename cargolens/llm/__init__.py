"""Training-data operators: dedup, scans, packing, mixing, scoring, counting."""
