"""Training-data operators: quality, dedup, decontamination, PII, packing and token output."""
