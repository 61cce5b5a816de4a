"""Training-data operators: dedup, decontamination, tokenised output, LM scoring, WARC."""
