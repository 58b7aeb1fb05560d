"""Training-data operators: packing, de-duplication, tokens, decontamination, language, toxicity, LM, WARC, ANN, PII."""
