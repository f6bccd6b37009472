"""Training-data operators: deduplication, decontamination, tokens, quality, privacy, licences, search."""
