"""Training-data operators: quality, extraction, deduplication, packing, toxicity, privacy, tokenisation, licences."""
