"""Training-data operators (PII, quality, near-duplicates, WARC, toxicity, ...). Nothing outside imports this package."""
