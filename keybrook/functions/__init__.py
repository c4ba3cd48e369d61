"""Column functions: codecs, text, seeded values."""
