"""Readers, writers and seeded generators of keyed records."""
