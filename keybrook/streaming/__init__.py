"""Structured Streaming pieces: sinks, continuous tables, changelogs."""
