"""Whole pipelines, each in a batch and a streaming form."""
