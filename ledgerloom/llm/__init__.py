"""Preparing text for language models: duplicates, filters, mixing, sharding and token files."""
