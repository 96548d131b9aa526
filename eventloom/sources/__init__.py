"""Readers, page parsers and fetching sources."""
