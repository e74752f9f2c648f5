"""Readers, writers and the views derived from event tables."""
