"""Readers, writers and the feed schemas."""
