"""Readers, stream sources, writers and the catalog."""
