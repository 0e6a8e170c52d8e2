"""Readers, writers and markup extraction."""
