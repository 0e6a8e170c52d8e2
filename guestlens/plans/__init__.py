"""Shared plan shapes: ranking, skewed lookups, grouped moments, decision procedures."""
