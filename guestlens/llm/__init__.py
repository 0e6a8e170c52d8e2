"""Preparation of training text: deduplication, extraction, quality, decontamination and packing."""
