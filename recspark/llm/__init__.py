"""Operators for training-data pipelines: near-duplicates, scans, scoring, packing and the like."""
