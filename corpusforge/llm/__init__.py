"""Operators for training-data pipelines: scoring, search, tokens, packing, cleaning."""
