"""Operators for preparing training text and embeddings."""
