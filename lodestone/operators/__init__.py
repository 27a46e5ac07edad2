"""Relational and retrieval operators."""
