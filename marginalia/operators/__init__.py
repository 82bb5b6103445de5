"""Relational operators over documents, concepts and registries."""
