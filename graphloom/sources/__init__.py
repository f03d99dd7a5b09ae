"""Readers for text files, entity documents, logs and tables."""
