"""End-to-end plans built from sources, operators and functions."""
