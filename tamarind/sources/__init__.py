"""Readers of landed files and tables."""
