"""Typed datasets, readers and writers."""
