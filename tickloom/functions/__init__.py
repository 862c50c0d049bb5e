"""Scalar and window expressions."""
