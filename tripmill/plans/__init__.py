"""Whole sequences built from the operators."""
