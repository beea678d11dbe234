"""Preparation of trip-like records (a start, an end, named places) on Spark."""
